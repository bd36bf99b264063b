"""Queries of lines on a lattice, map registration, blocks in texts and protected transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.functions import rules, text
from terraledger.operators import lines
from terraledger.plans.registry import query
from terraledger.sources.tables import table


@query("""
WITH p AS (SELECT p_partkey // 8 AS line, p_partkey % 8 AS place, (p_partkey * 37 + p_size * 11) % 130 - 4.75 AS x, CASE WHEN p_size % 29 > 0 THEN (p_partkey * 13 + p_size * 7) % 70 - 5.5 END AS y FROM part),
s AS (SELECT *, lag(x) OVER w AS x0, lag(y) OVER w AS y0 FROM p WINDOW w AS (PARTITION BY line ORDER BY place)),
o AS (SELECT *, coalesce(y IS NOT NULL AND y0 IS NOT NULL AND abs(x - x0) <= 60, false) AS ok FROM s),
j AS (SELECT line, place, ok, coalesce(lag(ok) OVER (PARTITION BY line ORDER BY place), false) AS joined, CAST(round_even(x, 0) AS BIGINT) AS x, CAST(round_even(y, 0) AS BIGINT) AS y, CAST(round_even(x0, 0) AS BIGINT) AS x0, CAST(round_even(y0, 0) AS BIGINT) AS y0 FROM o),
k AS (SELECT *, abs(x - x0) AS dx, abs(y - y0) AS dy FROM j WHERE ok),
m AS (SELECT line, place, 0 AS kind, i, (2 * i + 1) * dy AS t FROM (SELECT *, unnest(range(dx)) AS i FROM k) UNION ALL SELECT line, place, 1, i, (2 * i + 1) * dx FROM (SELECT *, unnest(range(dy)) AS i FROM k)),
n AS (SELECT line, place, row_number() OVER w AS step, sum(1 - kind) OVER w AS a, sum(kind) OVER w AS b FROM m WINDOW w AS (PARTITION BY line, place ORDER BY t, kind, i ROWS UNBOUNDED PRECEDING) UNION ALL SELECT line, place, 0, 0, 0 FROM k),
c AS (SELECT line, place, step, joined, x0 + sign(x - x0) * a AS x, y0 + sign(y - y0) * b AS y FROM n JOIN k USING (line, place)),
d AS (SELECT *, x BETWEEN 0 AND 119 AND y BETWEEN 0 AND 59 AS inside FROM c), e AS (SELECT *, lag(inside) OVER (PARTITION BY line, place ORDER BY step) AS before FROM d)
SELECT line, place, CAST(step AS BIGINT) AS step, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, step = 0 OR NOT before AS starts FROM e WHERE inside AND (step > 0 OR NOT joined)""")
def lattice_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Lines through eight points each, over a map of 120 by 60 cells with a seam."""
    k, s = F.col("p_partkey"), F.col("p_size")
    points = table(spark, sf, "part").select(F.expr("p_partkey div 8").alias("line"), (k % 8).alias("place"), ((k * 37 + s * 11) % 130 - 4.75).alias("x"), F.when(s % 29 > 0, (k * 13 + s * 7) % 70 - 5.5).alias("y"))
    return lines.lattice_cells(points, "line", "place", 120, 60)


MAP = lines.Registration(x_mean=180.0, x_scale=180.0, lon=(8.0, 180.0), y_mean=60.0, y_scale=60.0, lat=(10.0, -75.0, -1.5, 4.0), height=121)


@query("""
WITH r AS (SELECT y, 10 + t * (-75 + t * (-1.5 + t * 4.0)) AS hi FROM (SELECT y, (y - 60) / 60.0::DOUBLE AS t FROM range(121) q(y))), g AS (SELECT y, hi, lead(hi) OVER (ORDER BY y) AS lo FROM r),
p AS (SELECT c_custkey, (c_custkey * 7919 % 3600 / 10.0 - 180)::DOUBLE AS lon, (c_custkey * 104729 % 1800 / 10.0 - 90)::DOUBLE AS lat FROM customer),
w AS (SELECT *, lon + CASE WHEN lon < -172 THEN 360 ELSE 0 END AS east FROM p)
SELECT c_custkey, round((east - 8) / 180 * 180 + 180, 6) AS px, round(g.y + (hi - lat) / (hi - lo), 6) AS py FROM w LEFT JOIN g ON lat <= hi AND (lat > lo OR (lat = lo AND g.y = 119))""")
def map_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Places of points on a map whose rows are not evenly spaced."""
    k = F.col("c_custkey").cast("long")
    points = table(spark, sf, "customer").select("c_custkey", (k * 7919 % 3600 / 10.0 - 180).alias("lon"), (k * 104729 % 1800 / 10.0 - 90).alias("lat"))
    return MAP.pixels(points, "lon", "lat").select("c_custkey", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"))


@query("""
WITH t AS (SELECT s_suppkey, 'x = 1' || chr(10) || 'zone = {' || repeat(' a = {', s_suppkey % 4) || repeat(' }', s_suppkey % 4 - CASE WHEN s_suppkey % 9 = 8 THEN 1 ELSE 0 END) || ' }' || chr(10) || 'y = { } }' AS txt FROM supplier),
c AS (SELECT s_suppkey, i, substr(txt, i, 1) AS ch FROM (SELECT s_suppkey, txt, unnest(range(7, length(txt) + 1)) AS i FROM t)),
d AS (SELECT *, sum(CASE ch WHEN '{' THEN 1 WHEN '}' THEN -1 ELSE 0 END) OVER (PARTITION BY s_suppkey ORDER BY i ROWS UNBOUNDED PRECEDING) AS depth FROM c)
SELECT s_suppkey, 7 AS first, CAST(min(CASE WHEN ch = '}' AND depth = 0 THEN i END) AS INTEGER) AS last, 'wet' || s_suppkey % 5 AS climate FROM d GROUP BY 1""")
def text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The span of a nested block, closed late in some rows, and a key's value inside flat blocks."""
    k = F.col("s_suppkey").cast("int")
    nested = F.concat(F.lit("x = 1\nzone = {"), F.expr("repeat(' a = {', int(s_suppkey % 4))"), F.expr("repeat(' }', int(s_suppkey % 4 - if(s_suppkey % 9 = 8, 1, 0)))"), F.lit(" }\ny = { } }"))
    flat = F.concat(F.lit("a = { soil = dry }\nb.c = {\n soil = x climate = wet"), (k % 5).cast("string"), F.lit("\n}\n"))
    span = text.block_span(nested, "zone")
    return table(spark, sf, "supplier").select("s_suppkey", span["first"].alias("first"), span["last"].alias("last"), text.block_values(flat, "climate")["b.c"].alias("climate"))


@query("""
WITH f AS (SELECT p_partkey, p_size * 10.0::DOUBLE AS base, p_size % 7 * p_size / 1.0::DOUBLE AS a, (p_size % 5 - CASE WHEN p_partkey % 20 = 0 THEN 1 ELSE 0 END) * p_size / 1.0::DOUBLE AS b, p_size % 11 * p_size / 1.0::DOUBLE AS floor FROM part),
k AS (SELECT *, CASE WHEN a >= 0 AND b >= 0 AND a + b <= base + 1e-5 THEN least(CASE WHEN a + b > 0 THEN greatest(base - least(base, floor), 0) / (a + b) ELSE 0 END, 1) END AS f FROM f)
SELECT p_partkey, round(a * f, 6) AS paddy, round(b * f, 6) AS bunds, round(base - (a + b) * f, 6) AS stays FROM k""")
def protected_transfer(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size").cast("double")
    rows = table(spark, sf, "part").select("p_partkey", (s * 10).alias("base"), (s % 7 * s).alias("a"), ((s % 5 - F.when(F.col("p_partkey") % 20 == 0, 1.0).otherwise(0.0)) * s).alias("b"), (s % 11 * s).alias("floor"))
    given, stays = rules.protected_transfer(F.col("base"), {"paddy": F.col("a"), "bunds": F.col("b")}, F.col("floor"))
    return rows.select("p_partkey", *[F.round(v, 6).alias(k) for k, v in given.items()], F.round(stays, 6).alias("stays"))
