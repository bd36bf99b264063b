"""Queries of networks and zones: main stems, distances, degrees, borders, runs, overlaps and budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.operators import graph
from terraledger.plans.graphs import TREE, tree
from terraledger.plans.gridded import CELLS, cells
from terraledger.plans.registry import query
from terraledger.sources.tables import table


@query(f"""WITH {TREE}, r AS (SELECT down_id, id, size, row_number() OVER (PARTITION BY down_id ORDER BY size DESC, id) AS k FROM t WHERE down_id IS NOT NULL)
SELECT down_id AS id, id AS main, size FROM r WHERE k = 1""")
def main_stem(spark: SparkSession, sf: str) -> DataFrame:
    best = tree(spark, sf).where("down_id is not null").groupBy(F.col("down_id").alias("id")).agg(F.max(F.struct("size", (-F.col("id")).alias("order"))).alias("m"))
    return best.select("id", (-F.col("m.order")).alias("main"), "m.size")


@query(f"""WITH RECURSIVE {TREE}, e AS (SELECT id AS a, down_id AS b FROM t WHERE down_id IS NOT NULL UNION ALL SELECT down_id, id FROM t WHERE down_id IS NOT NULL),
r AS (SELECT id AS node, 0 AS d FROM t WHERE size >= 49 UNION SELECT e.b, r.d + 1 FROM r JOIN e ON r.node = e.a WHERE r.d < 40)
SELECT node, CAST(min(d) AS BIGINT) AS distance FROM r GROUP BY 1""")
def sea_distance(spark: SparkSession, sf: str) -> DataFrame:
    nodes = tree(spark, sf)
    edges = nodes.where("down_id is not null").select(F.col("id").alias("a"), F.col("down_id").alias("b"))
    return graph.distances(edges, nodes.where("size >= 49").select("id"))


@query(f"""WITH {TREE}, e AS (SELECT id AS node FROM t WHERE down_id IS NOT NULL UNION ALL SELECT down_id FROM t WHERE down_id IS NOT NULL)
SELECT node, count(*) AS degree, CASE WHEN count(*) = 1 THEN 'end' WHEN count(*) = 2 THEN 'middle' ELSE 'junction' END AS kind FROM e GROUP BY 1""")
def node_degrees(spark: SparkSession, sf: str) -> DataFrame:
    links = tree(spark, sf).where("down_id is not null")
    ends = links.select(F.explode(F.array("id", "down_id")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return ends.withColumn("kind", F.when(F.col("degree") == 1, "end").when(F.col("degree") == 2, "middle").otherwise("junction"))


@query(f"""WITH {TREE} SELECT a.id, a.down_id, greatest(a.size % 3, b.size % 3) AS state, CASE WHEN greatest(a.size % 3, b.size % 3) = 0 THEN 'open' WHEN a.size + b.size > 60 THEN 'costly' ELSE 'works' END AS profile
FROM t a JOIN t b ON a.down_id = b.id""")
def edge_contract(spark: SparkSession, sf: str) -> DataFrame:
    a = tree(spark, sf).select("id", "down_id", "size")
    b = a.select(F.col("id").alias("down_id"), F.col("size").alias("size_b"))
    state = F.greatest(F.col("size") % 3, F.col("size_b") % 3)
    profile = F.when(state == 0, "open").when(F.col("size") + F.col("size_b") > 60, "costly").otherwise("works")
    return a.join(b, "down_id").select("id", "down_id", state.alias("state"), profile.alias("profile"))


ZONE = "(row // 3) * 100 + col // 4"


@query(f"""WITH {CELLS}, z AS (SELECT row, col, {ZONE} AS zone FROM c),
p AS (SELECT a.zone AS u, b.zone AS v FROM z a JOIN z b ON (b.row = a.row AND b.col = a.col + 1) OR (b.row = a.row + 1 AND b.col = a.col))
SELECT least(u, v) AS a, greatest(u, v) AS b, count(*) AS border FROM p WHERE u <> v GROUP BY 1, 2""")
def zone_borders(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of zones that touch, with the length of their border: neighbours meet on shifted keys."""
    z = cells(spark, sf).select("row", "col", F.expr("(row div 3) * 100 + col div 4").alias("zone"))
    step = F.explode(F.array(F.struct(F.lit(0).alias("r"), F.lit(1).alias("c")), F.struct(F.lit(1).alias("r"), F.lit(0).alias("c")))).alias("s")
    sent = z.select("row", "col", F.col("zone").alias("v"), step).select((F.col("row") - F.col("s.r")).alias("row"), (F.col("col") - F.col("s.c")).alias("col"), "v")
    met = z.join(sent, ["row", "col"]).where("zone <> v")
    return met.groupBy(F.least("zone", "v").alias("a"), F.greatest("zone", "v").alias("b")).agg(F.count(F.lit(1)).alias("border"))


@query(f"""WITH {CELLS}, v AS (SELECT row, col, value IS NULL AS missing FROM c),
i AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY col) - row_number() OVER (PARTITION BY row, missing ORDER BY col) AS island FROM v)
SELECT row, missing, max(col) AS last, count(*) AS length FROM i GROUP BY row, missing, island""")
def run_length_rows(spark: SparkSession, sf: str) -> DataFrame:
    v = cells(spark, sf).select("row", "col", F.col("value").isNull().alias("missing"))
    island = F.row_number().over(Window.partitionBy("row").orderBy("col")) - F.row_number().over(Window.partitionBy("row", "missing").orderBy("col"))
    return v.withColumn("island", island).groupBy("row", "missing", "island").agg(F.max("col").alias("last"), F.count(F.lit(1)).alias("length")).drop("island")


@query("""
WITH s AS (SELECT s_suppkey, CAST(s_suppkey * 37 % 360 AS DOUBLE) + 0.25 AS lo, CAST(s_suppkey * 37 % 360 AS DOUBLE) + s_suppkey % 13 + 0.75 AS hi FROM supplier),
k AS (SELECT *, unnest(range(CAST(floor(lo / 5) AS BIGINT), CAST(ceil(hi / 5) AS BIGINT))) AS step FROM s)
SELECT s_suppkey, step % 72 AS cell, round(least(hi, (step + 1) * 5.0) - greatest(lo, step * 5.0), 6) AS width FROM k""")
def axis_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Segments cut at cell edges, around the seam: an interval join as an explode to equi-keys."""
    lo = (F.col("s_suppkey") * 37 % 360).cast("double") + 0.25
    rows = table(spark, sf, "supplier").select("s_suppkey", lo.alias("lo"), (lo + F.col("s_suppkey") % 13 + 0.5).alias("hi"))
    rows = rows.withColumn("step", F.explode(F.sequence(F.floor(F.col("lo") / 5), F.ceil(F.col("hi") / 5) - 1)))
    width = F.least(F.col("hi"), (F.col("step") + 1) * 5.0) - F.greatest(F.col("lo"), F.col("step") * 5.0)
    return rows.select("s_suppkey", F.pmod("step", F.lit(72)).alias("cell"), F.round(width, 6).alias("width"))


@query(f"""WITH {CELLS}, b AS (SELECT row, col, row // 6 AS br, col // 6 AS bc, coalesce(value, 0) AS cap FROM c),
o AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY br, bc) AS n, sum(cap) OVER (PARTITION BY br, bc) * 0.5 AS budget, sum(cap) OVER w - cap AS below FROM b WINDOW w AS (PARTITION BY br, bc ORDER BY cap, row, col ROWS UNBOUNDED PRECEDING)),
l AS (SELECT br, bc, min((budget - below) / (n - k + 1)) AS level FROM o WHERE below + cap * (n - k + 1) >= budget AND below <= budget GROUP BY 1, 2)
SELECT row, col, round(least(cap, level), 4) AS given FROM o JOIN l USING (br, bc)""")
def budget_fill(spark: SparkSession, sf: str) -> DataFrame:
    """A block's budget filled to one level, no cell beyond its room; a block has 36 cells at most."""
    b = cells(spark, sf).select("row", "col", F.expr("row div 6").alias("br"), F.expr("col div 6").alias("bc"), F.coalesce("value", F.lit(0.0)).alias("cap"))
    block = Window.partitionBy("br", "bc")
    order = block.orderBy("cap", "row", "col").rowsBetween(Window.unboundedPreceding, 0)
    o = b.select("*", (F.count(F.lit(1)).over(block) - F.row_number().over(block.orderBy("cap", "row", "col")) + 1).alias("left"), (F.sum("cap").over(block) * 0.5).alias("budget"), (F.sum("cap").over(order) - F.col("cap")).alias("below"))
    fits = (F.col("below") + F.col("cap") * F.col("left") >= F.col("budget")) & (F.col("below") <= F.col("budget"))
    level = F.min(F.when(fits, (F.col("budget") - F.col("below")) / F.col("left"))).over(block)
    return o.withColumn("level", level).select("row", "col", F.round(F.least("cap", "level"), 4).alias("given"))
