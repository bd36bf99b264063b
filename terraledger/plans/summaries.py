"""Queries of summaries, reshaping, dated intervals and text that is parsed into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.functions import expr
from terraledger.plans.registry import query
from terraledger.plans.relational import SEGMENTS, cents
from terraledger.sources.tables import table


@query("""
SELECT c_mktsegment, count(*) AS n, min(c_acctbal) AS lo, round(quantile_cont(c_acctbal, 0.1), 4) AS p10, round(quantile_cont(c_acctbal, 0.5), 4) AS median,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 4) AS mean, round(quantile_cont(c_acctbal, 0.9), 4) AS p90, max(c_acctbal) AS hi FROM customer GROUP BY 1""")
def multi_stat_summary(spark: SparkSession, sf: str) -> DataFrame:
    q = F.percentile("c_acctbal", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    rows = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"), cents("c_acctbal").alias("s"), q.alias("q"))
    at = lambda k: F.round(F.element_at("q", k), 4)
    return rows.select("c_mktsegment", "n", "lo", at(1).alias("p10"), at(2).alias("median"), F.round(F.col("s") / F.col("n"), 4).alias("mean"), at(3).alias("p90"), "hi")


@query("SELECT c_nationkey, " + ", ".join(f"min(c_custkey) FILTER (WHERE c_mktsegment = '{s}') AS {s.lower()}" for s in SEGMENTS) + " FROM customer GROUP BY 1")
def pivot_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "customer").groupBy("c_nationkey").pivot("c_mktsegment", SEGMENTS).agg(F.min("c_custkey"))
    return wide.select("c_nationkey", *[F.col(s).alias(s.lower()) for s in SEGMENTS])


@query("""
WITH s AS (SELECT l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price FROM lineitem GROUP BY 1)
SELECT l_returnflag, 'quantity' AS kind, quantity AS total FROM s WHERE quantity > 0 UNION ALL SELECT l_returnflag, 'price', price FROM s WHERE price > 0""")
def unpivot_ledger(spark: SparkSession, sf: str) -> DataFrame:
    sums = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(cents("l_quantity").alias("quantity"), cents("l_extendedprice").alias("price"))
    return sums.unpivot("l_returnflag", ["quantity", "price"], "kind", "total").where("total > 0")


@query("""
WITH p AS (SELECT p_size AS w, p_retailprice AS y, avg(p_retailprice) OVER (PARTITION BY p_brand) AS p FROM part),
m AS (SELECT sum(w * y) / sum(w) AS mean FROM p)
SELECT count(*) AS n, round(1 - sum(w * (y - p) * (y - p)) / sum(w * (y - mean) * (y - mean)), 6) AS r2 FROM p, m""")
def weighted_r2(spark: SparkSession, sf: str) -> DataFrame:
    w, y = F.col("p_size"), F.col("p_retailprice")
    rows = table(spark, sf, "part").withColumn("p", F.avg("p_retailprice").over(Window.partitionBy("p_brand")))
    mean = rows.agg((F.sum(w * y) / F.sum(w)).alias("mean"))  # one row
    gap = lambda of: F.sum(w * F.pow(y - F.col(of), F.lit(2)))
    return rows.join(F.broadcast(mean)).agg(F.count(F.lit(1)).alias("n"), F.round(1 - gap("p") / gap("mean"), 6).alias("r2"))


@query("""
SELECT event_id, round(CAST(sum(CAST(value AS DECIMAL(18, 4))) OVER w AS DOUBLE), 4) AS total, min(value) OVER w AS lowest, max(value) OVER w AS highest
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_extremes(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.col("value").cast("decimal(18,4)")).over(w).cast("double")
    return table(spark, sf, "events").select("event_id", F.round(total, 4).alias("total"), F.min("value").over(w).alias("lowest"), F.max("value").over(w).alias("highest"))


@query("""
WITH m AS (SELECT p_type, p_brand, CAST(sum(CAST(p_retailprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS v FROM part GROUP BY 1, 2)
SELECT p_type, p_brand, round(v - first_value(v) OVER (PARTITION BY p_type ORDER BY p_brand), 6) AS effect, row_number() OVER (PARTITION BY p_type ORDER BY p_brand) = 1 AS reference FROM m""")
def relative_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    means = table(spark, sf, "part").groupBy("p_type", "p_brand").agg((cents("p_retailprice") / F.count(F.lit(1))).alias("v"))
    w = Window.partitionBy("p_type").orderBy("p_brand")
    return means.select("p_type", "p_brand", F.round(F.col("v") - F.first("v").over(w), 6).alias("effect"), (F.row_number().over(w) == 1).alias("reference"))


@query("""
WITH s AS (SELECT s_suppkey, s_suppkey % 20 AS first, s_suppkey % 20 + s_suppkey % 4 AS last FROM supplier), e AS (SELECT s_suppkey, unnest(range(first, last + 1)) AS step FROM s)
SELECT step, count(*) AS intervals, max(s_suppkey) AS decides FROM e GROUP BY 1""")
def dated_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """The steps that intervals cover; the last one written decides.  The range join becomes an equi-key."""
    k = F.col("s_suppkey")
    steps = table(spark, sf, "supplier").select("s_suppkey", F.explode(F.sequence(k % 20, k % 20 + k % 4)).alias("step"))
    return steps.groupBy("step").agg(F.count(F.lit(1)).alias("intervals"), F.max("s_suppkey").alias("decides"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def json_measures(spark: SparkSession, sf: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k"))


@query("""
SELECT 'zone' || n_nationkey AS name, 'r' || n_regionkey AS item, 0 AS place FROM nation UNION ALL SELECT 'zone' || n_nationkey, 'c' || n_nationkey % 3, 1 FROM nation""")
def parse_named_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Comments go, then ``name = { items }`` blocks become rows."""
    n = F.col("n_nationkey").cast("string")
    raw = F.concat(F.lit("# old = { x }\nzone"), n, F.lit(" = {  r"), F.col("n_regionkey").cast("string"), F.lit(" # y }\n c"), (F.col("n_nationkey") % 3).cast("string"), F.lit("\n}"))
    block = F.explode(F.regexp_extract_all(F.regexp_replace(raw, r"#[^\n]*", ""), F.lit(r"(\w+\s*=\s*\{[^}]*\})"), F.lit(1))).alias("block")
    named = table(spark, sf, "nation").select(block).select(F.regexp_extract("block", r"^(\w+)", 1).alias("name"), F.trim(F.regexp_extract("block", r"\{\s*([^}]*?)\s*\}", 1)).alias("body"))
    return named.select("name", F.posexplode(F.split("body", r"\s+")).alias("place", "item"))


@query("""
WITH e AS (SELECT user_id, value, last_value(CASE WHEN event_id % 7 = 0 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS header FROM events)
SELECT user_id, header, count(*) AS lines, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS total FROM e WHERE header IS NOT NULL GROUP BY 1, 2""")
def carry_header(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    header = F.last(F.when(F.col("event_id") % 7 == 0, F.col("event_id")), ignorenulls=True).over(w)
    rows = table(spark, sf, "events").withColumn("header", header).where("header is not null")
    return rows.groupBy("user_id", "header").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))


@query("SELECT p_partkey // 40 AS row, CAST(p_partkey % 40 AS INTEGER) AS col, CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS value FROM part")
def parse_text_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a text matrix become cells; the no-data mark becomes missing."""
    cell = F.struct((F.col("p_partkey") % 40).alias("c"), F.when(F.col("p_size") % 7 == 0, -9).otherwise(F.col("p_size")).cast("string").alias("v"))
    lines = table(spark, sf, "part").groupBy(F.expr("p_partkey div 40").alias("row")).agg(F.array_sort(F.collect_list(cell)).alias("l"))
    lines = lines.select("row", F.array_join(F.transform("l", lambda x: x["v"]), " ").alias("line"))
    cells = lines.select("row", F.posexplode(F.split(F.trim("line"), r"\s+")).alias("col", "v"))
    return cells.select("row", "col", F.when(F.col("v") != "-9", F.col("v").cast("double")).alias("value"))


@query("""
WITH x AS (SELECT p_partkey, p_partkey * 2654435 % 16777216 AS rgb FROM part)
SELECT p_partkey, rgb, rgb // 65536 AS red, rgb // 256 % 256 AS green, rgb % 256 AS blue FROM x""")
def hex_colour(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lpad(F.lower(F.hex(F.col("p_partkey") * 2654435 % 16777216)), 6, "0")
    of = lambda start, n: F.conv(F.substring("text", start, n), 16, 10).cast("long")
    return table(spark, sf, "part").select("p_partkey", text.alias("text")).select("p_partkey", of(1, 6).alias("rgb"), of(1, 2).alias("red"), of(3, 2).alias("green"), of(5, 2).alias("blue"))


@query("""
WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 2.0 ELSE 0.5 END + log10(1 + greatest(s_acctbal, 0)) + 0.5 * log10(1 + s_suppkey % 90) + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS score FROM supplier)
SELECT s_suppkey, round(score, 6) AS score, CASE WHEN score >= 7 THEN 3 WHEN score >= 5 THEN 2 WHEN score >= 3 THEN 1 ELSE 0 END AS tier FROM s""")
def port_score(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    rank = F.when(k % 4 == 0, 3.0).when(k % 4 == 1, 2.0).otherwise(0.5)
    score = rank + F.log10(1 + F.greatest(F.col("s_acctbal"), F.lit(0.0))) + 0.5 * F.log10(1 + k % 90) + F.when(k % 5 == 0, 1).otherwise(0)
    tier = expr.overrides(F.lit(0), [(F.col("s") >= 7, 3), (F.col("s") >= 5, 2), (F.col("s") >= 3, 1)])
    return table(spark, sf, "supplier").select("s_suppkey", score.alias("s")).select("s_suppkey", F.round("s", 6).alias("score"), tier.alias("tier"))


@query("""
WITH m AS (SELECT p_partkey, p_size % 12 AS start, unnest(range(0, 12)) AS month FROM part),
v AS (SELECT p_partkey, month, CASE WHEN (month - start + 12) % 12 < 5 THEN list_extract([0.4, 0.7, 1.1, 1.1, 0.6], CAST((month - start + 12) % 12 + 1 AS INTEGER)) * (100 + 10 * month) ELSE 0 END AS need FROM m)
SELECT p_partkey, round(sum(need), 4) AS total, round(max(need), 4) AS peak, count(*) FILTER (WHERE need > 0) AS months FROM v GROUP BY 1""")
def stage_requirements(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve monthly needs by a cyclic stage index."""
    stages = F.array(*[F.lit(x) for x in (0.4, 0.7, 1.1, 1.1, 0.6)])
    at = lambda m: F.pmod(m - F.col("p_size") % 12, F.lit(12))
    need = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda m: F.when(at(m) < 5, F.get(stages, at(m)) * (100 + 10 * m)).otherwise(0.0))
    rows = table(spark, sf, "part").select("p_partkey", need.alias("need"))
    return rows.select("p_partkey", F.round(F.aggregate("need", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.round(F.array_max("need"), 4).alias("peak"), F.size(F.filter("need", lambda x: x > 0)).cast("long").alias("months"))
