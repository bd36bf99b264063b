"""Queries of joins, aggregates, windows, sets and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.functions import expr
from terraledger.operators import aggregates as ag
from terraledger.plans.registry import query
from terraledger.sources.tables import table

AT = (0.2, 0.4, 0.6, 0.8)


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def cents(c: str):
    """A sum of money that does not depend on the order of its terms."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def priced_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as cells; the value of some is missing."""
    return table(spark, sf, "part").withColumn("value", F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice")))


PRICED = "SELECT *, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS value FROM part"


@query(f"""
WITH p AS ({PRICED})
SELECT l_suppkey, round(sum(l_quantity * value) / sum(CASE WHEN value IS NOT NULL THEN l_quantity END), 6) AS mean_value,
       round(sum(CASE WHEN value IS NOT NULL THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS coverage, count(*) AS cells
FROM lineitem JOIN p ON l_partkey = p_partkey GROUP BY 1""")
def flagship_capacity(spark: SparkSession, sf: str) -> DataFrame:
    cells = priced_parts(spark, sf).withColumnRenamed("p_partkey", "l_partkey")
    out = ag.overlap_mean(table(spark, sf, "lineitem"), cells, "l_suppkey", "l_partkey", "l_quantity", "value")
    return out.select("l_suppkey", r6("mean_value"), r6("coverage"), "cells")


@query("""
WITH s AS (SELECT l_suppkey, p_type, sum(l_quantity) AS w FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
h AS (SELECT *, w / sum(w) OVER (PARTITION BY l_suppkey) AS share FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY share DESC, p_type) AS k, count(*) OVER (PARTITION BY l_suppkey) AS classes FROM h)
SELECT l_suppkey, p_type, round(share, 6) AS dominance, classes FROM r WHERE k = 1""")
def class_share_winner(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    shares = ag.class_shares(table(spark, sf, "lineitem").join(part, "l_partkey"), "l_suppkey", "p_type", "l_quantity")
    return ag.winner(shares, "l_suppkey", "p_type").select("l_suppkey", "p_type", r6("dominance"), "classes")


@query("""
WITH b AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS q FROM customer)
SELECT c_custkey, CAST(1 + len(list_filter(q, lambda x: x <= c_acctbal)) AS INTEGER) AS grade FROM customer, b""")
def grade_from_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer")
    bounds = ag.quantile_bounds(rows, "c_acctbal", AT)  # one row
    return rows.join(F.broadcast(bounds)).select("c_custkey", expr.grade(F.col("c_acctbal"), F.col("bounds")).alias("grade"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(1 + len(list_filter([1000.0, 3000.0, 5000.0, 8000.0], lambda x: x <= c_acctbal)) AS INTEGER) END AS grade
FROM customer""")
def frozen_threshold_grade(spark: SparkSession, sf: str) -> DataFrame:
    bounds = F.array(*[F.lit(x) for x in (1000.0, 3000.0, 5000.0, 8000.0)])
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return table(spark, sf, "customer").select("c_custkey", expr.grade(known, bounds).alias("grade"))


@query("""
WITH s AS (SELECT l_suppkey, p_size % 5 + 1 AS g, sum(l_quantity) AS w FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT l_suppkey, CAST(least(greatest(floor(round(sum(w * g) / sum(w), 9) + 0.5), 1), 5) AS INTEGER) AS grade FROM s GROUP BY 1""")
def grade_mean_half_up(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 5 + 1).alias("g"))
    sums = table(spark, sf, "lineitem").join(part, "l_partkey").groupBy("l_suppkey").agg((F.sum(F.col("l_quantity") * F.col("g")) / F.sum("l_quantity")).alias("m"))
    return sums.select("l_suppkey", expr.half_up(F.round("m", 9), 1, 5).alias("grade"))


@query("""
SELECT l_partkey, l_orderkey AS best_order, l_extendedprice AS price FROM (
    SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey) AS k FROM lineitem) WHERE k = 1""")
def best_of_n_argmax(spark: SparkSession, sf: str) -> DataFrame:
    best = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max(F.struct(F.col("l_extendedprice").alias("price"), (-F.col("l_orderkey")).alias("order"))).alias("m"))
    return best.select("l_partkey", (-F.col("m.order")).alias("best_order"), "m.price")


@query("""
WITH o AS (SELECT DISTINCT l_partkey, l_suppkey, s_acctbal FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey % 17, l_suppkey) AS k FROM o)
SELECT p_partkey, max(CASE WHEN k = 1 THEN l_suppkey END) AS first_choice, max(CASE WHEN k = 2 THEN l_suppkey END) AS second_choice,
       CASE WHEN count(k) = 0 THEN 3 ELSE 2 END AS state
FROM part LEFT JOIN r ON p_partkey = l_partkey GROUP BY 1""")
def preference_pick(spark: SparkSession, sf: str) -> DataFrame:
    viable = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    offers = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct().join(viable, "l_suppkey")
    listed = offers.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array_sort(F.collect_list(F.struct((F.col("l_suppkey") % 17).alias("o"), F.col("l_suppkey").alias("s")))).alias("l"))
    pick = lambda k: F.get("l", F.lit(k)).getField("s")
    return table(spark, sf, "part").select("p_partkey").join(listed, "p_partkey", "left").select("p_partkey", pick(0).alias("first_choice"), pick(1).alias("second_choice"), F.when(F.col("l").isNull(), 3).otherwise(2).alias("state"))


@query("""
WITH f AS (SELECT c_custkey, c_mktsegment, floor(c_acctbal / 100) AS v FROM customer),
r AS (SELECT *, rank() OVER (PARTITION BY c_mktsegment ORDER BY v) + (count(*) OVER (PARTITION BY c_mktsegment, v) - 1) / 2.0 AS a, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM f)
SELECT c_custkey, round((a - 0.5) / n - 0.5, 6) AS uniform FROM r""")
def rank_uniform(spark: SparkSession, sf: str) -> DataFrame:
    v = F.floor(F.col("c_acctbal") / 100)
    rows = table(spark, sf, "customer").withColumn("v", v).withColumn("a", ag.average_rank(F.col("v"), "c_mktsegment"))
    n = F.count(F.lit(1)).over(Window.partitionBy("c_mktsegment"))
    return rows.select("c_custkey", F.round((F.col("a") - 0.5) / n - 0.5, 6).alias("uniform"))


@query("""
SELECT r_name, n_name, CAST(grouping(r_name) * 2 + grouping(n_name) AS BIGINT) AS level, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def hierarchy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.rollup("r_name", "n_name").agg(F.grouping_id().cast("long").alias("level"), cents("c_acctbal").alias("balance"), F.count(F.lit(1)).alias("customers"))


@query(f"""
WITH p AS ({PRICED}), g AS (SELECT p_type, quantile_cont(value, 0.5) AS m FROM p GROUP BY 1), a AS (SELECT quantile_cont(value, 0.5) AS m FROM p)
SELECT p_partkey, round(coalesce(value, g.m, a.m), 6) AS filled, CASE WHEN value IS NOT NULL THEN 'own' WHEN g.m IS NOT NULL THEN 'group' ELSE 'all' END AS fill_source
FROM p LEFT JOIN g USING (p_type), a""")
def group_median_impute(spark: SparkSession, sf: str) -> DataFrame:
    return ag.median_impute(priced_parts(spark, sf), "value", "p_type").select("p_partkey", r6("filled"), "fill_source")


@query("""
SELECT p_brand, p_type, count(*) AS n, min(p_retailprice) AS lo, max(p_retailprice) AS hi, round(max(p_retailprice) / min(p_retailprice), 6) AS ratio, count(*) = 1 AS singleton
FROM part GROUP BY 1, 2""")
def profile_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_retailprice")
    return table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.min(p).alias("lo"), F.max(p).alias("hi"), F.round(F.max(p) / F.min(p), 6).alias("ratio"), (F.count(F.lit(1)) == 1).alias("singleton"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("SELECT r_name, " + ", ".join(f"count(*) FILTER (WHERE c_mktsegment = '{s}') AS {s.lower()}" for s in SEGMENTS) + """
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name").agg(*[F.count_if(F.col("c_mktsegment") == s).alias(s.lower()) for s in SEGMENTS])


@query("""
WITH o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS spent FROM orders GROUP BY 1),
j AS (SELECT c_mktsegment, c_acctbal * 100 AS cap, coalesce(spent, 0) AS spent FROM customer LEFT JOIN o ON c_custkey = o_custkey)
SELECT coalesce(c_mktsegment, 'all') AS segment, count(*) AS n, CAST(sum(CASE WHEN spent > cap THEN 1 ELSE 0 END) AS BIGINT) AS over_capacity,
       round(quantile_cont(spent, 0.5), 2) AS median_spent FROM j GROUP BY GROUPING SETS ((c_mktsegment), ())""")
def fill_blocks(spark: SparkSession, sf: str) -> DataFrame:
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(cents("o_totalprice").alias("spent"))
    rows = table(spark, sf, "customer").join(spent, "c_custkey", "left").select("c_mktsegment", (F.col("c_acctbal") * 100).alias("cap"), F.coalesce("spent", F.lit(0.0)).alias("spent"))
    out = rows.groupingSets([["c_mktsegment"], []], "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("spent") > F.col("cap")).alias("over_capacity"), F.round(F.percentile("spent", 0.5), 2).alias("median_spent"))
    return out.select(F.coalesce("c_mktsegment", F.lit("all")).alias("segment"), "n", "over_capacity", "median_spent")


@query("""
WITH j AS (SELECT p_retailprice AS y, avg(p_retailprice) OVER (PARTITION BY p_brand) AS p FROM part), e AS (SELECT *, abs(p - y) / greatest(y, 1e-12) AS rel FROM j)
SELECT count(*) AS n, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse,
       round(quantile_cont(rel, 0.5), 6) AS medape, round(quantile_cont(rel, 0.9), 6) AS p90, round(avg(CASE WHEN rel <= 0.2 THEN 1.0 ELSE 0 END), 6) AS within20,
       round(avg(CASE WHEN rel <= 0.5 THEN 1.0 ELSE 0 END), 6) AS within50, round(abs(avg(p - y)), 6) AS bias FROM e""")
def metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").withColumn("p", F.avg("p_retailprice").over(Window.partitionBy("p_brand")))
    out = ag.fit_metrics(rows, "p_retailprice", "p").withColumn("bias", F.abs("bias"))
    return out.select("n", *[r6(c) for c in out.columns if c != "n"])


@query("""
WITH e AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, event_type, min(ts) AS started, count(*) AS length FROM e GROUP BY user_id, event_type, island HAVING count(*) >= 3""")
def run_length(spark: SparkSession, sf: str) -> DataFrame:
    by_user, by_type = Window.partitionBy("user_id").orderBy("ts", "event_id"), Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    rows = table(spark, sf, "events").withColumn("island", F.row_number().over(by_user) - F.row_number().over(by_type))
    return rows.groupBy("user_id", "event_type", "island").agg(F.min("ts").alias("started"), F.count(F.lit(1)).alias("length")).where("length >= 3").drop("island")


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey IN (3, 7) THEN 'pinned' WHEN n_nationkey BETWEEN 5 AND 9 THEN 'band' WHEN n_regionkey = 2 THEN 'region' ELSE 'default' END AS rule FROM nation""")
def ordered_overrides(spark: SparkSession, sf: str) -> DataFrame:
    rules = [(F.col("n_nationkey").isin(3, 7), "pinned"), (F.col("n_nationkey").between(5, 9), "band"), (F.col("n_regionkey") == 2, "region")]
    return table(spark, sf, "nation").select("n_nationkey", expr.overrides(F.lit("default"), rules).alias("rule"))


@query("""
SELECT p_partkey, p_brand IN ('Brand#11', 'Brand#12') AND p_size IN (1, 2, 3, 4, 5) OR p_type IN ('PROMO') OR p_brand IN ('Brand#55') AS gate FROM part""")
def gate_or_of_and(spark: SparkSession, sf: str) -> DataFrame:
    rules = [{"p_brand": ["Brand#11", "Brand#12"], "p_size": [1, 2, 3, 4, 5]}, {"p_type": ["PROMO"]}, {"p_brand": ["Brand#55"]}]
    return table(spark, sf, "part").select("p_partkey", expr.gates(rules).alias("gate"))


@query("""
WITH l AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS lines, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(o_totalprice - coalesce(lines, 0), 2) AS residual, CASE WHEN lines IS NULL THEN 'no_lines' WHEN abs(o_totalprice - lines) <= 0.005 THEN 'exact' WHEN lines > o_totalprice THEN 'over' ELSE 'under' END AS status,
       round(CASE WHEN o_totalprice > 0 THEN lines / o_totalprice END, 6) AS share FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def ledger_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(cents("l_extendedprice").alias("lines"))
    gap = F.col("o_totalprice") - F.coalesce("lines", F.lit(0.0))
    status = F.when(F.col("lines").isNull(), "no_lines").when(F.abs(gap) <= 0.005, "exact").when(F.col("lines") > F.col("o_totalprice"), "over").otherwise("under")
    return table(spark, sf, "orders").join(lines, "o_orderkey", "left").select("o_orderkey", F.round(gap, 2).alias("residual"), status.alias("status"), F.round(expr.guarded(F.col("lines"), F.col("o_totalprice")), 6).alias("share"))


@query("""
WITH a AS (SELECT CAST(sum(p_size) AS DOUBLE) / count(*) AS reference FROM part)
SELECT p_partkey, round(p_retailprice * reference / p_size, 3) AS scaled, round(reference, 6) AS reference FROM part, a""")
def equal_area_scale(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    whole = part.agg((F.sum("p_size").cast("double") / F.count(F.lit(1))).alias("reference"))  # one row
    return part.join(F.broadcast(whole)).select("p_partkey", F.round(F.col("p_retailprice") * F.col("reference") / F.col("p_size"), 3).alias("scaled"), r6("reference"))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(n, 0) AS n, coalesce(q, 0.0) AS quantity, n IS NOT NULL AS modelled FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def complete_inventory(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    modelled = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.lit(True).alias("modelled"))
    return orders.join(modelled, "o_orderkey", "left").select("o_orderkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("quantity", F.lit(0.0)).alias("quantity"), F.coalesce("modelled", F.lit(False)).alias("modelled"))


@query("""
SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'negative' END, CASE WHEN c_acctbal > 9000 THEN 'large' END, CASE WHEN length(c_name) <> 18 THEN 'name' END, CASE WHEN c_nationkey NOT IN (SELECT n_nationkey FROM nation) THEN 'nation' END) AS issues FROM customer""")
def validate_frame(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("known"))
    rows = table(spark, sf, "customer").join(known, "c_nationkey", "left")
    found = F.array_compact(F.array(F.when(F.col("c_acctbal") < 0, "negative"), F.when(F.col("c_acctbal") > 9000, "large"), F.when(F.length("c_name") != 18, "name"), F.when(F.col("known").isNull(), "nation")))
    return rows.select("c_custkey", F.array_join(found, ",").alias("issues"))


@query("""
WITH s AS (SELECT o_custkey, CAST(sum(CASE WHEN year(o_orderdate) = 1998 THEN CAST(o_totalprice AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN year(o_orderdate) = 1999 THEN CAST(o_totalprice AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE) AS b FROM orders GROUP BY 1),
t AS (SELECT CASE WHEN a > 0 AND b = 0 THEN 'resolved' WHEN a = 0 AND b > 0 THEN 'new' WHEN a > 0 THEN 'kept' ELSE 'none' END AS state, CASE WHEN a > 0 THEN b / a END AS r FROM s)
SELECT state, count(*) AS n, round(quantile_cont(r, 0.5), 6) AS median_ratio FROM t GROUP BY 1""")
def before_after(spark: SparkSession, sf: str) -> DataFrame:
    money = F.col("o_totalprice").cast("decimal(18,2)")
    of = lambda y: F.sum(F.when(F.year("o_orderdate") == y, money).otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double")
    rows = table(spark, sf, "orders").groupBy("o_custkey").agg(of(1998).alias("a"), of(1999).alias("b"))
    state = F.when((F.col("a") > 0) & (F.col("b") == 0), "resolved").when((F.col("a") == 0) & (F.col("b") > 0), "new").when(F.col("a") > 0, "kept").otherwise("none")
    return rows.select(state.alias("state"), expr.guarded(F.col("b"), F.col("a")).alias("r")).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.round(F.percentile("r", 0.5), 6).alias("median_ratio"))


@query("""
WITH r AS (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer)
SELECT c_nationkey, place, c_custkey, c_acctbal FROM r WHERE place <= 3""")
def top_k_per_group(spark: SparkSession, sf: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey"))
    return table(spark, sf, "customer").withColumn("place", place).where("place <= 3").select("c_nationkey", F.col("place").cast("long").alias("place"), "c_custkey", "c_acctbal")


@query("""
SELECT o_orderkey AS id, 'missing' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT DISTINCT l_orderkey, 'extra' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def set_equality(spark: SparkSession, sf: str) -> DataFrame:
    return ag.one_sided(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")))


@query("""
SELECT c_nationkey, count(*) AS n, sha256(string_agg(sha256(c_custkey::VARCHAR || '|' || CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR)), ',' ORDER BY c_custkey)) AS digest FROM customer GROUP BY 1""")
def stable_hash(spark: SparkSession, sf: str) -> DataFrame:
    row = F.sha2(F.concat_ws("|", F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("decimal(18,2)").cast("string")), 256)
    rows = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("h")))).alias("l"))
    return rows.select("c_nationkey", "n", F.sha2(F.array_join(F.transform("l", lambda x: x["h"]), ","), 256).alias("digest"))


@query("""
WITH g AS (SELECT a.v AS lift, b.v AS tail FROM (VALUES (0.5), (1.0), (1.5)) a(v), (VALUES (0.8), (1.0)) b(v)),
m AS (SELECT lift, tail, quantile_cont(CASE WHEN c_acctbal > 5000 THEN c_acctbal * tail ELSE c_acctbal * lift END, 0.5) AS median FROM customer, g GROUP BY 1, 2)
SELECT CAST(lift AS DOUBLE) AS lift, CAST(tail AS DOUBLE) AS tail, round(median, 4) AS median, rank() OVER (ORDER BY round(abs(median - 4500), 4)) AS place FROM m""")
def sensitivity_grid(spark: SparkSession, sf: str) -> DataFrame:
    grid = F.array(*[F.struct(F.lit(a).alias("lift"), F.lit(b).alias("tail")) for a in (0.5, 1.0, 1.5) for b in (0.8, 1.0)])
    rows = table(spark, sf, "customer").withColumn("g", F.explode(grid)).select("g.lift", "g.tail", F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal") * F.col("g.tail")).otherwise(F.col("c_acctbal") * F.col("g.lift")).alias("v"))
    out = rows.groupBy("lift", "tail").agg(F.percentile("v", 0.5).alias("m"))
    return out.select("lift", "tail", F.round("m", 4).alias("median"), F.rank().over(Window.orderBy(F.round(F.abs(F.col("m") - 4500), 4))).cast("long").alias("place"))
