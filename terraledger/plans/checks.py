"""Queries of contract checks: each returns what breaks a contract, or where a value lies against its benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.operators import checks
from terraledger.plans.registry import query
from terraledger.plans.relational import cents
from terraledger.sources.tables import table


@query("""
WITH f AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal END AS a FROM customer WHERE c_custkey % 13 <> 0 UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 19 = 0 UNION ALL SELECT -1, 1.0),
n AS (SELECT k, count(*) AS n FROM f GROUP BY 1)
SELECT c_custkey AS k, 'missing' AS issue FROM customer WHERE c_custkey NOT IN (SELECT k FROM f) UNION ALL SELECT k, 'unknown' FROM n WHERE k = -1 UNION ALL SELECT k, 'repeated' FROM n WHERE n > 1
UNION ALL SELECT k, 'not_finite:a' FROM f WHERE a IS NULL UNION ALL SELECT k, 'not_positive' FROM f WHERE a IS NULL OR a < 0""")
def entity_contract(spark: SparkSession, sf: str) -> DataFrame:
    """A table with gaps, repeats and missing values against the inventory that it must cover."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_acctbal").alias("a"))
    gaps = c.where("k % 13 <> 0").withColumn("a", F.when(F.col("k") % 17 != 0, F.col("a")))
    frame = gaps.unionByName(c.where("k % 19 = 0")).unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("k"), F.lit(1.0).alias("a")))
    return checks.entity_contract(frame, "k", c, ["a"], {"not_positive": F.col("a") >= 0})


@query("""
WITH l AS (SELECT o_custkey AS k FROM orders), a AS (SELECT k, count(*) AS n FROM l GROUP BY 1), b AS (SELECT c_custkey AS k FROM customer)
SELECT k, 'left_missing' AS issue FROM b WHERE k NOT IN (SELECT k FROM a) UNION ALL SELECT k, 'left_repeats' FROM a WHERE n > 1 UNION ALL SELECT k, 'right_missing' FROM a WHERE k NOT IN (SELECT k FROM b)""")
def one_to_one_issues(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return checks.one_to_one(orders, customers, "k")


@query("""
WITH s AS (SELECT n_nationkey AS k, n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2) SELECT k, n_name, customers FROM s""")
def population_joined(spark: SparkSession, sf: str) -> DataFrame:
    """Counts put onto entities by a join that must match one to one."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    counts = nations.select("k").join(counts, "k", "left").fillna(0, ["customers"])
    return checks.joined_one_to_one(nations, counts, "k")


@query("""
WITH t AS (SELECT p_partkey, p_size % 9 - 1.0 AS n, p_size % 11 + 0.0 AS s, p_size % 29 - 2.0 AS m, p_size % 2 = 0 AS own FROM part)
SELECT p_partkey, 'negative' AS issue FROM t WHERE n < -1e-6 * greatest(abs(n), abs(s), abs(m), 1) UNION ALL SELECT p_partkey, 'start_below_natural' FROM t WHERE s < n - 1e-6 * greatest(abs(n), abs(s), abs(m), 1)
UNION ALL SELECT p_partkey, 'most_below_start' FROM t WHERE m < s - 1e-6 * greatest(abs(n), abs(s), abs(m), 1) UNION ALL SELECT p_partkey, 'owned_without_room' FROM t WHERE own AND m <= 0""")
def target_order(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size")
    t = table(spark, sf, "part").select("p_partkey", (s % 9 - 1.0).alias("n"), (s % 11 + 0.0).alias("s"), (s % 29 - 2.0).alias("m"), (s % 2 == 0).alias("own"))
    return checks.issues(t, "p_partkey", checks.target_order("n", "s", "m", F.col("own")))


@query("""
WITH l AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18, 2)) ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS DECIMAL(18, 2)) ELSE 0 END)::DOUBLE AS b FROM lineitem GROUP BY 1),
t AS (SELECT *, a * (1 + l_orderkey % 3 / 10.0) AS ma, b * (1 - l_orderkey % 5 / 50.0) AS mb, a + b AS st, a + b + l_orderkey % 2 AS mt FROM l)
SELECT l_orderkey, 'most_sum' AS issue FROM t WHERE abs(ma + mb - mt) > 1e-6 * greatest(abs(mt), 1) UNION ALL SELECT l_orderkey, 'kind_falls' FROM t WHERE ma < a - 1e-6 * greatest(a, 1) OR mb < b - 1e-6 * greatest(b, 1)""")
def ledger_contract(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda c: F.sum(F.when(c, F.col("l_quantity").cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double")
    k = F.col("l_orderkey")
    l = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(of(F.col("l_returnflag") == "A").alias("start_a"), of(F.col("l_returnflag") != "A").alias("start_b"))  # noqa: E741
    t = l.withColumns({"most_a": F.col("start_a") * (1 + k % 3 / 10.0), "most_b": F.col("start_b") * (1 - k % 5 / 50.0)})
    whole = F.col("start_a") + F.col("start_b")
    return checks.issues(t, "l_orderkey", checks.ledger_rules(["a", "b"], {"start": whole, "most": whole + k % 2}))


@query("""
WITH r AS (SELECT p_partkey, 'even' AS rule FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 'large' FROM part WHERE p_size > 40 UNION ALL SELECT p_partkey, 'third' FROM part WHERE p_size % 3 = 0)
SELECT p_partkey, count(*) AS rules FROM r GROUP BY 1 HAVING count(*) > 1""")
def rule_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    named = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "even"), F.when(F.col("p_size") > 40, "large"), F.when(F.col("p_size") % 3 == 0, "third")))
    return checks.assigned(part, part.select("p_partkey", F.explode(named).alias("rule")), "p_partkey", "rule")[1]


@query("""
WITH r AS (SELECT p_partkey, 'even' AS rule FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 'third' FROM part WHERE p_size % 3 = 0), o AS (SELECT p_partkey, min(rule) AS rule FROM r GROUP BY 1 HAVING count(*) = 1)
SELECT p_partkey, rule FROM part LEFT JOIN o USING (p_partkey)""")
def rule_cells(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    named = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "even"), F.when(F.col("p_size") % 3 == 0, "third")))
    return checks.assigned(part.select("p_partkey"), part.select("p_partkey", F.explode(named).alias("rule")), "p_partkey", "rule")[0]


@query("""
WITH b AS (SELECT c_nationkey, c_mktsegment, avg(c_acctbal) AS v FROM customer GROUP BY 1, 2),
j AS (SELECT c_mktsegment, CASE WHEN v IS NULL OR n_regionkey = 3 THEN 'unresolved' WHEN v < 4000 THEN 'below' WHEN v > 5000 THEN 'above' ELSE 'inside' END AS verdict FROM b JOIN nation ON c_nationkey = n_nationkey)
SELECT c_mktsegment, count(*) AS rows, count(*) FILTER (WHERE verdict = 'inside') AS inside, count(*) FILTER (WHERE verdict IN ('below', 'above')) AS outside, count(*) FILTER (WHERE verdict = 'unresolved') AS unresolved,
       round(count(*) FILTER (WHERE verdict = 'inside') / CAST(nullif(count(*) FILTER (WHERE verdict <> 'unresolved'), 0) AS DOUBLE), 6) AS share FROM j GROUP BY 1""")
def benchmark_compare(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_regionkey") != 3, 4000.0).alias("low"), F.lit(5000.0).alias("high"))
    means = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg((cents("c_acctbal") / F.count("c_acctbal")).alias("v"))
    rows = means.join(nation, "c_nationkey").withColumn("verdict", checks.within_range(F.col("v"), F.col("low"), F.col("high")))
    is_ = lambda *v: F.count_if(F.col("verdict").isin(*v))
    out = rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"), is_("inside").alias("inside"), is_("below", "above").alias("outside"), is_("unresolved").alias("unresolved"))
    return out.withColumn("share", F.round(F.col("inside") / F.nullif(F.col("rows") - F.col("unresolved"), F.lit(0)), 6))


@query("""
WITH a AS (SELECT count(*) AS n, count(DISTINCT c_custkey) AS d, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer), b AS (SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
SELECT 'unique_keys' AS name, n = d AS passed FROM a UNION ALL SELECT 'balances_positive', lo >= 0 FROM a UNION ALL SELECT 'balances_bounded', hi <= 10000 FROM a UNION ALL SELECT 'orders_have_customers', n = 0 FROM b""")
def engineering_checks(spark: SparkSession, sf: str) -> DataFrame:
    """A register of named checks in two aggregates."""
    c = table(spark, sf, "customer")
    one = c.agg(F.struct((F.count(F.lit(1)) == F.count_distinct("c_custkey")).alias("unique_keys"), (F.min("c_acctbal") >= 0).alias("balances_positive"), (F.max("c_acctbal") <= 10000).alias("balances_bounded")).alias("s"))
    lost = table(spark, sf, "orders").join(c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").agg((F.count(F.lit(1)) == 0).alias("orders_have_customers"))
    return one.select("s.*").unpivot([], ["unique_keys", "balances_positive", "balances_bounded"], "name", "passed").unionByName(lost.unpivot([], ["orders_have_customers"], "name", "passed"))


@query("""
WITH d AS (SELECT 'Brand#' || i AS brand FROM range(11, 40) r(i)) SELECT p_brand AS brand, count(*) AS uses FROM part WHERE p_brand NOT IN (SELECT brand FROM d) GROUP BY 1""")
def reference_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that are used but not defined."""
    defined = spark.range(11, 40).select(F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("brand"))
    return table(spark, sf, "part").select(F.col("p_brand").alias("brand")).join(defined, "brand", "left_anti").groupBy("brand").agg(F.count(F.lit(1)).alias("uses"))


@query("""
WITH s AS (SELECT s_suppkey, greatest(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 0 END, CASE WHEN s_suppkey % 5 = 0 THEN 3 ELSE 0 END) AS want, s_suppkey % 4 AS level FROM supplier)
SELECT s_suppkey, CAST(want AS INTEGER) AS want, CAST(level AS INTEGER) AS level FROM s WHERE want <> level""")
def flag_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose level is not the largest of their active flags."""
    k = F.col("s_suppkey")
    want = F.greatest(*[F.when(k % p == 0, i).otherwise(0) for i, p in ((1, 2), (2, 3), (3, 5))])
    return table(spark, sf, "supplier").select("s_suppkey", want.cast("int").alias("want"), (k % 4).cast("int").alias("level")).where("want <> level")


@query("""
WITH q AS (SELECT o_orderpriority AS p, quantile_cont(o_totalprice, 0.1) AS lo, quantile_cont(o_totalprice, 0.9) AS hi FROM orders GROUP BY 1)
SELECT a.p AS one, b.p AS other, least(a.hi, b.hi) >= greatest(a.lo, b.lo) AS overlaps, round(greatest(least(a.hi, b.hi) - greatest(a.lo, b.lo), 0) / (greatest(a.hi, b.hi) - least(a.lo, b.lo)), 6) AS share FROM q a JOIN q b ON a.p < b.p""")
def range_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Whether held-out ranges overlap; a row a priority, so the pairs are few."""
    q = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.percentile("o_totalprice", F.array(F.lit(0.1), F.lit(0.9))).alias("q"))
    side = lambda n: q.select(F.col("o_orderpriority").alias(n), F.col("q")[0].alias(f"{n}_lo"), F.col("q")[1].alias(f"{n}_hi"))
    low, high = F.greatest("one_lo", "other_lo"), F.least("one_hi", "other_hi")
    pairs = side("one").join(side("other"), F.col("one") < F.col("other"))
    return pairs.select("one", "other", (high >= low).alias("overlaps"), F.round(F.greatest(high - low, F.lit(0.0)) / (F.greatest("one_hi", "other_hi") - F.least("one_lo", "other_lo")), 6).alias("share"))


@query("""
WITH s AS (SELECT p_partkey, p_retailprice AS t, greatest(p_size % 5 - 2.0, 0) AS a, greatest(p_size % 4 - 1.0, 0) AS b FROM part)
SELECT p_partkey, round(CASE WHEN a + b > 0 THEN t * a / (a + b) ELSE t END, 6) AS clearing, round(CASE WHEN a + b > 0 THEN t * b / (a + b) ELSE 0 END, 6) AS water FROM s""")
def reattribution(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size")
    out = checks.reattributed(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"), F.col("p_retailprice"), {"clearing": s % 5 - 2.0, "water": s % 4 - 1.0})
    return out.select("p_partkey", F.round("clearing", 6).alias("clearing"), F.round("water", 6).alias("water"))
