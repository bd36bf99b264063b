"""Queries of tallies, orders, candidates and what is written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.operators import fits
from terraledger.plans.graphs import TREE, tree
from terraledger.plans.registry import query
from terraledger.plans.relational import cents
from terraledger.sources import sinks
from terraledger.sources.lineage import shared_folder
from terraledger.sources.tables import table, text_ids_csv


@query("""SELECT CAST(floor(o_totalprice / 10000) AS BIGINT) AS bin, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS weight FROM orders GROUP BY 1""")
def weighted_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(F.floor(F.col("o_totalprice") / 10000).alias("bin")).agg(F.count(F.lit(1)).alias("n"), cents("o_totalprice").alias("weight"))


@query("""SELECT l_partkey % 50 AS cell, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS added, max(l_extendedprice) AS highest, min(l_extendedprice) AS lowest FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""")
def scatter_extremes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").where("l_returnflag <> 'N'")
    return rows.groupBy((F.col("l_partkey") % 50).alias("cell")).agg(cents("l_quantity").alias("added"), F.max("l_extendedprice").alias("highest"), F.min("l_extendedprice").alias("lowest"))


@query("""
WITH f AS (SELECT l_suppkey, p_size % 4 AS cls, l_quantity * 0.25 AS part, l_quantity AS whole FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size % 4 > 0),
c AS (SELECT l_suppkey, cls, sum(part) AS s FROM f GROUP BY 1, 2), t AS (SELECT l_suppkey, sum(l_quantity) * 0.25 AS t FROM lineitem GROUP BY 1), k AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY s DESC, cls) AS k, sum(s) OVER (PARTITION BY l_suppkey) AS known FROM c)
SELECT l_suppkey, CAST(cls AS INTEGER) AS cls, round(s / known, 6) AS dominance, round(known / t, 6) AS coverage, s / known < 0.5 OR known / t < 0.5 AS unsure FROM k JOIN t USING (l_suppkey) WHERE k = 1""")
def fraction_winner(spark: SparkSession, sf: str) -> DataFrame:
    """Class fractions of cells, kept as arrays, summed to entities: winner, dominance, coverage and confidence."""
    size = F.col("p_size") % 4
    cells = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.array(*[F.when(size == k, 0.25).otherwise(0.0) for k in (1, 2, 3)]).alias("shares"))
    rows = table(spark, sf, "lineitem").join(cells, "l_partkey")
    sums = rows.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("all"), *[F.sum(F.col("l_quantity") * F.col("shares")[k]).alias(f"s{k}") for k in range(3)])
    best = F.array_max(F.array(*[F.struct(F.col(f"s{k}").alias("s"), F.lit(-k - 1).alias("k")) for k in range(3)]))
    known = F.col("s0") + F.col("s1") + F.col("s2")
    out = sums.where(known > 0).select("l_suppkey", (-best["k"]).cast("int").alias("cls"), (best["s"] / known).alias("d"), (known / (F.col("all") * 0.25)).alias("c"))
    return out.select("l_suppkey", "cls", F.round("d", 6).alias("dominance"), F.round("c", 6).alias("coverage"), ((F.col("d") < 0.5) | (F.col("c") < 0.5)).alias("unsure"))


@query(f"""WITH {TREE} SELECT id % 40 AS river, count(*) AS reaches, round(avg(CASE WHEN size >= 25 THEN 1.0 ELSE 0 END), 6) AS converted, round(avg(CASE WHEN down_id IS NOT NULL THEN 1.0 ELSE 0 END), 6) AS connected FROM t GROUP BY 1""")
def river_shares(spark: SparkSession, sf: str) -> DataFrame:
    share = lambda c, n: F.round(F.avg(c.cast("double")), 6).alias(n)
    return tree(spark, sf).groupBy((F.col("id") % 40).alias("river")).agg(F.count(F.lit(1)).alias("reaches"), share(F.col("size") >= 25, "converted"), share(F.col("down_id").isNotNull(), "connected"))


@query("""
WITH e AS (SELECT user_id, event_id, event_id % 5 = 0 AS blocked, sum(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS piece FROM events)
SELECT user_id, CAST(piece AS BIGINT) AS piece, count(*) AS points, min(event_id) AS lowest FROM e WHERE NOT blocked GROUP BY 1, 2 HAVING count(*) >= 2""")
def split_at_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Paths cut at blocked points; pieces of one point go."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = table(spark, sf, "events").withColumn("blocked", F.col("event_id") % 5 == 0).withColumn("piece", F.sum(F.col("blocked").cast("long")).over(order))
    return rows.where("not blocked").groupBy("user_id", "piece").agg(F.count(F.lit(1)).alias("points"), F.min("event_id").alias("lowest")).where("points >= 2")


@query(f"""WITH {TREE}, p AS (SELECT id // 3 AS pixel, size % 4 AS state, size AS reach_rank, id FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY pixel ORDER BY state DESC, reach_rank DESC, id) AS k FROM p)
SELECT pixel, CAST(state AS BIGINT) AS state, id AS reach FROM r WHERE k = 1""")
def state_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Of the reaches on a pixel the higher state wins, then the higher rank, then the smaller id."""
    rank = F.max(F.struct((F.col("size") % 4).alias("state"), F.col("size").alias("rank"), (-F.col("id")).alias("o"))).alias("m")
    return tree(spark, sf).groupBy(F.expr("id div 3").alias("pixel")).agg(rank).select("pixel", F.col("m.state").cast("long").alias("state"), (-F.col("m.o")).alias("reach"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The hundred largest: a limit is what is asked for here."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("""
WITH o(p_type, o) AS (VALUES ('PROMO', 1), ('STANDARD', 2), ('LARGE', 3)), s AS (SELECT p_type, coalesce(o, 99) AS o, p_size, count(*) AS n FROM part LEFT JOIN o USING (p_type) GROUP BY 1, 2, 3)
SELECT p_type, p_size, n, row_number() OVER (ORDER BY o, p_type, n DESC, p_size) AS place FROM s""")
def category_order(spark: SparkSession, sf: str) -> DataFrame:
    """A given order of categories, then values; the window spans the few pairs of type and size."""
    given = F.create_map(*[F.lit(x) for k in (("PROMO", 1), ("STANDARD", 2), ("LARGE", 3)) for x in k])
    sizes = table(spark, sf, "part").groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.coalesce(F.try_element_at(given, F.col("p_type")), F.lit(99)), "p_type", F.desc("n"), "p_size"))
    return sizes.select("p_type", "p_size", "n", place.cast("long").alias("place"))


@query("""
WITH q AS (SELECT quantile_cont(abs(c_acctbal), [0.25, 0.5, 0.75]) AS a FROM customer), g AS (SELECT x.i, f.v AS f, a[x.i] / 5 * f.v AS unit FROM q, (VALUES (1), (2), (3)) x(i), (VALUES (0.5), (1.0), (2.0)) f(v)),
e AS (SELECT i, f, unit, sum(abs(least(greatest(round_even(abs(c_acctbal) / unit, 0), 0), 20) * unit - abs(c_acctbal))) AS error FROM customer, g GROUP BY 1, 2, 3)
SELECT CAST(i AS INTEGER) AS i, CAST(f AS DOUBLE) AS f, CAST(greatest(100, round(unit / 100) * 100) AS DOUBLE) AS unit FROM e ORDER BY error, i, f LIMIT 1""")
def unit_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The unit of least quantisation error over quantiles and factors, rounded to hundreds."""
    rows = table(spark, sf, "customer").select(F.abs("c_acctbal").alias("v"))
    q = rows.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("a"))  # one row
    units = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f"), (F.col("a")[i - 1] / 5 * f).alias("unit")) for i in (1, 2, 3) for f in (0.5, 1.0, 2.0)])
    tried = rows.join(F.broadcast(q.select(units.alias("g")))).withColumn("g", F.explode("g")).select("v", "g.*")
    n = F.least(F.greatest(F.bround(F.col("v") / F.col("unit")), F.lit(0.0)), F.lit(20.0))
    errors = tried.groupBy("i", "f", "unit").agg(F.sum(F.abs(n * F.col("unit") - F.col("v"))).alias("error"))
    best = errors.agg(F.min_by(F.struct("i", "f", "unit"), F.struct("error", "i", "f")).alias("b"))
    return best.select("b.i", "b.f", F.greatest(F.lit(100.0), F.round(F.col("b.unit") / 100) * 100).alias("unit"))


@query("""
WITH p AS (SELECT p_partkey % 5 AS fold, CAST(p_size AS DOUBLE) AS x, p_retailprice + p_size * 3 AS y FROM part),
b AS (SELECT f.fold, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM p, (SELECT DISTINCT fold FROM p) f WHERE p.fold <> f.fold GROUP BY 1)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(1 - sum(pow(y - i - s * x, 2)) / (var_pop(y) * count(*)), 5) AS r2, round(avg(abs(y - i - s * x)), 4) AS mae FROM p JOIN b USING (fold) GROUP BY 1""")
def held_out_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Each fold predicted by the fit on all others: one pass of sums, from which a fold's own are taken away."""
    rows = table(spark, sf, "part").select((F.col("p_partkey") % 5).cast("int").alias("fold"), F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") + F.col("p_size") * 3).alias("y"))
    beta = fits.held_out(rows, "fold", [F.col("x")], F.col("y"))
    coefs = F.create_map(*[c for k, b in beta.items() for c in (F.lit(k), F.array(*[F.lit(float(v)) for v in b]))])
    gap = F.col("y") - F.element_at(coefs, F.col("fold"))[0] - F.element_at(coefs, F.col("fold"))[1] * F.col("x")
    out = rows.withColumn("g", gap).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.round(1 - F.sum(F.col("g") * F.col("g")) / (F.var_pop("y") * F.count(F.lit(1))), 5).alias("r2"), F.round(F.avg(F.abs("g")), 4).alias("mae"))
    return out


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'a' WHEN c_custkey % 3 = 1 THEN 'b' END AS crop, c_acctbal % 7 AS lo, c_acctbal % 5 AS hi, c_nationkey FROM customer),
v AS (SELECT *, c_nationkey % 4 = 0 AS outside, lo > 0 OR hi > 0 AS viable FROM c)
SELECT c_custkey, CASE WHEN outside THEN 1 WHEN crop IS NULL THEN 4 WHEN viable THEN 2 WHEN c_custkey % 2 = 0 THEN 3 WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 5 ELSE 6 END AS state FROM v""")
def assignment_states(spark: SparkSession, sf: str) -> DataFrame:
    """Six states of an assignment by preference: outside, assigned, listed but not viable, unresolved, none viable, unknown."""
    k = F.col("c_custkey")
    lo, hi = F.col("c_acctbal") % 7, F.col("c_acctbal") % 5
    crop = F.when(k % 3 == 0, "a").when(k % 3 == 1, "b")
    state = F.when(F.col("c_nationkey") % 4 == 0, 1).when(crop.isNull(), 4).when((lo > 0) | (hi > 0), 2).when(k % 2 == 0, 3).when(lo.isNotNull() & hi.isNotNull(), 5).otherwise(6)
    return table(spark, sf, "customer").select("c_custkey", state.alias("state"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal / 7 AS seventh, CASE WHEN c_custkey % 5 <> 0 THEN 'nan' END AS tag FROM customer""")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Text with fixed digits written and read back without any guess: a tag spelled nan stays a tag, missing stays missing."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") / 7).alias("seventh"), F.when(F.col("c_custkey") % 5 != 0, "nan").alias("tag"))
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    sinks.write_csv(rows, path, digits=17)
    return text_ids_csv(spark, path).select("id", "name", F.col("seventh").cast("double").alias("seventh"), F.nullif("tag", F.lit("")).alias("tag"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_retailprice END AS price FROM part""")
def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Non-finite numbers become null in JSON."""
    s = F.col("p_size")
    price = F.when(s % 3 == 0, F.col("p_retailprice")).when(s % 3 == 1, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    sinks.write_json(table(spark, sf, "part").select("p_partkey", price.alias("price")), path)
    return spark.read.schema("p_partkey long, price double").json(path)


@query("""SELECT 'nation' AS name, '1' AS version, count(*) AS rows, 'n_nationkey,n_name' AS columns, 0 AS broken FROM nation UNION ALL SELECT 'region', '1', count(*), 'r_regionkey,r_name', 0 FROM region""")
def contract_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A contract written with its manifest, and checked against it."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    tables = {"nation": table(spark, sf, "nation").select("n_nationkey", "n_name"), "region": table(spark, sf, "region").select("r_regionkey", "r_name")}
    manifest = sinks.write_contract(tables, path, "1")
    wrong = sinks.broken(spark, path, "1").groupBy("name").agg(F.count(F.lit(1)).cast("int").alias("broken"))
    return manifest.join(wrong, "name", "left").select("name", "version", "rows", "columns", F.coalesce("broken", F.lit(0)).alias("broken"))
