"""Queries of regions: budgets and categories, layers under offsets, donors with a fallback, priors, reach and re-derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.functions import expr
from terraledger.operators import checks, graph, grid
from terraledger.plans.graphs import TREE, tree
from terraledger.plans.gridded import CELLS, cells
from terraledger.plans.registry import query
from terraledger.plans.relational import cents, r6
from terraledger.sources.tables import table


@query("""
WITH c AS (SELECT n_regionkey, c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS population, CAST(sum(CAST(4000 + c_custkey % 1000 AS DECIMAL(18, 2))) AS DOUBLE) AS capacity, count(*) AS places FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING' GROUP BY 1, 2),
k AS (SELECT *, CASE WHEN NOT population > capacity + greatest(1e-7, abs(capacity) * 1e-12) THEN 'within_start' WHEN NOT population > capacity * 1.1 + greatest(1e-7, abs(capacity * 1.1) * 1e-12) THEN 'within_most' ELSE 'above_most' END AS category FROM c)
SELECT n_regionkey, category, count(*) AS provinces, sum(places)::BIGINT AS places, round(sum(greatest(population - capacity, 0)), 2) AS shortfall FROM k GROUP BY 1, 2""")
def rural_pressure(spark: SparkSession, sf: str) -> DataFrame:
    """Budgets of provinces against two capacities, counted by region."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    rows = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").withColumn("cap", (4000 + F.col("c_custkey") % 1000).cast("double"))
    sums = rows.groupBy("c_nationkey").agg(cents("c_acctbal").alias("population"), cents("cap").alias("capacity"), F.count(F.lit(1)).alias("places")).join(nation, "c_nationkey")
    p, c = F.col("population"), F.col("capacity")
    category = F.when(~expr.above_tolerance(p, c), "within_start").when(~expr.above_tolerance(p, c * 1.1), "within_most").otherwise("above_most")
    return sums.withColumn("category", category).groupBy("n_regionkey", "category").agg(F.count(F.lit(1)).alias("provinces"), F.sum("places").alias("places"), F.round(F.sum(F.greatest(p - c, F.lit(0.0))), 2).alias("shortfall"))


@query(f"""WITH {CELLS}, o AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(dr, dc)),
s AS (SELECT p.row // 2 AS zone_row, p.col // 2 AS zone_col, CASE WHEN l.value IS NULL THEN 'none' WHEN l.value > 910 THEN 'high' ELSE 'low' END AS kind, cos(radians((p.row * 2 + dr) / 4.0)) AS w
      FROM (SELECT row, col FROM c WHERE row % 2 = 0) p, o LEFT JOIN c l ON l.row = p.row + dr AND l.col = p.col + dc)
SELECT zone_row, zone_col, kind, round(sum(w) / sum(sum(w)) OVER (PARTITION BY zone_row, zone_col), 6) AS share FROM s GROUP BY 1, 2, 3""")
def quadrature(spark: SparkSession, sf: str) -> DataFrame:
    """Zones sampled at four offsets in each pixel, weighted by latitude."""
    layer = cells(spark, sf)
    four = F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (0, 1) for b in (0, 1)])).alias("o")
    asked = layer.where("row % 2 = 0").select(F.expr("row div 2").alias("zone_row"), F.expr("col div 2").alias("zone_col"), "row", "col", four)
    asked = asked.select("zone_row", "zone_col", F.cos(F.radians((F.col("row") * 2 + F.col("o.dr")) / 4.0)).alias("w"), (F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col"))
    kind = F.when(F.col("value").isNull(), "none").when(F.col("value") > 910, "high").otherwise("low")
    sums = asked.join(layer, ["row", "col"], "left").groupBy("zone_row", "zone_col", kind.alias("kind")).agg(F.sum("w").alias("w"))
    return sums.select("zone_row", "zone_col", "kind", F.round(F.col("w") / F.sum("w").over(Window.partitionBy("zone_row", "zone_col")), 6).alias("share"))


@query("""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN vec_id % 50 = 0 THEN 1000 + vec_id ELSE label END AS g FROM embeddings),
n AS (SELECT g, count(*) AS n FROM e GROUP BY 1),
d AS (SELECT a.vec_id AS q, b.vec_id AS s, CASE WHEN n.n >= 4 THEN 'group' ELSE 'all' END AS pool, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d2
      FROM e a LEFT JOIN n ON n.g = a.g JOIN e b ON a.vec_id <> b.vec_id AND (coalesce(n.n, 0) < 4 OR b.g = a.g)),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, s) AS place FROM d)
SELECT q AS vec_id, pool, round(quantile_cont(CAST(s AS DOUBLE), 0.25), 6) AS estimate, count(*) AS donors FROM k WHERE place <= 4 GROUP BY 1, 2""")
def donor_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Estimates from the nearest donors of the own group, or of all where it has too few."""
    g = F.when(F.col("vec_id") % 50 == 0, 1000 + F.col("vec_id")).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), g.cast("long").alias("g"))
    out = grid.donor_quantile(rows, rows.withColumn("v", F.col("id")), 4, 0.25, group="g", value="v")
    return out.select(F.col("q").alias("vec_id"), "pool", r6("estimate"), "donors")


@query("""
WITH g AS (SELECT DISTINCT p_type AS grp, length(p_type) * 1.0 AS v FROM part WHERE p_type <> 'PROMO'), o AS (SELECT p_brand AS good, min(p_partkey) * 1.0 AS v FROM part WHERE p_brand IN ('Brand#11', 'Brand#23') GROUP BY 1)
SELECT p_partkey, CAST(coalesce(o.v, g.v, 0.5) AS DOUBLE) AS prior, CASE WHEN o.v IS NOT NULL THEN 'good' WHEN g.v IS NOT NULL THEN 'group' ELSE 'default' END AS source FROM part LEFT JOIN g ON grp = p_type LEFT JOIN o ON good = p_brand""")
def prior_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Defaults below groups below single goods."""
    part = table(spark, sf, "part")
    group = part.where("p_type <> 'PROMO'").select("p_type", F.length("p_type").cast("double").alias("of_group")).distinct()
    good = part.where("p_brand in ('Brand#11', 'Brand#23')").groupBy("p_brand").agg(F.min("p_partkey").cast("double").alias("of_good"))
    rows = part.select("p_partkey", "p_type", "p_brand").join(group, "p_type", "left").join(good, "p_brand", "left")
    source = F.when(F.col("of_good").isNotNull(), "good").when(F.col("of_group").isNotNull(), "group").otherwise("default")
    return rows.select("p_partkey", F.coalesce("of_good", "of_group", F.lit(0.5)).alias("prior"), source.alias("source"))


@query("""
WITH a AS (SELECT sum(CAST(p_retailprice AS DECIMAL(18, 2)))::DOUBLE / sum(CAST(p_retailprice / p_size AS DECIMAL(18, 4)))::DOUBLE AS ref FROM part)
SELECT p_partkey, round(p_retailprice * ref / p_size, 4) AS start, round(p_size * 2.5 * ref / p_size, 4) AS most, round(greatest(p_partkey % 10 * ref / p_size, 5.0), 4) AS floored FROM part, a""")
def absolute_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Absolute columns scaled to a common area, one of them with a floor."""
    part = table(spark, sf, "part")
    whole = part.agg((cents("p_retailprice") / F.sum((F.col("p_retailprice") / F.col("p_size")).cast("decimal(18,4)")).cast("double")).alias("ref"))  # one row
    scale = F.col("ref") / F.col("p_size")
    out = {"start": F.col("p_retailprice") * scale, "most": F.col("p_size") * 2.5 * scale, "floored": F.greatest(F.col("p_partkey") % 10 * scale, F.lit(5.0))}
    return part.join(F.broadcast(whole)).select("p_partkey", *[F.round(c, 4).alias(k) for k, c in out.items()])


@query(f"""WITH {CELLS}, k AS (SELECT row // 3 AS kr, col // 3 AS kc, avg(coalesce(value, 0)) / 2000 AS graze FROM c GROUP BY 1, 2)
SELECT c.row, c.col, round(least(graze, 1 - (c.col % 10) / 10.0), 6) AS grazing FROM c JOIN k ON kr = c.row // 3 AND kc = c.col // 3""")
def nested_grazing(spark: SparkSession, sf: str) -> DataFrame:
    """A coarse layer under fine cells, held to the room that crops leave."""
    fine = cells(spark, sf).withColumn("kr", F.expr("row div 3")).withColumn("kc", F.expr("col div 3"))
    coarse = fine.groupBy("kr", "kc").agg((F.avg(F.coalesce("value", F.lit(0.0))) / 2000).alias("graze"))
    return fine.join(coarse, ["kr", "kc"]).select("row", "col", F.round(F.least("graze", 1 - (F.col("col") % 10) / 10.0), 6).alias("grazing"))


@query("""
WITH s AS (SELECT o_custkey, [o_totalprice, o_orderkey * 2.0, o_custkey * 30.0] AS a, [o_orderkey * 3.0, o_totalprice / 2, o_custkey * 10.0] AS b FROM orders),
m AS (SELECT o_custkey, list_max(list_transform(list_zip(a, b), lambda x: greatest(x[1], x[2]))) AS best FROM s) SELECT o_custkey % 20 AS benchmark, round(quantile_cont(best, 0.5), 4) AS bound, count(*) AS cells FROM m GROUP BY 1""")
def typed_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """The median over cells of the best of two arrays."""
    k, c, t = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    best = F.array_max(F.zip_with(F.array(t, k * 2.0, c * 30.0), F.array(k * 3.0, t / 2, c * 10.0), lambda a, b: F.greatest(a, b)))
    return table(spark, sf, "orders").select((c % 20).alias("benchmark"), best.alias("best")).groupBy("benchmark").agg(F.round(F.percentile("best", 0.5), 4).alias("bound"), F.count(F.lit(1)).alias("cells"))


@query("""SELECT p_partkey, p_retailprice >= 905 AND p_retailprice < 1000 AS band, p_size >= 10 AND p_type IN ('PROMO', 'LARGE') AS historical, p_size % 10 / 10.0 >= 0.3 AND p_brand IN ('Brand#11', 'Brand#12') AS settled, p_type = 'PROMO' AND p_size > 45 AS forbidden FROM part""")
def predicates(spark: SparkSession, sf: str) -> DataFrame:
    """Half-open bands, historical and settled masks, and a combination that must not occur."""
    p, s = F.col("p_retailprice"), F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", ((p >= 905) & (p < 1000)).alias("band"), ((s >= 10) & F.col("p_type").isin("PROMO", "LARGE")).alias("historical"), ((s % 10 / 10.0 >= 0.3) & F.col("p_brand").isin("Brand#11", "Brand#12")).alias("settled"), ((F.col("p_type") == "PROMO") & (s > 45)).alias("forbidden"))


@query("""
WITH x AS (SELECT p_partkey, p_partkey % 30 * 65793 AS rgb FROM part), e AS (SELECT n_nationkey * 65793 AS rgb, n_name, [5, 3, 1, 4, 2][n_regionkey + 1] AS rank FROM nation)
SELECT p_partkey, n_name AS entity, CAST(rank AS INTEGER) AS rank FROM x LEFT JOIN e USING (rgb)""")
def pixel_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels to entities by colour, and a dense lookup by an array."""
    ranks = F.array(*[F.lit(x) for x in (5, 3, 1, 4, 2)])
    colours = table(spark, sf, "nation").select((F.col("n_nationkey") * 65793).cast("long").alias("rgb"), F.col("n_name").alias("entity"), F.get(ranks, F.col("n_regionkey").cast("int")).alias("rank"))
    return table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 30 * 65793).cast("long").alias("rgb")).join(colours, "rgb", "left").select("p_partkey", "entity", "rank")


@query(f"""WITH RECURSIVE {TREE}, e AS (SELECT id AS a, down_id AS b FROM t WHERE down_id IS NOT NULL), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT id AS node, 0 AS d FROM t WHERE size >= 48 UNION SELECT u.b, r.d + 1 FROM r JOIN u ON r.node = u.a WHERE r.d < 40), s AS (SELECT node, min(d) AS d FROM r GROUP BY 1)
SELECT s.node, CAST(s.d AS BIGINT) AS distance, min(n.node) AS next FROM s LEFT JOIN u ON u.a = s.node LEFT JOIN s n ON n.node = u.b AND n.d = s.d - 1 GROUP BY 1, 2""")
def way_to_sea(spark: SparkSession, sf: str) -> DataFrame:
    """The steepest way down the distances: the next node of each node that is reached at all."""
    nodes = tree(spark, sf)
    edges = nodes.where("down_id is not null").select(F.col("id").alias("a"), F.col("down_id").alias("b"))
    return graph.toward_source(edges, graph.distances(edges, nodes.where("size >= 48").select("id")))


@query("""
WITH a AS (SELECT c_nationkey, c_acctbal + 0.0 AS v FROM customer), r AS (SELECT n_regionkey, quantile_cont(v, 0.9) AS p90, max(v) AS top, quantile_cont(v, 0.5) AS median FROM a JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
o AS (SELECT *, lag(median) OVER (ORDER BY n_regionkey) AS earlier FROM r)
SELECT n_regionkey, p90 BETWEEN 8000 AND 9500 AS p90_in_band, top <= 9999.99 AS below_top, coalesce(median >= earlier, true) AS ordered FROM o""")
def development_sanity(spark: SparkSession, sf: str) -> DataFrame:
    """Checks of a score by region: a band for its 90th percentile, its maximum, and the order of the regions' medians (a row a region)."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    q = table(spark, sf, "customer").join(nation, "c_nationkey").groupBy("n_regionkey").agg(F.percentile("c_acctbal", F.array(F.lit(0.5), F.lit(0.9))).alias("q"), F.max("c_acctbal").alias("top"))
    earlier = F.lag(F.col("q")[0]).over(Window.orderBy("n_regionkey"))
    return q.select("n_regionkey", F.col("q")[1].between(8000, 9500).alias("p90_in_band"), (F.col("top") <= 9999.99).alias("below_top"), F.coalesce(F.col("q")[0] >= earlier, F.lit(True)).alias("ordered"))


@query("""
WITH d AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS v FROM orders GROUP BY 1)
SELECT o_custkey AS k, CASE WHEN o_custkey % 23 = 0 THEN 'missing' ELSE 'differs' END AS issue FROM d WHERE o_custkey % 23 = 0 OR o_custkey % 29 = 0""")
def rederived(spark: SparkSession, sf: str) -> DataFrame:
    """A delivered table against its own recomputation, within a tolerance: rows that are gone or differ."""
    own = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(cents("o_totalprice").alias("v"))
    given = own.where("k % 23 <> 0").select("k", (F.col("v") + F.when(F.col("k") % 29 == 0, 0.01).otherwise(1e-9)).alias("given"))
    both = own.join(given, "k", "left")
    return checks.issues(both, "k", {"missing": F.col("given").isNotNull(), "differs": F.col("given").isNull() | checks.close(F.col("given"), F.col("v"), 1e-12, 1e-6)})
