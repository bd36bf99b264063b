"""Queries of scalar physics, ledgers and twelve-month folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.functions import expr
from terraledger.plans.registry import query
from terraledger.plans.relational import cents, r6
from terraledger.sources.tables import table


@query("""
WITH a AS (SELECT p_partkey, p_size * 100.0 / 0.88 * 1 * (p_size % 4) / 4.0 AS annual FROM part)
SELECT p_partkey, round(annual, 6) AS annual, round(annual * 0.9 * 3400 * (1 - 0.1) * (1 - 0.15), 4) AS net, round(annual * 0.9 * 3400 * (1 - 0.1) * (1 - 0.15) / (2500.0 * 365), 6) AS people FROM a""")
def food_chain(spark: SparkSession, sf: str) -> DataFrame:
    annual, _, net = expr.annual_food(F.col("p_size") * 100.0, 0.88, 1.0, (F.col("p_size") % 4) / 4.0, 0.9, 3400.0, 0.1, 0.15)
    return table(spark, sf, "part").select("p_partkey", F.round(annual, 6).alias("annual"), F.round(net, 4).alias("net"), F.round(expr.people(net), 6).alias("people"))


@query("""
WITH s AS (SELECT p_partkey, p_size / 50.0 AS p, CASE WHEN p_size % 7 <> 0 THEN p_size * 10.0 END AS low, p_size * 8.0 + 40 AS hr, p_size * 12.0 AS hi FROM part),
d AS (SELECT *, CASE WHEN low IS NOT NULL THEN (1 - p) * low + p * greatest(hr, low) END AS dry FROM s)
SELECT p_partkey, round(dry, 6) AS dry, round(CASE WHEN dry IS NOT NULL THEN greatest(dry, (1 - p) * low + p * greatest(hi, low)) END, 6) AS wet FROM d""")
def management_envelope(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    dry, wet = expr.envelope(size / 50.0, F.when(size % 7 != 0, size * 10.0), size * 8.0 + 40, size * 12.0)
    return table(spark, sf, "part").select("p_partkey", F.round(dry, 6).alias("dry"), F.round(wet, 6).alias("wet"))


@query("""
WITH b AS (SELECT s_suppkey, s_suppkey % 10 / 10.0 AS base, s_suppkey % 10 / 10.0 + 0.3 AS start, s_suppkey % 10 / 10.0 + 1.1 AS upper, 0.25 AS a FROM supplier),
i AS (SELECT *, start + a * (upper - start) AS inherited FROM b),
g AS (SELECT *, greatest(base, pow(base / 1.0, 1 / 3.0)) AS gb, greatest(inherited, pow(inherited / 1.0, 1 / 3.0)) AS gs, greatest(upper, pow(upper / 1.0, 1 / 3.0)) AS gu FROM i)
SELECT s_suppkey, round(gb, 6) AS natural, round(gs, 6) AS starting, round(gu, 6) AS maximum, round((start - base + a * (upper - start)) * (gs - gb) / (inherited - base), 6) AS starting_improvement,
       round((1 - a) * (upper - start) * (gu - gs) / (upper - inherited), 6) AS remaining_improvement FROM g""")
def game_conversion(spark: SparkSession, sf: str) -> DataFrame:
    base = F.col("s_suppkey") % 10 / 10.0
    rows = table(spark, sf, "supplier").select("s_suppkey", base.alias("base"), (base + 0.3).alias("start"), (base + 1.1).alias("upper"))
    rows = rows.withColumn("inherited", F.col("start") + 0.25 * (F.col("upper") - F.col("start")))
    g = {k: expr.convert(F.col(c), 1.0, 1 / 3) for k, c in (("gb", "base"), ("gs", "inherited"), ("gu", "upper"))}
    rows = rows.withColumns(g)
    first = expr.guarded(F.col("gs") - F.col("gb"), F.col("inherited") - F.col("base"), 1.0)
    last = expr.guarded(F.col("gu") - F.col("gs"), F.col("upper") - F.col("inherited"), 1.0)
    gap = F.col("upper") - F.col("start")
    return rows.select(
        "s_suppkey", F.round("gb", 6).alias("natural"), F.round("gs", 6).alias("starting"), F.round("gu", 6).alias("maximum"),
        F.round((F.col("start") - F.col("base") + 0.25 * gap) * first, 6).alias("starting_improvement"), F.round(0.75 * gap * last, 6).alias("remaining_improvement"),
    )


@query("""
WITH s AS (SELECT p_partkey, p_size % 3 / 4.0 AS a, p_size % 5 / 8.0 AS b, p_size % 7 / 10.0 AS c FROM part)
SELECT p_partkey, round(a, 6) AS paddy, round((1 - a) * b, 6) AS polders, round((1 - a - (1 - a) * b) * c, 6) AS bunds, round(1 - a - (1 - a) * b - (1 - a - (1 - a) * b) * c, 6) AS none FROM s""")
def setting_partition(spark: SparkSession, sf: str) -> DataFrame:
    a, b, c = expr.partition_settings([F.col("p_size") % 3 / 4.0, F.col("p_size") % 5 / 8.0, F.col("p_size") % 7 / 10.0])
    return table(spark, sf, "part").select("p_partkey", F.round(a, 6).alias("paddy"), F.round(b, 6).alias("polders"), F.round(c, 6).alias("bunds"), F.round(1 - a - b - c, 6).alias("none"))


@query("""
WITH u AS (SELECT c_custkey, greatest(c_acctbal, 0) AS used, 9999.99 AS most, c_custkey % 13 AS works FROM customer)
SELECT c_custkey, round(100 * least(greatest(0.4 * (1 - exp(-used / 3000)) + 0.2 * (1 - exp(-3 * used / most)) + 0.4 * CASE WHEN used > 0 THEN greatest(works * 100 / used, 0) ELSE 0 END, 0), 1), 4) AS development FROM u""")
def development_score(spark: SparkSession, sf: str) -> DataFrame:
    used = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    score = 0.4 * expr.saturate(used, 3000.0) + 0.2 * (1 - F.exp(-3 * used / 9999.99)) + 0.4 * expr.ratio(F.col("c_custkey") % 13 * 100, used)
    return table(spark, sf, "customer").select("c_custkey", F.round(100 * expr.clip(score, 0.0, 1.0), 4).alias("development"))


@query("""
WITH b AS (SELECT n_nationkey, n_nationkey * 7 - 80.0 AS south, n_nationkey * 7 - 75.0 AS north FROM nation)
SELECT n_nationkey, round(6371.0088 * 6371.0088 * radians(5.0) * (sin(radians(CAST(north AS DOUBLE))) - sin(radians(CAST(south AS DOUBLE)))), 3) AS km2 FROM b""")
def band_area(spark: SparkSession, sf: str) -> DataFrame:
    south = F.col("n_nationkey") * 7 - 80.0
    return table(spark, sf, "nation").select("n_nationkey", F.round(expr.band_area_km2(south, south + 5.0, F.lit(5.0)), 3).alias("km2"))


#: Penman-Monteith by its published equations, one step a common table.
ET0 = """
WITH c AS (SELECT s_suppkey, m AS month, radians((s_suppkey % 20) * 6.0 - 57) AS phi, (s_suppkey % 20) * 100.0 AS z, -2.0 + m + (s_suppkey % 20) / 4.0 AS lo, 9.0 + m + (s_suppkey % 20) / 4.0 AS hi,
                  12.0 + 0.3 * (s_suppkey % 20) AS rs, [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31] AS days FROM supplier, range(12) r(m)),
j AS (SELECT *, 2 * pi() / 365 * (coalesce(list_sum(days[1:month]), 0) + days[month + 1] / 2.0) AS j FROM c),
d AS (SELECT *, 0.409 * sin(j - 1.39) AS tilt FROM j),
w AS (SELECT *, acos(least(greatest(-tan(phi) * tan(tilt), -1), 1)) AS ws FROM d),
r AS (SELECT *, 24 * 60 / pi() * 0.0820 * (1 + 0.033 * cos(j)) * (ws * sin(phi) * sin(tilt) + cos(phi) * cos(tilt) * sin(ws)) AS ra FROM w),
n AS (SELECT *, CASE WHEN (0.75 + 0.00002 * z) * ra > 0.01 THEN least(greatest(rs / ((0.75 + 0.00002 * z) * ra), 0.3), 1) ELSE 1 END AS clear FROM r),
e AS (SELECT *, 0.77 * rs - 4.903e-9 * (pow(hi + 273.16, 4) + pow(lo + 273.16, 4)) / 2 * (0.34 - 0.14 * sqrt(0.8)) * (1.35 * clear - 0.35) AS net,
             0.6108 * exp(17.27 * lo / (lo + 237.3)) AS elo, 0.6108 * exp(17.27 * hi / (hi + 237.3)) AS ehi, (lo + hi) / 2 AS t, 0.000665 * 101.3 * pow((293 - 0.0065 * z) / 293, 5.26) AS g FROM n),
s AS (SELECT *, 4098 * 0.6108 * exp(17.27 * t / (t + 237.3)) / pow(t + 237.3, 2) AS slope FROM e)
SELECT s_suppkey, CAST(month AS INTEGER) AS month, round(days[month + 1] * greatest(0, (0.408 * slope * net + g * 900 / (t + 273) * 2 * greatest((elo + ehi) / 2 - 0.8, 0)) / (slope + g * (1 + 0.34 * 2))), 5) AS et0 FROM s"""


@query(ET0)
def monthly_et0(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve monthly reference values for each supplier's synthetic climate."""
    k, m = F.col("s_suppkey") % 20, F.col("month")
    months = table(spark, sf, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("month"))
    et0 = expr.reference_et0(m, k * 6.0 - 57, k * 100.0, m - 2.0 + k / 4, m + 9.0 + k / 4, F.lit(0.8), F.lit(2.0), 12000.0 + 300 * k)
    return months.select("s_suppkey", "month", F.round(et0, 5).alias("et0"))


MONTHS = """m AS (SELECT o_custkey, month(o_orderdate) AS mon, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / 1000 AS v FROM orders GROUP BY 1, 2),
f AS (SELECT c.o_custkey, g.mon, coalesce(v, 0) - 60 AS v FROM (SELECT DISTINCT o_custkey FROM orders) c CROSS JOIN (SELECT unnest(range(1, 13)) AS mon) g LEFT JOIN m ON m.o_custkey = c.o_custkey AND m.mon = g.mon)"""


def months(spark: SparkSession, sf: str) -> DataFrame:
    """``(o_custkey, change)``: twelve changes in an array, so that folds need no further shuffle."""
    of = [F.sum(F.when(F.month("o_orderdate") == m, F.col("o_totalprice").cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double").alias(f"m{m}") for m in range(1, 13)]
    wide = table(spark, sf, "orders").groupBy("o_custkey").agg(*of)
    return wide.select("o_custkey", F.array(*[F.col(f"m{m}") / 1000 - 60 for m in range(1, 13)]).alias("change"))


@query(f"""
WITH RECURSIVE {MONTHS},
r AS (SELECT o_custkey, 0 AS mon, CAST(50 AS DOUBLE) AS stock FROM (SELECT DISTINCT o_custkey FROM orders)
      UNION ALL SELECT r.o_custkey, f.mon, CAST(least(greatest(r.stock + f.v, 0), 100) AS DOUBLE) FROM r JOIN f ON f.o_custkey = r.o_custkey AND f.mon = r.mon + 1)
SELECT o_custkey, round(sum(stock), 2) AS total, round(max(CASE WHEN mon = 12 THEN stock END), 2) AS final FROM r WHERE mon > 0 GROUP BY 1""")
def monthly_bucket(spark: SparkSession, sf: str) -> DataFrame:
    path = expr.clamp_fold(F.col("change"), F.lit(50.0), 0.0, 100.0)
    rows = months(spark, sf).select("o_custkey", path.alias("path"))
    total = F.aggregate("path", F.lit(0.0), lambda a, x: a + x)
    return rows.select("o_custkey", F.round(total, 2).alias("total"), F.round(F.element_at("path", -1), 2).alias("final"))


@query(f"""
WITH {MONTHS},
w AS (SELECT a.o_custkey, a.mon AS start, round(sum(b.v), 6) AS score FROM f a JOIN f b ON a.o_custkey = b.o_custkey AND (b.mon - a.mon + 12) % 12 < 4 GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, start) AS place FROM w)
SELECT o_custkey, CAST(start AS BIGINT) AS start, score FROM k WHERE place = 1""")
def cyclic_window(spark: SparkSession, sf: str) -> DataFrame:
    score = lambda s: F.round(sum(F.get("change", (s + k) % 12) for k in range(4)), 6)
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda s: F.struct(score(s).alias("score"), (-s).alias("start"))))
    return months(spark, sf).select("o_custkey", best.alias("b")).select("o_custkey", (1 - F.col("b.start")).cast("long").alias("start"), F.col("b.score").alias("score"))


#: A synthetic year of a supplier: rain, demand and temperature of each month.
YEAR = """y AS (SELECT s_suppkey AS k, m, 20.0 + (s_suppkey * 7 + m * 13) % 90 AS p, 10.0 + (s_suppkey * 3 + m * 5) % 80 AS e, 12.0 - abs(m - 6) * 4 + s_suppkey % 9 AS t, [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m + 1] AS d FROM supplier, range(12) r(m))"""


@query(f"""WITH RECURSIVE {YEAR},
c AS (SELECT *, CASE WHEN t < 0 THEN p ELSE 0 END AS fall, greatest(t, 0) * 3 * d AS cap FROM y),
u AS (SELECT *, sum(fall - cap) OVER (PARTITION BY k ORDER BY m) AS run, sum(fall - cap) OVER (PARTITION BY k ORDER BY m DESC) AS back, sum(fall - cap) OVER (PARTITION BY k) AS annual FROM c),
i AS (SELECT k, CASE WHEN any_value(annual) > 0 THEN greatest(0, -min(run)) ELSE greatest(0, max(back)) END AS snow FROM u GROUP BY 1),
s AS (SELECT k, -1 AS m, CAST(snow AS DOUBLE) AS snow, CAST(0 AS DOUBLE) AS water FROM i
      UNION ALL SELECT s.k, c.m, CAST(greatest(s.snow + c.fall - c.cap, 0) AS DOUBLE), CAST(c.p - c.fall + least(s.snow + c.fall, c.cap) AS DOUBLE) FROM s JOIN c ON c.k = s.k AND c.m = s.m + 1),
n AS (SELECT s.k, s.m, water, e, water - e AS delta FROM s JOIN c ON c.k = s.k AND c.m = s.m),
b AS (SELECT k, -1 AS m, CAST(CASE WHEN sum(delta) > 0 THEN 100 ELSE 0 END AS DOUBLE) AS soil FROM n GROUP BY 1
      UNION ALL SELECT b.k, n.m, CAST(least(greatest(b.soil + n.delta, 0), 100) AS DOUBLE) FROM b JOIN n ON n.k = b.k AND n.m = b.m + 1),
r AS (SELECT k, -1 AS m, soil, CAST(0 AS DOUBLE) AS eta, CAST(0 AS DOUBLE) AS excess FROM b WHERE m = 11
      UNION ALL SELECT r.k, n.m, CAST(least(r.soil + n.water - least(n.e, r.soil + n.water), 100) AS DOUBLE), CAST(least(n.e, r.soil + n.water) AS DOUBLE), CAST(greatest(r.soil + n.water - least(n.e, r.soil + n.water) - 100, 0) AS DOUBLE) FROM r JOIN n ON n.k = r.k AND n.m = r.m + 1)
SELECT r.k AS s_suppkey, round(sum(eta), 4) AS eta, round(sum(n.e) - sum(eta), 4) AS deficit, round(sum(excess), 4) AS excess, round(max(CASE WHEN r.m = 11 THEN soil END), 4) AS soil, round(any_value(CAST(i.snow AS DOUBLE)), 4) AS snow
FROM r JOIN i USING (k) JOIN n ON n.k = r.k AND n.m = r.m WHERE r.m >= 0 GROUP BY 1""")
def two_store_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Snow and soil through a year that ends as it begins: the starts are fixed points, found without a spin-up."""
    k, months = F.col("s_suppkey"), F.sequence(F.lit(0), F.lit(11))
    of = lambda f: F.transform(months, f)
    days = F.array(*[F.lit(float(d)) for d in expr.DAYS])
    rows = table(spark, sf, "supplier").select("s_suppkey", of(lambda m: 20.0 + (k * 7 + m * 13) % 90).alias("p"), of(lambda m: 10.0 + (k * 3 + m * 5) % 80).alias("e"), of(lambda m: 12.0 - F.abs(m - 6) * 4 + k % 9).alias("t"))
    rows = rows.withColumn("fall", F.zip_with("p", "t", lambda p, t: F.when(t < 0, p).otherwise(0.0))).withColumn("cap", F.zip_with("t", days, lambda t, d: F.greatest(t, F.lit(0.0)) * 3 * d))
    rows = rows.withColumn("change", F.zip_with("fall", "cap", lambda f, c: f - c)).withColumn("snow0", expr.snow_start(F.col("change")))
    rows = rows.withColumn("snow", expr.folded(F.col("snow0"), F.col("change"), lambda now, x: F.greatest(now + x, F.lit(0.0))))
    # what leaves the snow with the rain is the rain and snowfall less the growth of the pack
    before = F.concat(F.array("snow0"), F.slice("snow", 1, 11))
    rows = rows.withColumn("water", F.zip_with("p", F.zip_with("snow", before, lambda a, b: a - b), lambda p, grown: p - grown))
    rows = rows.withColumn("soil0", expr.cycle_start(F.zip_with("water", "e", lambda w, e: w - e), 0.0, 100.0))
    path = expr.folded(F.col("soil0"), F.zip_with("water", "e", lambda w, e: w - e), expr.held(0.0, 100.0))
    rows = rows.withColumn("soil", path).withColumn("stored", F.concat(F.array("soil0"), F.slice("soil", 1, 11)))
    rows = rows.withColumn("eta", F.zip_with("e", F.zip_with("stored", "water", lambda s, w: s + w), lambda e, has: F.least(e, has)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    excess = total("water") + F.col("soil0") - F.element_at("soil", -1) - total("eta")
    return rows.select("s_suppkey", F.round(total("eta"), 4).alias("eta"), F.round(total("e") - total("eta"), 4).alias("deficit"), F.round(F.greatest(excess, F.lit(0.0)), 4).alias("excess"), F.round(F.element_at("soil", -1), 4).alias("soil"), F.round("snow0", 4).alias("snow"))


@query("""
WITH c AS (SELECT c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS flat, count(*) AS levels FROM customer GROUP BY 1)
SELECT c_nationkey, round((flat + levels * 500.0) * (1 + 0.002 * (c_nationkey % 10)) + 3.0 * (c_nationkey % 10), 4) AS capacity FROM c""")
def capacity_model(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("c_nationkey") % 10
    sums = table(spark, sf, "customer").groupBy("c_nationkey").agg(cents("c_acctbal").alias("flat"), F.count(F.lit(1)).alias("levels"))
    return sums.select("c_nationkey", F.round((F.col("flat") + F.col("levels") * 500.0) * (1 + 0.002 * d) + 3.0 * d, 4).alias("capacity"))


@query("""
SELECT s_suppkey, CASE WHEN mean_q >= 500 AND low_q >= 75 THEN CASE WHEN g <= 0.35 THEN 'navigable' WHEN g <= 2 THEN 'improvable' ELSE 'barrier' END ELSE 'small' END AS state,
       CAST(least(greatest(len(list_filter([50.0, 150.0, 500.0, 2000.0, 8000.0], lambda x: x <= mean_q)), 1), 5) AS INTEGER) AS level
FROM (SELECT s_suppkey, s_suppkey % 30 * 100.0 AS mean_q, s_suppkey % 9 * 20.0 AS low_q, s_suppkey % 7 / 2.5 AS g FROM supplier)""")
def navigation_screen(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    mean_q, low_q, g = k % 30 * 100.0, k % 9 * 20.0, k % 7 / 2.5
    steep = expr.overrides(F.lit("barrier"), [(g <= 0.35, "navigable"), (g <= 2, "improvable")])
    state = F.when((mean_q >= 500) & (low_q >= 75), steep).otherwise("small")
    bounds = F.array(*[F.lit(x) for x in (50.0, 150.0, 500.0, 2000.0, 8000.0)])
    level = expr.clip(expr.grade(mean_q, bounds) - 1, 1, 5).cast("int")
    return table(spark, sf, "supplier").select("s_suppkey", state.alias("state"), level.alias("level"))
