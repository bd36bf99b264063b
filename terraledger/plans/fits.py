"""Queries of bounded fits and coefficient tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.operators import fits, ruled_fits
from terraledger.plans.registry import query
from terraledger.plans.relational import r6
from terraledger.sources.tables import table

#: Groups that the driver deals over folds.
MOST_GROUPS = 10_000


@query("""
WITH m AS (SELECT regr_slope(p_retailprice, p_size) AS slope, regr_intercept(p_retailprice, p_size) AS intercept FROM part)
SELECT 'intercept' AS name, round(intercept, 4) AS value FROM m UNION ALL SELECT 'p_size', round(slope, 4) FROM m""")
def fit_normal_equations(spark: SparkSession, sf: str) -> DataFrame:
    beta = fits.ridge(table(spark, sf, "part"), [F.col("p_size").cast("double")], F.col("p_retailprice"))
    return spark.createDataFrame([(n, round(float(v), 4)) for n, v in zip(["intercept", "p_size"], beta, strict=True)], "name string, value double")


def _solved(free: tuple[int, ...]) -> str:
    """SQL of the least-squares fit on some of three features, the others held at 0, by Cramer's rule on the covariances."""

    def det(m: list[list[str]]) -> str:
        if len(m) == 1:
            return m[0][0]
        parts = [f"{'-' if j % 2 else '+'} {m[0][j]} * ({det([r[:j] + r[j + 1 :] for r in m[1:]])})" for j in range(len(m))]
        return " ".join(parts)

    cov = [[f"c{min(i, j)}{max(i, j)}" for j in free] for i in free]
    coef = {i: f"({det([[f'b{free[r]}' if c == k else cov[r][c] for c in range(len(free))] for r in range(len(free))])}) / ({det(cov)})" for k, i in enumerate(free)}
    return "SELECT " + ", ".join(f"{coef.get(i, '0.0')} AS x{i}" for i in range(3)) + " FROM s"


#: A bounded optimum is the best feasible fit of some set of free features.
BOUNDED = f"""
WITH f AS (SELECT p_retailprice AS y, CAST(p_size AS DOUBLE) AS v0, CASE WHEN p_type = 'PROMO' THEN 1.0 ELSE 0.0 END AS v1, CASE WHEN p_type = 'STANDARD' THEN 1.0 ELSE 0.0 END AS v2 FROM part),
s AS (SELECT avg(y) AS y, {", ".join(f"avg(v{i}) AS m{i}, covar_pop(y, v{i}) AS b{i}" for i in range(3))}, {", ".join(f"covar_pop(v{i}, v{j}) AS c{i}{j}" for i in range(3) for j in range(i, 3))} FROM f),
x AS ({" UNION ALL ".join(_solved(free) for free in ((0,), (1,), (2,), (0, 1), (0, 2), (1, 2), (0, 1, 2)))} UNION ALL SELECT 0.0, 0.0, 0.0),
k AS (SELECT x0, x1, x2, y - x0 * m0 - x1 * m1 - x2 * m2 AS x3 FROM x, s WHERE x0 >= 0 AND x1 <= 0 AND x2 <= 0 ORDER BY x0 * b0 + x1 * b1 + x2 * b2 DESC LIMIT 1)
SELECT 'intercept' AS name, round(x3, 3) AS value FROM k UNION ALL SELECT 'p_size', round(x0, 3) FROM k UNION ALL SELECT 'promo', round(x1, 3) FROM k UNION ALL SELECT 'standard', round(x2, 3) FROM k"""


@query(BOUNDED)
def fit_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """Effects of two classes, held to at most zero, and a slope held to at least zero."""
    x = [F.col("p_size").cast("double"), (F.col("p_type") == "PROMO").cast("double"), (F.col("p_type") == "STANDARD").cast("double")]
    beta = fits.box_ridge(table(spark, sf, "part"), x, F.col("p_retailprice"), [0, -1e9, -1e9], [1e9, 0, 0], penalty=0.0)
    return spark.createDataFrame([(n, round(float(v), 3) + 0.0) for n, v in zip(["intercept", "p_size", "promo", "standard"], beta, strict=True)], "name string, value double")


@query("""
WITH s AS (SELECT c_nationkey AS g, count(*) AS n FROM customer GROUP BY 1)
SELECT g, n, row_number() OVER (ORDER BY n DESC, g) AS place FROM s""")
def group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "g")).cast("long"))


@query("""
WITH RECURSIVE s AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY n DESC, CAST(c_nationkey AS VARCHAR)) AS k FROM s),
d AS (SELECT 0 AS k, CAST(NULL AS BIGINT) AS fold, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS load
      UNION ALL SELECT o.k, list_position(load, list_min(load)) - 1, list_transform(range(5), lambda f: load[f + 1] + CASE WHEN f = list_position(load, list_min(load)) - 1 THEN n ELSE 0 END) FROM d JOIN o ON o.k = d.k + 1)
SELECT CAST(c_nationkey AS INTEGER) AS c_nationkey, CAST(fold AS INTEGER) AS fold, n FROM d JOIN o USING (k)""")
def region_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Nations dealt over five folds of about equal size."""
    groups = table(spark, sf, "customer").groupBy("c_nationkey").count().orderBy(F.desc("count")).limit(MOST_GROUPS + 1).collect()
    if len(groups) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups to deal over folds")
    sizes = {str(r["c_nationkey"]): r["count"] for r in groups}
    return spark.createDataFrame([(int(k), v, sizes[k]) for k, v in fits.balanced_folds(sizes, 5).items()], "c_nationkey int, fold int, n long")


@query("""
WITH c(attribute, value, coef) AS (VALUES ('p_type', 'PROMO', 3.5), ('p_type', 'STANDARD', -1.25), ('p_brand', 'Brand#11', 10.0), ('p_brand', 'Brand#55', 7.5)),
l AS (SELECT p_partkey, 'p_type' AS attribute, p_type AS value FROM part UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part)
SELECT p_partkey, CAST(sum(coalesce(coef, 0)) AS DOUBLE) AS predicted, count(coef) AS matched FROM l LEFT JOIN c USING (attribute, value) GROUP BY 1""")
def coef_predict(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("p_type", "PROMO", 3.5), ("p_type", "STANDARD", -1.25), ("p_brand", "Brand#11", 10.0), ("p_brand", "Brand#55", 7.5)]
    coefs = spark.createDataFrame(rows, "attribute string, value string, coef double")
    long = table(spark, sf, "part").unpivot("p_partkey", ["p_type", "p_brand"], "attribute", "value")
    return long.join(coefs, ["attribute", "value"], "left").groupBy("p_partkey").agg(F.sum(F.coalesce("coef", F.lit(0.0))).alias("predicted"), F.count("coef").alias("matched"))


@query("""
WITH r AS (SELECT n_regionkey, c_custkey, abs(c_acctbal) / (1000 + c_custkey % 100) AS ratio FROM customer JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT n_regionkey, min(ratio) AS lo, max(ratio) AS hi FROM r GROUP BY 1)
SELECT n_regionkey, round(lo, 6) AS lo, round(hi, 6) AS hi, round(least(0.5, lo * 0.95), 6) AS low_factor, round(greatest(2.0, hi * 1.05), 6) AS high_factor, lo * 0.95 <= 0.5 AND hi * 1.05 >= 2.0 AS encloses FROM b""")
def enclosure_bounds(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    ratio = F.abs("c_acctbal") / (1000 + F.col("c_custkey") % 100)
    b = table(spark, sf, "customer").join(nation, "c_nationkey").groupBy("n_regionkey").agg(F.min(ratio).alias("lo"), F.max(ratio).alias("hi"))
    lo, hi = F.col("lo") * 0.95, F.col("hi") * 1.05
    return b.select("n_regionkey", r6("lo"), r6("hi"), F.round(F.least(F.lit(0.5), lo), 6).alias("low_factor"), F.round(F.greatest(F.lit(2.0), hi), 6).alias("high_factor"), ((lo <= 0.5) & (hi >= 2.0)).alias("encloses"))


@query("""
WITH p AS (SELECT abs(c_acctbal) AS v FROM customer),
q AS (SELECT quantile_cont(v, [0.25, 0.5, 0.75]) AS a FROM p),
g AS (SELECT x.i AS i, f.v AS f, a[x.i] / 5 * f.v AS unit FROM q, (VALUES (1), (2), (3)) x(i), (VALUES (0.5), (1.0), (2.0)) f(v))
SELECT CAST(i AS INTEGER) AS i, CAST(f AS DOUBLE) AS f, round(unit, 6) AS unit, round(sum(abs(least(greatest(round_even(v / unit, 0), 0), 20) * unit - v)), 2) AS error FROM p, g GROUP BY 1, 2, 3""")
def unit_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(F.abs("c_acctbal").alias("v"))
    q = rows.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("a"))  # one row
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i in (1, 2, 3) for f in (0.5, 1.0, 2.0)])
    tried = rows.join(F.broadcast(q)).withColumn("g", F.explode(grid)).select("v", "g.i", "g.f", (F.element_at("a", F.col("g.i")) / 5 * F.col("g.f")).alias("unit"))
    n = F.least(F.greatest(F.bround(F.col("v") / F.col("unit")), F.lit(0.0)), F.lit(20.0))
    return tried.groupBy("i", "f", F.round("unit", 6).alias("unit")).agg(F.round(F.sum(F.abs(n * F.col("unit") - F.col("v"))), 2).alias("error"))


def _least_squares(free: tuple[int, ...], n: int, source: str) -> str:
    """SQL of the fit on some of ``n`` features, the others held at 0: the covariances of ``source`` cleared column by column."""
    k = len(free)
    cells = ", ".join(f"c{min(free[i], free[j])}_{max(free[i], free[j])} AS a{i}_{j}" for i in range(k) for j in range(k))
    rights = ", ".join(f"b{free[i]} AS r{i}" for i in range(k))
    sql = f"SELECT {cells + ', ' if k else ''}{rights + ', ' if k else ''}1 AS one FROM {source}"
    for p in range(k):
        keep = [f"(a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p}) AS a{i}_{j}" if i != p else f"a{i}_{j} AS a{i}_{j}" for i in range(k) for j in range(k)]
        right = [f"(r{i} - a{i}_{p} * r{p} / a{p}_{p}) AS r{i}" if i != p else f"r{i} AS r{i}" for i in range(k)]
        sql = f"SELECT {', '.join(keep + right)}, one FROM ({sql})"
    values = {f: f"r{i} / a{i}_{i}" for i, f in enumerate(free)}
    return "SELECT " + ", ".join(f"{values.get(j, '0.0')} AS x{j}" for j in range(n)) + f" FROM ({sql})"


#: Two effects that may not be positive, and three steps between classes of size that may not fall: a bounded optimum is the best sound fit of some of them.
RULED = f"""WITH f AS (SELECT p_retailprice + CASE WHEN p_size % 4 = 2 THEN -3.0 ELSE p_size % 4 END AS y, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 1.0 ELSE 0.0 END AS v0, CASE WHEN p_type = 'LARGE' THEN 1.0 ELSE 0.0 END AS v1,
    {", ".join(f"CASE WHEN p_size % 4 >= {j} THEN 1.0 ELSE 0.0 END AS v{j + 1}" for j in (1, 2, 3))} FROM part WHERE p_partkey % 19 > 0),
s AS (SELECT avg(y) AS y, {", ".join(f"avg(v{i}) AS m{i}, covar_pop(y, v{i}) AS b{i}" for i in range(5))}, {", ".join(f"covar_pop(v{i}, v{j}) AS c{i}_{j}" for i in range(5) for j in range(i, 5))} FROM f),
x AS ({" UNION ALL ".join(_least_squares(tuple(j for j in range(5) if mask >> j & 1), 5, "s") for mask in range(32))}),
k AS (SELECT x.*, y - {" - ".join(f"x{i} * m{i}" for i in range(5))} AS x5 FROM x, s WHERE x0 <= 0 AND x1 <= 0 AND x2 >= 0 AND x3 >= 0 AND x4 >= 0 ORDER BY {" + ".join(f"x{i} * b{i}" for i in range(5))} DESC LIMIT 1)
SELECT '' AS attribute, '' AS value, round(x5, 4) AS effect FROM k UNION ALL SELECT 'kind', 'cheap', round(x0, 4) FROM k UNION ALL SELECT 'kind', 'large', round(x1, 4) FROM k
UNION ALL SELECT 'class', '1', round(x2, 4) FROM k UNION ALL SELECT 'class', '2', round(x2 + x3, 4) FROM k UNION ALL SELECT 'class', '3', round(x2 + x3 + x4, 4) FROM k"""


@query(RULED)
def fit_ruled(spark: SparkSession, sf: str) -> DataFrame:
    """Effects of kinds that may not raise and of ordered classes that may not fall."""
    size = F.col("p_size") % 4
    kind = F.when(F.col("p_type").isin("PROMO", "SMALL"), "cheap").when(F.col("p_type") == "LARGE", "large").otherwise("other")
    rows = table(spark, sf, "part").select(F.when(F.col("p_partkey") % 19 > 0, kind).alias("kind"), size.alias("class"), (F.col("p_retailprice") + F.when(size == 2, -3.0).otherwise(size)).alias("y"))
    design = ruled_fits.one_hot(rows, ["kind", "class"], F.col("y"), {"kind": "other", "class": "0"})
    rules = ruled_fits.Rules(design)
    rules.span("kind", -1e6, 0.0)
    rules.order("class", ["0", "1", "2", "3"])
    a, b, _ = ruled_fits.gram(design)
    effects = ruled_fits.fit(design, a, b, rules, penalty=0.0)
    return spark.createDataFrame([(*n, round(float(v), 4) + 0.0) for n, v in zip(design.names, effects, strict=True)], "attribute string, value string, effect double")


COEFS = """c AS (SELECT n_name AS good, 'class' AS feature, CAST(s AS VARCHAR) AS value, CAST(round(0.4 - s * 0.15 + (n_nationkey * 7 + s * 5) % 11 * 0.04, 2) AS DOUBLE) AS coef, CASE s % 3 WHEN 0 THEN 'core' WHEN 1 THEN 'marginal' ELSE 'unfit' END AS class FROM nation, range(6) r(s)
    UNION ALL SELECT n_name, f, 'v' || v, CAST(round(((n_nationkey * 3 + v * 7 + length(f)) % 9 - 4) * 0.05, 2) AS DOUBLE), NULL FROM nation, (VALUES ('soil'), ('relief'), ('water')) t(f), range(3) r(v))"""


@query(f"""WITH {COEFS}, k AS (SELECT a.good, a.value, a.coef, a.class, b.value AS other, b.coef AS lower, b.class AS under FROM c a JOIN c b ON a.good = b.good AND a.feature = 'class' AND b.feature = 'class'),
g AS (SELECT k.*, v.gap, row_number() OVER (PARTITION BY good, v.u, v.l ORDER BY coef, value, lower DESC, other DESC) AS n FROM k JOIN (VALUES ('core', 'marginal', 0.0), ('marginal', 'unfit', 0.0), ('core', 'unfit', 0.2)) v(u, l, gap) ON v.u = class AND v.l = under),
h AS (SELECT *, row_number() OVER (PARTITION BY good ORDER BY coef DESC, value DESC) AS n FROM c WHERE class = 'unfit')
SELECT good, 'class' AS feature, value, class || ' not ' || gap || ' over ' || under || ' ' || other AS problem FROM g WHERE n = 1 AND coef - lower < gap - 0.011
UNION ALL SELECT good, 'class', value, 'unfit over -0.2' FROM h WHERE n = 1 AND coef > -0.2 + 1e-9
UNION ALL SELECT good, feature, value, CASE WHEN feature = 'water' THEN 'no row expected' WHEN coef < 0 THEN 'negative' ELSE 'positive' END FROM c
WHERE class IS NULL AND abs(coef) >= 0.005 AND (feature = 'water' AND value <> 'v1' OR feature = 'soil' AND coef < 0 OR feature = 'relief' AND value <> 'v2' AND coef > 0)""")
def coefficient_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Written coefficients against signs and classes; one value of a feature may have a sign of its own."""
    k, s, v = F.col("n_nationkey"), F.col("s"), F.col("v")
    nation = table(spark, sf, "nation")
    graded = nation.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(5)))).select(F.col("n_name").alias("good"), F.lit("class").alias("feature"), s.cast("string").alias("value"), F.round(0.4 - s * 0.15 + (k * 7 + s * 5) % 11 * 0.04, 2).alias("coef"))
    other = nation.withColumn("f", F.explode(F.array(F.lit("soil"), F.lit("relief"), F.lit("water")))).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2))))
    other = other.select(F.col("n_name").alias("good"), F.col("f").alias("feature"), F.concat(F.lit("v"), v).alias("value"), F.round(((k * 3 + v * 7 + F.length("f")) % 9 - 4) * 0.05, 2).alias("coef"))
    place = F.col("value").cast("int") % 3
    classes = graded.select("good", "feature", "value", F.when(place == 0, "core").when(place == 1, "marginal").otherwise("unfit").alias("class"))
    signs = spark.createDataFrame([("soil", None, "+"), ("relief", None, "-"), ("relief", "v2", "any"), ("water", None, "0"), ("water", "v1", "any")], "feature string, value string, sign string")
    return ruled_fits.row_violations(graded.unionByName(other), signs, classes, gaps=[("core", "marginal", 0.0), ("marginal", "unfit", 0.0), ("core", "unfit", 0.2)], highest={"unfit": -0.2})
