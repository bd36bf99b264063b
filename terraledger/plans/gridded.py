"""Queries of grids and neighbours; parts lie on a grid of 40 columns, customers on a sphere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraledger.operators import distance, grid, tiles
from terraledger.plans.registry import query
from terraledger.plans.relational import r6
from terraledger.sources.tables import cell_coordinates, cell_of, table


def cells(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice"))
    return table(spark, sf, "part").select(F.expr("p_partkey div 40").alias("row"), (F.col("p_partkey") % 40).alias("col"), value.alias("value"))


CELLS = "c AS (SELECT p_partkey // 40 AS row, p_partkey % 40 AS col, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS value FROM part)"


@query(f"WITH {CELLS} SELECT row // 5 AS block_row, col // 5 AS block_col, round(avg(value), 6) AS mean, max(value) AS max, min(value) AS min, count(value) AS valid FROM c GROUP BY 1, 2")
def block_reduce(spark: SparkSession, sf: str) -> DataFrame:
    return grid.block_reduce(cells(spark, sf), "value", 5, 5).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {CELLS} SELECT a.row, a.col, round(max(abs(b.value - a.value)), 6) AS gradient FROM c a LEFT JOIN c b ON abs(a.row - b.row) + abs(a.col - b.col) = 1 GROUP BY a.row, a.col""")
def neighbour_gradient(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.gradient(cells(spark, sf), "value").select("row", "col", r6("gradient"))


@query(f"""WITH {CELLS} SELECT a.row, a.col, round(max(b.value) - min(b.value), 6) AS moving_range FROM c a LEFT JOIN c b ON b.row BETWEEN a.row - 2 AND a.row + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 GROUP BY a.row, a.col""")
def moving_extreme(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.moving_extreme(cells(spark, sf), "value", 2).select("row", "col", r6("moving_range"))


@query(f"""WITH {CELLS}, m AS (
    SELECT a.row, a.col, b.value AS near, (a.row - b.row) * (a.row - b.row) + (a.col - b.col) * (a.col - b.col) AS d2,
           row_number() OVER (PARTITION BY a.row, a.col ORDER BY (a.row - b.row) * (a.row - b.row) + (a.col - b.col) * (a.col - b.col), b.row, b.col) AS k
    FROM c a JOIN c b ON a.value IS NULL AND b.value IS NOT NULL AND abs(a.row - b.row) <= 3 AND abs(a.col - b.col) <= 3)
SELECT c.row, c.col, coalesce(value, near) AS filled, round(sqrt(d2), 6) AS distance FROM c LEFT JOIN m ON c.row = m.row AND c.col = m.col AND m.k = 1""")
def nearest_valid_fill(spark: SparkSession, sf: str) -> DataFrame:
    return tiles.nearest_valid(cells(spark, sf), "value", 3).select("row", "col", "filled", r6("distance"))


@query(f"""WITH {CELLS}, m AS (
    SELECT a.row, a.col, b.value AS near, (a.row - b.row) * (a.row - b.row) + (a.col - b.col) * (a.col - b.col) AS d2,
           row_number() OVER (PARTITION BY a.row, a.col ORDER BY (a.row - b.row) * (a.row - b.row) + (a.col - b.col) * (a.col - b.col), b.row, b.col) AS k
    FROM c a JOIN c b ON (a.value IS NULL OR a.col % 4 = 1 OR a.row % 3 <> 0) AND b.value IS NOT NULL AND b.col % 4 <> 1 AND b.row % 3 = 0)
SELECT c.row, c.col, CASE WHEN c.col % 4 = 1 OR c.row % 3 <> 0 THEN near ELSE coalesce(value, near) END AS filled, round(sqrt(d2), 6) AS distance
FROM c LEFT JOIN m ON c.row = m.row AND c.col = m.col AND m.k = 1""")
def nearest_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Holes filled from the nearest valid cell at any distance; two rows of three give no values."""
    rows = cells(spark, sf)
    hole = rows["value"].isNull() | (F.col("col") % 4 == 1)
    thin = rows.withColumn("value", F.when(~hole & (F.col("row") % 3 == 0), F.col("value")))
    return distance.nearest_fill(thin, "value").select("row", "col", "filled", r6("distance"))


@query("""SELECT p_partkey AS cell_id, p_partkey // 36 AS row, p_partkey % 36 AS col, round(-180 + (p_partkey % 36 + 0.5) * 10, 6)::DOUBLE AS lon, round(90 - (p_partkey // 36 + 0.5) * 0.02, 6)::DOUBLE AS lat FROM part""")
def cell_centres(spark: SparkSession, sf: str) -> DataFrame:
    rows = cell_coordinates(table(spark, sf, "part").select(F.col("p_partkey").alias("cell_id")), 9000, 36)
    return rows.select("cell_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), r6("lon"), r6("lat"))


@query("""
WITH p AS (SELECT c_custkey, (c_custkey * 7919 % 36000) / 100.0 - 180 AS lon, (c_custkey * 104729 % 15000) / 100.0 - 75 AS lat FROM customer),
s AS (SELECT c_custkey, CAST(floor((90 - lat) / 180 * 18) AS BIGINT) * 36 + CAST(floor((lon + 180) / 10) AS BIGINT) % 36 AS cell FROM p) SELECT c_custkey, p_retailprice AS sampled FROM s LEFT JOIN part ON cell = p_partkey""")
def point_samples(spark: SparkSession, sf: str) -> DataFrame:
    """A layer under points, by an equi-join on cells."""
    layer = table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("cell"), F.col("p_retailprice").alias("sampled"))
    return points(spark, sf).select("c_custkey", cell_of(F.col("lon"), F.col("lat"), 18, 36).cast("long").alias("cell")).join(layer, "cell", "left").select("c_custkey", "sampled")


@query(f"""WITH {CELLS}, w AS (SELECT row // 6 AS br, col // 6 AS bc, CASE WHEN value IS NULL THEN 'none' WHEN value > 910 THEN 'high' ELSE 'low' END AS kind, cos(radians(row / 2.0)) AS w FROM c)
SELECT br, bc, kind, round(sum(w) / sum(sum(w)) OVER (PARTITION BY br, bc), 6) AS fraction FROM w GROUP BY 1, 2, 3""")
def class_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Fine classes as fractions of coarse cells, weighted by the cosine of the latitude."""
    kind = F.when(F.col("value").isNull(), "none").when(F.col("value") > 910, "high").otherwise("low")
    fine = cells(spark, sf).select(F.expr("row div 6").alias("br"), F.expr("col div 6").alias("bc"), kind.alias("kind"), F.cos(F.radians(F.col("row") / 2.0)).alias("w"))
    sums = fine.groupBy("br", "bc", "kind").agg(F.sum("w").alias("w"))
    return sums.select("br", "bc", "kind", F.round(F.col("w") / F.sum("w").over(Window.partitionBy("br", "bc")), 6).alias("fraction"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = (F.col("c_custkey") * 7919 % 36000) / 100 - 180, (F.col("c_custkey") * 104729 % 15000) / 100 - 75
    return table(spark, sf, "customer").select("c_custkey", lon.alias("lon"), lat.alias("lat"), "c_acctbal")


@query("""
WITH p AS (SELECT c_custkey, (c_custkey * 7919 % 36000) / 100.0 - 180 AS lon, (c_custkey * 104729 % 15000) / 100.0 - 75 AS lat, c_acctbal FROM customer),
j AS (SELECT a.c_custkey, b.c_custkey AS donor, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(CAST(b.lat - a.lat AS DOUBLE)) / 2), 2) + cos(radians(CAST(a.lat AS DOUBLE))) * cos(radians(CAST(b.lat AS DOUBLE))) * pow(sin(radians(CAST(b.lon - a.lon AS DOUBLE)) / 2), 2)))) AS km
      FROM p a JOIN p b ON a.c_acctbal < 0 AND b.c_acctbal >= 5000),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY km, donor) AS k FROM j)
SELECT c_custkey, donor, round(km, 3) AS km FROM r WHERE k = 1""")
def nearest_donor(spark: SparkSession, sf: str) -> DataFrame:
    p = points(spark, sf)
    out = grid.nearest_donor(p.where("c_acctbal < 0"), p.where("c_acctbal >= 5000"), "c_custkey")
    return out.select("c_custkey", "donor", F.round("km", 3).alias("km"))


@query("""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
d AS (SELECT a.vec_id AS q, b.vec_id AS s, b.label, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d2 FROM e a JOIN e b ON a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, s) AS place FROM d)
SELECT q AS vec_id, round(sum(label * exp(-d2)) / sum(exp(-d2)), 6) AS estimate, round(sqrt(max(d2)), 6) AS reach FROM k WHERE place <= 8 GROUP BY 1""")
def knn_kernel(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    rows = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    near = grid.knn(rows, rows, 8, block=1024).join(e.select(F.col("vec_id").alias("s"), "label"), "s")
    w = F.exp(-F.col("d2"))
    return near.groupBy(F.col("q").alias("vec_id")).agg(F.round(F.sum(F.col("label") * w) / F.sum(w), 6).alias("estimate"), F.round(F.sqrt(F.max("d2")), 6).alias("reach"))


@query("""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, CASE WHEN count(*) OVER (PARTITION BY label) > 4 THEN label END AS own FROM embeddings),
p AS (SELECT a.vec_id AS q, b.vec_id AS s, a.v AS x, b.v AS y FROM e a JOIN e b ON b.label = a.own UNION ALL SELECT a.vec_id, b.vec_id, a.v, b.v FROM e a CROSS JOIN e b WHERE a.own IS NULL),
d AS (SELECT q, s, list_sum(list_transform(list_zip(x, y), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d2 FROM p WHERE q <> s),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, s) AS place FROM d)
SELECT q AS vec_id, round(quantile_cont(CAST(s AS DOUBLE), 0.25), 6) AS estimate, count(*) AS donors FROM k WHERE place <= 4 GROUP BY 1""")
def donor_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """Estimates from the four nearest others of the own label, or of all rows where it has fewer or is missing."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    out = grid.donor_quantile(rows, rows.withColumn("v", F.col("id")), 4, 0.25, group="label", value="v", least=5)
    return out.select(F.col("q").alias("vec_id"), r6("estimate"), "donors")
