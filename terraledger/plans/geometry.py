"""Queries of maps, polygons and distances; parts are pixels of a map and cells of a grid, suppliers are outlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.operators import distance, overlap, polygons, transfer
from terraledger.plans.gridded import CELLS, cells
from terraledger.plans.registry import query
from terraledger.sources.tables import table

#: The map: 50 columns that reach around the globe and over its seam, 400 rows from pole to pole.
COLUMNS, ROWS = 50, 400
#: The grid: cells of five degrees.
STEP = 5.0


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is a pixel of its brand; every thirteenth size is no place."""
    row = F.expr(f"p_partkey div {COLUMNS}") % ROWS
    return table(spark, sf, "part").select(row.alias("row"), (F.col("p_partkey") % COLUMNS).alias("col"), F.when(F.col("p_size") % 13 != 0, F.col("p_brand")).alias("entity"))


def map_edges(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Longitudes and latitudes of the pixels' edges, each a polynomial of the edge's number."""
    lon = overlap.axis_edges(spark, COLUMNS, lambda i: -183.1 + 7.15 * i + 0.001 * i * i)
    lat = overlap.axis_edges(spark, ROWS, lambda i: 90 - 0.45 * i)
    return lon, lat


def weights(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = map_edges(spark)
    columns = overlap.axis_pieces(lon, -180.0, STEP, 72, wrap=True)
    rows = overlap.axis_pieces(lat, -90.0, STEP, 36)
    return overlap.overlap_weights(pixels(spark, sf), columns, rows, "entity")


PIXELS = f"""p AS (SELECT (p_partkey // {COLUMNS}) % {ROWS} AS row, p_partkey % {COLUMNS} AS col, p_brand AS entity FROM part WHERE p_size % 13 <> 0),
e AS (SELECT *, -183.1 + 7.15 * col + 0.001 * col * col AS w0, -183.1 + 7.15 * (col + 1) + 0.001 * (col + 1) * (col + 1) AS w1, 90 - 0.45 * row AS n0, 90 - 0.45 * (row + 1) AS s0 FROM p),
x AS (SELECT *, CAST(w0 AS DOUBLE) AS west, CAST(w1 AS DOUBLE) AS east, CAST(n0 AS DOUBLE) AS north, CAST(s0 AS DOUBLE) AS south FROM e)"""
SHARED = f"""{PIXELS}, h AS (SELECT entity, row, col, north, south, west, east, count(*) AS times FROM x GROUP BY ALL),
cc AS (SELECT c AS cell_col, t.turn, -180 + {STEP} * c + 360 * t.turn AS lo FROM range(72) r(c), (VALUES (-1), (0), (1)) t(turn)),
cr AS (SELECT r AS cell_row, -90 + {STEP} * r AS lo FROM range(36) g(r)),
m AS (SELECT entity, cell_row, cell_col, times * 6371.0088 * 6371.0088 * radians(least(east, cc.lo + {STEP}) - greatest(west, cc.lo)) * (sin(radians(least(north, cr.lo + {STEP}))) - sin(radians(greatest(south, cr.lo)))) AS weight
      FROM h JOIN cc ON cc.lo < east AND cc.lo + {STEP} > west JOIN cr ON cr.lo < north AND cr.lo + {STEP} > south)"""


@query(f"WITH {SHARED} SELECT entity, cell_row, cell_col, round(sum(weight), 2) AS weight FROM m GROUP BY 1, 2, 3 HAVING sum(weight) > 0.02")
def pixel_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Area that each brand's pixels share with each grid cell; slivers that rounding makes of an edge are left out."""
    w = weights(spark, sf).where("weight > 0.02")
    return w.select("entity", "cell_row", "cell_col", F.round("weight", 2).alias("weight"))


@query(f"""WITH {PIXELS}, a AS (SELECT entity, count(*) AS pixels, sum(6371.0088 * 6371.0088 * radians(east - west) * (sin(radians(north)) - sin(radians(south)))) AS area FROM x GROUP BY 1),
l AS (SELECT p_brand AS entity, count(*) AS n FROM part WHERE p_brand <> 'Brand#11' GROUP BY 1)
SELECT coalesce(a.entity, l.entity) AS entity, pixels, round(area, 1) AS area, CASE WHEN a.entity IS NULL THEN 'no pixels' WHEN l.entity IS NULL THEN 'not listed' WHEN n <> pixels THEN 'pixel count' END AS fault, true AS conserved
FROM a FULL JOIN l ON a.entity = l.entity""")
def overlap_check(spark: SparkSession, sf: str) -> DataFrame:
    """Overlaps against the pixels' own areas, pixels against an inventory that counts every size and lacks one brand."""
    lon, lat = map_edges(spark)
    areas = overlap.pixel_areas(pixels(spark, sf), lon, lat, "entity")
    listed = table(spark, sf, "part").where("p_brand <> 'Brand#11'").groupBy(F.col("p_brand").alias("entity")).agg(F.count(F.lit(1)).alias("pixel_count"))
    found = overlap.area_check(weights(spark, sf), areas, "entity", inventory=listed)
    return found.select("entity", "pixels", F.round("area", 1).alias("area"), "fault", (F.coalesce("error", F.lit(0.0)) <= 1e-9).alias("conserved"))


#: Corners of an outline around its centre, counter-clockwise; a hole runs the other way.
OUTLINE = [(3.0, 0.2), (2.1, 1.9), (0.1, 2.8), (-0.9, 1.1), (-2.7, 1.3), (-2.2, -1.7), (0.3, -2.9), (0.6, -1.2), (2.4, -2.0)]
HOLE = [(0.8, 0.1), (0.3, -0.7), (-0.6, -0.4), (-0.2, 0.7)]
FRAME = polygons.Frame(-180.0, 90.0, 2.0, 2.0, 90, 180)


def outlines(spark: SparkSession, sf: str) -> DataFrame:
    """Each supplier as a shape of two parts with a hole in one; some reach over the grid's edge."""
    k = F.col("s_suppkey").cast("double")
    x, y, scale = k * 37.31 % 360 - 180, k * 23.17 % 180 - 90, 1.3 + k % 7 * 0.41

    def ring(corners: list[tuple[float, float]], dx: float) -> Column:
        return F.array(*[F.struct((x + scale * (a + dx)).alias("x"), (y + scale * b).alias("y")) for a, b in corners])

    return table(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("order"), F.array(ring(OUTLINE, 0.0), ring(HOLE, 0.0), ring(OUTLINE, 7.0)).alias("rings"))


def _ring_sql(name: str, corners: list[tuple[float, float]], dx: float) -> str:
    n = len(corners)
    return " UNION ALL ".join(
        f"SELECT s_suppkey, '{name}' AS ring, x + scale * ({corners[i][0] + dx}) AS x1, y + scale * ({corners[i][1]}) AS y1, x + scale * ({corners[(i + 1) % n][0] + dx}) AS x2, y + scale * ({corners[(i + 1) % n][1]}) AS y2 FROM k"
        for i in range(n)
    )


INSIDE = f"""k AS (SELECT s_suppkey, s_acctbal, CAST(s_suppkey AS DOUBLE) * 37.31 % 360 - 180 AS x, CAST(s_suppkey AS DOUBLE) * 23.17 % 180 - 90 AS y, 1.3 + CAST(s_suppkey AS DOUBLE) % 7 * 0.41 AS scale FROM supplier),
e AS ({_ring_sql("outer", OUTLINE, 0.0)} UNION ALL {_ring_sql("hole", HOLE, 0.0)} UNION ALL {_ring_sql("second", OUTLINE, 7.0)}),
b AS (SELECT s_suppkey, min(x1) AS x0, max(x1) AS x9, min(y1) AS y0, max(y1) AS y9 FROM e GROUP BY 1),
g AS (SELECT s_suppkey, r AS row, c AS col, -180 + (c + 0.5) * 2.0 AS cx, 90 - (r + 0.5) * 2.0 AS cy FROM b JOIN range(90) a(r) ON 90 - (r + 0.5) * 2.0 BETWEEN y0 - 1 AND y9 + 1 JOIN range(180) d(c) ON -180 + (c + 0.5) * 2.0 BETWEEN x0 - 1 AND x9 + 1),
i AS (SELECT g.s_suppkey, row, col FROM g JOIN e USING (s_suppkey) GROUP BY 1, 2, 3
      HAVING sum(CASE WHEN y1 <= cy AND y2 > cy AND (x2 - x1) * (cy - y1) - (cx - x1) * (y2 - y1) > 0 THEN 1 WHEN y1 > cy AND y2 <= cy AND (x2 - x1) * (cy - y1) - (cx - x1) * (y2 - y1) < 0 THEN -1 ELSE 0 END) <> 0)"""


@query(f"WITH {INSIDE} SELECT s_suppkey, row, col FROM i")
def polygon_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells whose centres lie inside shapes of several parts with holes; the SQL takes winding numbers of all cells near."""
    return polygons.polygon_cells(outlines(spark, sf), "s_suppkey", FRAME)


@query(f"WITH {INSIDE} SELECT row, col, arg_max(s_suppkey, struct_pack(a := s_acctbal, b := s_suppkey)) AS s_suppkey FROM i JOIN supplier USING (s_suppkey) GROUP BY 1, 2")
def burned_polygons(spark: SparkSession, sf: str) -> DataFrame:
    return polygons.burned(outlines(spark, sf), "s_suppkey", "order", FRAME)


HULL = f"""q AS (SELECT DISTINCT p_brand AS brand, (p_partkey * 7919 % 3571) / 10.0 - 178 AS x, (p_partkey * 104729 % 1709) / 10.0 - 85 AS y FROM part WHERE p_partkey % 17 = 0),
d AS (SELECT brand, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM q),
s AS (SELECT a.brand, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM d a JOIN d b ON a.brand = b.brand AND (a.x <> b.x OR a.y <> b.y)
      WHERE NOT EXISTS (SELECT 1 FROM d c WHERE c.brand = a.brand AND (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0)),
g AS (SELECT r AS row, c AS col, -180 + (c + 0.5) * 6.0 AS cx, 90 - (r + 0.5) * 6.0 AS cy FROM range(30) a(r), range(60) b(c) WHERE (r * 7 + c * 3) % 5 < 3),
n AS (SELECT brand FROM d GROUP BY 1 HAVING count(*) >= 3)"""


@query(f"""WITH {HULL} SELECT brand, row, col FROM n JOIN g ON true WHERE EXISTS (SELECT 1 FROM s WHERE s.brand = n.brand)
AND NOT EXISTS (SELECT 1 FROM s WHERE s.brand = n.brand AND (x2 - x1) * (cy - y1) - (y2 - y1) * (cx - x1) <= 0)""")
def hull_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Low cells inside the convex hull of each brand's points; the SQL keeps cells on the left of every edge that has all points there."""
    k = F.col("p_partkey")
    points = table(spark, sf, "part").where("p_partkey % 17 = 0").select(F.col("p_brand").alias("brand"), ((k * 7919 % 3571) / 10.0 - 178).alias("x"), ((k * 104729 % 1709) / 10.0 - 85).alias("y"))
    frame = polygons.Frame(-180.0, 90.0, 6.0, 6.0, 30, 60)
    inside = polygons.polygon_cells(polygons.convex_hulls(points, "brand"), "brand", frame)
    return inside.where((F.col("row") * 7 + F.col("col") * 3) % 5 < 3)


@query(f"""WITH {CELLS}, m AS (
    SELECT a.row, a.col, min(sqrt(pow((a.row - b.row) * 9.27, 2) + pow((a.col - b.col) * 9.27 * cos(radians(a.row / 8.0)), 2))) AS km FROM c a JOIN c b ON b.value IS NULL GROUP BY 1, 2)
SELECT row, col, round(km, 5) AS km FROM m""")
def coast_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Way to the nearest cell without a value, a step along a row being shorter towards the poles."""
    out = distance.nearest_valid_cell(cells(spark, sf), F.col("value").isNull(), row_scale=9.27, col_scale=9.27 * F.cos(F.radians(F.col("row") / 8.0)))
    return out.select("row", "col", F.round("distance", 5).alias("km"))


ZONE = "(row * 2 + col // 3) // 9 * 7 + (col + row // 4) // 11"


@query(f"""WITH {CELLS}, z AS (SELECT row, col, {ZONE} AS zone FROM c WHERE (row * 5 + col * 3) % 29 > 0),
o AS (SELECT r AS row, k AS col, z.zone FROM (SELECT unnest(range(-1, (SELECT max(row) + 2 FROM c))) AS r) a JOIN (SELECT unnest(range(-1, 41)) AS k) b ON true LEFT JOIN z ON z.row = a.r AND z.col = b.k),
d AS (SELECT z.zone, z.row, z.col, min(abs(z.row - o.row) + abs(z.col - o.col)) AS depth FROM z JOIN o ON o.zone IS DISTINCT FROM z.zone GROUP BY 1, 2, 3)
SELECT zone, arg_min(row, struct_pack(a := -depth, b := row, c := col)) AS row, arg_min(col, struct_pack(a := -depth, b := row, c := col)) AS col, max(depth) AS depth FROM d GROUP BY 1""")
def deepest_cell(spark: SparkSession, sf: str) -> DataFrame:
    """The cell of each zone farthest from any place outside it, in steps along rows and columns."""
    zone = F.expr("(row * 2 + col div 3) div 9 * 7 + (col + row div 4) div 11")
    rows = cells(spark, sf).where((F.col("row") * 5 + F.col("col") * 3) % 29 > 0).withColumn("zone", zone)
    return distance.deepest_cells(rows, "zone")


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as places with two climate features and two values; some lack a feature or a value."""
    k = F.col("c_custkey")
    lon, lat = (k * 7919 % 36000) / 100 - 180, (k * 104729 % 15000) / 100 - 75
    climate = F.array(F.when(k % 23 != 0, (k * 31 % 97) / 10), (k * 17 % 89) / 7)
    values = F.array((k * 13 % 71) / 9, F.when(k % 29 != 0, F.greatest(F.col("c_acctbal"), F.lit(0.0))))
    return table(spark, sf, "customer").select(k.alias("id"), lon.alias("lon"), lat.alias("lat"), climate.alias("climate"), values.alias("values"))


STATIONS = """p AS (SELECT c_custkey AS id, CAST((c_custkey * 7919 % 36000) / 100.0 - 180 AS DOUBLE) AS lon, CAST((c_custkey * 104729 % 15000) / 100.0 - 75 AS DOUBLE) AS lat,
    CASE WHEN c_custkey % 23 <> 0 THEN CAST((c_custkey * 31 % 97) / 10.0 AS DOUBLE) END AS c0, CAST(c_custkey * 17 % 89 AS DOUBLE) / 7 AS c1,
    CAST(c_custkey * 13 % 71 AS DOUBLE) / 9 AS v0, CASE WHEN c_custkey % 29 <> 0 THEN greatest(c_acctbal, 0) END AS v1 FROM customer),
x AS (SELECT *, 6371.0088 * cos(radians(lat)) * cos(radians(lon)) AS x, 6371.0088 * cos(radians(lat)) * sin(radians(lon)) AS y, 6371.0088 * sin(radians(lat)) AS z, CAST(floor((lon + 180) / 10) + 2 * floor((lat + 90) / 10) AS INTEGER) % 5 AS fold FROM p),
good AS (SELECT * FROM x WHERE c0 IS NOT NULL AND v1 IS NOT NULL)"""


@query(f"""WITH {STATIONS}, s AS (SELECT * FROM good WHERE id % 3 > 0), sc AS (SELECT greatest(stddev_pop(c0), 0.1) AS s0, greatest(stddev_pop(c1), 0.1) AS s1 FROM s),
d AS (SELECT t.id, s.id AS src, pow(t.x - s.x, 2) + pow(t.y - s.y, 2) + pow(t.z - s.z, 2) AS d2, t.c0 AS t0, t.c1 AS t1, s.c0, s.c1, s.v0, s.v1 FROM x t JOIN s ON t.id % 3 = 0 AND t.c0 IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, src) AS place FROM d),
w AS (SELECT k.*, CASE WHEN sqrt(d2) <= 900 THEN exp(-0.5 * (pow((c0 - t0) / s0, 2) + pow((c1 - t1) / s1, 2)) / 2 - d2 / (2 * 300.0 * 300.0)) ELSE 0 END AS w FROM k, sc WHERE place <= 6)
SELECT id, round(sum(w * v0) / sum(w), 6) AS first, round(sum(w * v1) / sum(w), 6) AS second, count(*) FILTER (w > 0) AS donors FROM w GROUP BY 1 HAVING sum(w) > 0""")
def conditioned_transfer(spark: SparkSession, sf: str) -> DataFrame:
    """Values of two thirds of the places carried to the others, by way and by climate."""
    rows = stations(spark, sf)
    out = transfer.conditioned_kernel(rows.where("id % 3 = 0"), rows.where("id % 3 > 0"), features=2, values=2, strength=0.5, k=6, radius_km=900.0, width_km=300.0)
    return out.select("id", F.round(F.get("estimate", F.lit(0)), 6).alias("first"), F.round(F.get("estimate", F.lit(1)), 6).alias("second"), "donors")


@query(f"""WITH {STATIONS}, sc AS (SELECT f, greatest(stddev_pop(c0), 0.1) AS s0, greatest(stddev_pop(c1), 0.1) AS s1 FROM good JOIN range(5) r(f) ON fold <> f GROUP BY 1),
m AS (SELECT greatest(quantile_cont(v0, 0.5), 1e-8) AS m0, greatest(quantile_cont(v1, 0.5), 1e-8) AS m1 FROM good),
d AS (SELECT t.id, s.id AS src, t.fold, pow(t.x - s.x, 2) + pow(t.y - s.y, 2) + pow(t.z - s.z, 2) AS d2, t.c0 AS t0, t.c1 AS t1, t.v0 AS o0, t.v1 AS o1, s.c0, s.c1, s.v0, s.v1 FROM good t JOIN good s ON t.fold <> s.fold),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, src) AS place FROM d),
w AS (SELECT k.*, strength, CASE WHEN sqrt(d2) <= 900 THEN exp(-strength * (pow((c0 - t0) / s0, 2) + pow((c1 - t1) / s1, 2)) / 2 - d2 / (2 * 300.0 * 300.0)) ELSE 0 END AS w
      FROM k JOIN sc ON sc.f = k.fold, (VALUES (0.0), (0.25), (1.0), (4.0)) t(strength) WHERE place <= 6),
e AS (SELECT strength, id, (pow(ln(1 + sum(w * v0) / sum(w) / max(m0)) - ln(1 + max(o0) / max(m0)), 2) + pow(ln(1 + sum(w * v1) / sum(w) / max(m1)) - ln(1 + max(o1) / max(m1)), 2)) / 2 AS e FROM w, m GROUP BY 1, 2 HAVING sum(w) > 0)
SELECT CAST(strength AS DOUBLE) AS strength, round(sqrt(avg(e)), 6) AS error, count(*) AS evaluated FROM e GROUP BY 1""")
def kernel_strength(spark: SparkSession, sf: str) -> DataFrame:
    """How well each weight of the climate tells the values of one part of the globe from the others."""
    fold = (F.floor((F.col("lon") + 180) / 10) + 2 * F.floor((F.col("lat") + 90) / 10)) % 5
    out = transfer.strength_errors(stations(spark, sf), fold, 5, features=2, values=2, strengths=(0.0, 0.25, 1.0, 4.0), k=6, radius_km=900.0, width_km=300.0)
    return out.select("strength", F.round("error", 6).alias("error"), "evaluated")


@query(f"""WITH {CELLS}, p AS (SELECT row * 40 + col AS id, row, col, value, (row + col // 6) // 5 AS basin FROM c WHERE (row * 3 + col) % 4 > 0),
d AS (SELECT a.id, a.basin, b.basin AS other, b.value, row_number() OVER (PARTITION BY a.id ORDER BY CASE WHEN a.id = b.id THEN -1 ELSE pow(a.row - b.row, 2) + pow(a.col - b.col, 2) END, b.id) AS place
      FROM p a JOIN p b ON abs(a.row - b.row) <= 6 AND abs(a.col - b.col) <= 6)
SELECT id, round(quantile_cont(value, 0.5), 6) AS smoothed, count(value) AS used FROM d WHERE place <= 9 AND basin = other GROUP BY 1""")
def basin_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    """Medians over the nearest cells, never across basins; the SQL looks six cells around, where nine are always found."""
    rows = cells(spark, sf).where((F.col("row") * 3 + F.col("col")) % 4 > 0)
    points = rows.select((F.col("row") * 40 + F.col("col")).cast("long").alias("id"), F.col("col").alias("x"), F.col("row").alias("y"), F.expr("(row + col div 6) div 5").alias("basin"), "value")
    out = transfer.group_median(points, 9, group="basin", value="value")
    return out.select("id", F.round("smoothed", 6).alias("smoothed"), "used")
