"""Exact overlap of map pixels with the cells of a geographic grid.

A map is separable: the left and right edges of its columns are longitudes, the
upper and lower edges of its rows latitudes.  Each axis is cut at the grid's
cell edges by itself, into two small tables of pieces.  Pixels meet the pieces
of their column first and are summed by entity, row and grid column, so what
goes on to the pieces of the rows is as many rows as entities have stretches,
and the product of both axes is never written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.functions.expr import EARTH_KM


def axis_edges(spark: SparkSession, count: int, edge) -> DataFrame:
    """``(index, lo, hi)`` of ``count`` pixels along an axis; ``edge`` gives the coordinate of an edge by its number."""
    i = F.col("id")
    ends = spark.range(count).select(i.alias("index"), edge(i).cast("double").alias("a"), edge(i + 1).cast("double").alias("b"))
    return ends.select("index", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))


def axis_faults(edges: DataFrame) -> DataFrame:
    """``(index, fault)``: pixels without an extent, with an unknown one, that a neighbour doesn't adjoin, or from which the axis runs the other way."""
    after = edges.select((F.col("index") - 1).alias("index"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    both = edges.join(after, "index", "left").withColumn("_way", F.signum(F.col("_lo") - F.col("lo")))
    way = both.agg(F.signum(F.sum("_way")).alias("_main"))  # one row
    known = F.col("lo").isNotNull() & F.col("hi").isNotNull() & ~F.isnan("lo") & ~F.isnan("hi")
    beside = F.col("_lo").isNull() | (F.abs(F.col("_lo") - F.col("hi")) <= 1e-12) | (F.abs(F.col("_hi") - F.col("lo")) <= 1e-12)
    fault = F.when(~known, "unknown").when(F.col("hi") <= F.col("lo"), "empty").when(~beside, "apart").when(F.col("_way") != F.col("_main"), "turned")
    return both.join(F.broadcast(way)).select("index", fault.alias("fault")).where("fault is not null")


def axis_pieces(edges: DataFrame, origin: float, step: float, count: int, *, wrap: bool = False) -> DataFrame:
    """``(index, cell, lo, hi)``: each pixel's extent cut at cell edges ``origin + k step``, ``k`` from 0 to ``count``.

    With ``wrap`` the axis closes on itself, and what lies beyond an end goes on
    at the other; else it is cut off there.
    """
    lo, hi = F.col("lo"), F.col("hi")
    if not wrap:
        lo, hi = F.greatest(lo, F.lit(float(origin))), F.least(hi, F.lit(origin + step * count))
    held = edges.select("index", lo.alias("lo"), hi.alias("hi")).where("hi > lo")
    first, last = F.floor((F.col("lo") - origin) / step), F.ceil((F.col("hi") - origin) / step) - 1
    parts = held.withColumn("k", F.explode(F.sequence(first, F.greatest(first, last))))
    at = lambda k: k * F.lit(float(step)) + F.lit(float(origin))
    piece = parts.select("index", F.pmod("k", F.lit(count)).alias("cell"), F.greatest("lo", at(F.col("k"))).alias("lo"), F.least("hi", at(F.col("k") + 1)).alias("hi"))
    return piece.where("hi > lo")


def _sines(south: Column, north: Column) -> Column:
    """The difference of two sines as a product: no digits are lost between close latitudes."""
    half = F.radians(north - south) / 2
    return 2 * F.cos(F.radians(south + north) / 2) * F.sin(half)


def overlap_weights(pixels: DataFrame, columns: DataFrame, rows: DataFrame, entity: str, *, radius: float = EARTH_KM) -> DataFrame:
    """``(entity, cell_row, cell_col, weight)``: the area each entity's pixels ``(row, col, entity)`` share with each cell.

    ``columns`` and ``rows`` are the pieces of both axes.  A pixel without an
    entity gives nothing; repeated pixels count as often as they stand there.
    """
    across = columns.select(F.col("index").alias("col"), F.col("cell").alias("cell_col"), F.radians(F.col("hi") - F.col("lo")).alias("width"))
    along = rows.select(F.col("index").alias("row"), F.col("cell").alias("cell_row"), (_sines(F.col("lo"), F.col("hi")) * radius * radius).alias("band"))
    wide = pixels.where(F.col(entity).isNotNull()).join(across, "col").groupBy(entity, "row", "cell_col").agg(F.sum("width").alias("width"))
    return wide.join(along, "row").groupBy(entity, "cell_row", "cell_col").agg(F.sum(F.col("width") * F.col("band")).alias("weight"))


def pixel_areas(pixels: DataFrame, columns: DataFrame, rows: DataFrame, entity: str, *, radius: float = EARTH_KM) -> DataFrame:
    """``(entity, pixels, area)`` from the edges ``(index, lo, hi)`` of whole pixels, without any grid."""
    across = columns.select(F.col("index").alias("col"), F.radians(F.col("hi") - F.col("lo")).alias("width"))
    along = rows.select(F.col("index").alias("row"), (_sines(F.col("lo"), F.col("hi")) * radius * radius).alias("band"))
    wide = pixels.where(F.col(entity).isNotNull()).join(across, "col", "left").groupBy(entity, "row").agg(F.sum("width").alias("width"), F.count(F.lit(1)).alias("n"))
    return wide.join(along, "row", "left").groupBy(entity).agg(F.sum("n").alias("pixels"), F.sum(F.col("width") * F.col("band")).alias("area"))


def area_check(weights: DataFrame, areas: DataFrame, entity: str, *, inventory: DataFrame | None = None, tolerance: float = 1e-9) -> DataFrame:
    """``(entity, pixels, area, shared, error, fault)``: whether overlaps add to the pixels' own area.

    ``inventory(entity, pixel_count)`` adds the entities that no pixel shows and
    those whose pixels are not as many as listed.  ``fault`` is null where all is well.
    """
    shared = weights.groupBy(entity).agg(F.sum("weight").alias("shared"))
    met = areas.join(shared, entity, "left")
    error = F.abs(F.coalesce("shared", F.lit(0.0)) - F.col("area")) / F.greatest("area", F.lit(1e-10))
    met = met.withColumn("error", error)
    lost = F.when(F.col("area").isNull() | (F.col("error") > tolerance), "area")
    if inventory is None:
        return met.select(entity, "pixels", "area", "shared", "error", lost.alias("fault"))
    listed = inventory.select(entity, F.col("pixel_count").alias("_n"), F.lit(True).alias("_listed"))
    met = met.join(listed, entity, "full")
    fault = F.when(F.col("pixels").isNull(), "no pixels").when(F.col("_listed").isNull(), "not listed").when(~F.col("_n").eqNullSafe(F.col("pixels")), "pixel count").otherwise(lost)
    return met.select(entity, "pixels", "area", "shared", "error", fault.alias("fault"))
