"""Polygons on grids: cells whose centres lie inside, by crossings of scan lines.

A shape is a row with ``rings``, arrays of points ``(x, y)``; parts and holes are
rings alike.  Each edge is sent to the grid rows whose centre line it crosses
(its lower end counts, its upper end doesn't, so a vertex is crossed once);
crossings are put in order within a shape's row, and cells lie inside between an
odd and the next even one.  Work is the number of crossings and not the area of
a bounding box, and a shape of any size is spread over its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Frame:
    """A north-up grid: its upper left corner, cell sizes and numbers of rows and columns."""

    left: float
    top: float
    width: float
    height: float
    rows: int
    cols: int

    def column(self, x: Column) -> Column:
        """Where ``x`` lies in cells, a whole number at each centre."""
        return (x - self.left) / self.width - 0.5

    def row(self, y: Column) -> Column:
        return (self.top - y) / self.height - 0.5


def ring_edges(shapes: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """``(key, x1, y1, x2, y2)``: the edges of all rings, each closed; rings of fewer than three points have none."""
    ring = shapes.select(key, F.explode(rings).alias("ring")).where(F.size("ring") >= 3)
    ends = F.arrays_zip(F.col("ring").alias("a"), F.concat(F.slice("ring", 2, F.size("ring") - 1), F.slice("ring", 1, 1)).alias("b"))
    edge = ring.select(key, F.explode(ends).alias("e"))
    return edge.select(key, F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def row_intervals(shapes: DataFrame, key: str, frame: Frame, rings: str = "rings") -> DataFrame:
    """``(key, row, first, last)``: the stretches of each grid row whose centres lie inside, ends included.

    A point with a missing or non-finite coordinate raises: an open ring has no inside.
    """
    edges = ring_edges(shapes, key, rings)
    known = [F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf")) for c in ("x1", "y1", "x2", "y2")]
    sound = known[0] & known[1] & known[2] & known[3]
    edges = edges.select(
        key, *[F.when(sound, c).otherwise(F.raise_error(F.lit("a ring has an unknown point"))).alias(n) for n, c in (("u1", frame.column(F.col("x1"))), ("v1", frame.row(F.col("y1"))), ("u2", frame.column(F.col("x2"))), ("v2", frame.row(F.col("y2"))))]
    )
    first = F.greatest(F.ceil(F.least("v1", "v2")), F.lit(0))
    last = F.least(F.ceil(F.greatest("v1", "v2")) - 1, F.lit(frame.rows - 1))
    crossed = edges.where(first <= last).withColumn("row", F.explode(F.sequence(first, last)))
    at = F.col("u1") + (F.col("row") - F.col("v1")) / (F.col("v2") - F.col("v1")) * (F.col("u2") - F.col("u1"))
    line = Window.partitionBy(key, "row").orderBy("u")
    pairs = crossed.select(key, "row", at.alias("u")).select(key, "row", "u", F.lead("u").over(line).alias("to"), F.row_number().over(line).alias("n")).where("n % 2 = 1")
    bounds = pairs.select(key, F.col("row").cast("long").alias("row"), F.greatest(F.ceil("u"), F.lit(0)).alias("first"), F.least(F.ceil("to") - 1, F.lit(frame.cols - 1)).alias("last"))
    return bounds.where("first <= last")


def polygon_cells(shapes: DataFrame, key: str, frame: Frame, rings: str = "rings") -> DataFrame:
    """``(key, row, col)``: the cells whose centres lie inside each shape."""
    return row_intervals(shapes, key, frame, rings).select(key, "row", F.explode(F.sequence("first", "last")).alias("col"))


def burned(shapes: DataFrame, key: str, order: str, frame: Frame, rings: str = "rings") -> DataFrame:
    """``(row, col, key)``: of the shapes over a cell the one that is drawn last (ties: the largest key)."""
    cells = polygon_cells(shapes, key, frame, rings).join(shapes.select(key, order), key)
    return cells.groupBy("row", "col").agg(F.max(F.struct(order, key)).getField(key).alias(key))


def convex_hulls(points: DataFrame, key: str) -> DataFrame:
    """``(key, rings)``: the convex hull of each key's points ``(x, y)``, counter-clockwise from its leftmost lowest point.

    Only the lowest and highest point of each ``x`` can lie on a hull; a hull is
    then folded over these in order, within the key's row, so points are thinned
    before they meet.  Keys with fewer than three points off one line have no hull.
    """
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ends = points.where("x is not null and y is not null and not isnan(x) and not isnan(y)").groupBy(key, "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    along = ends.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("x", "lo", "hi"))).alias("p"))

    def turn(o: Column, a: Column, b: Column) -> Column:
        return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])

    def chain(side: Column) -> Column:
        """Points that turn left only: of what stands so far, all from the first that the new point makes needless go."""
        empty = F.array().cast("array<struct<x:double,y:double>>")

        def add(held: Column, new: Column) -> Column:
            # a hull's turns are monotone as seen from a new point: what stays is a prefix
            kept = F.filter(held, lambda a, i: (i == 0) | (turn(F.get(held, i - 1), a, new) > 0))
            return F.concat(kept, F.array(new))

        return F.aggregate(side, empty, add)

    lower = chain(F.transform("p", lambda p: point(p["x"].cast("double"), p["lo"].cast("double"))))
    upper = chain(F.reverse(F.transform("p", lambda p: point(p["x"].cast("double"), p["hi"].cast("double")))))
    hulls = along.select(key, lower.alias("lower"), upper.alias("upper"))
    first = lambda c: F.element_at(c, 1)
    # where both chains meet in one point it is written once
    meet = F.when(F.element_at("lower", -1) == first("upper"), F.slice("upper", 2, F.size("upper"))).otherwise(F.col("upper"))
    ring = F.concat(F.col("lower"), meet)
    ring = F.when((F.size(ring) > 1) & (F.element_at(ring, -1) == first(ring)), F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)
    return hulls.select(key, ring.alias("ring")).where(F.size("ring") >= 3).select(key, F.array("ring").alias("rings"))
