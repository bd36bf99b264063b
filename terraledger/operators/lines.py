"""Lines on a lattice, and the registration of a map's pixels on the sphere."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lattice_cells(points: DataFrame, line: str, order: str, width: int, height: int) -> DataFrame:
    """``(line, order, step, x, y, starts)``: the four-connected cells of lines through ``points`` (``x``, ``y``), ``order`` being unique in a line.

    A segment takes the steps along both axes in the order in which it crosses the
    middles between cells, x first in a tie.  What lies before a step on the other axis
    is a count in closed form, so every cell stands alone and nothing walks.  Cells are
    named by the segment's later point.  Segments over half the width (the seam) or with
    an unknown end break a line; cells outside the map go; ``starts`` marks the first
    cell after a break or after cells outside.  A line of one point has no cells.
    """
    w = Window.partitionBy(line).orderBy(order)
    known = [F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in ("_x0", "_y0", "x", "y")]
    cells = {k: F.rint(k).cast("long") for k in ("_x0", "_y0", "x", "y")}
    ends = points.select(line, order, "x", "y", F.lag("x").over(w).alias("_x0"), F.lag("y").over(w).alias("_y0"))
    ends = ends.withColumn("_ok", reduce(Column.__and__, known) & F.coalesce(F.abs(F.col("x") - F.col("_x0")) <= width / 2, F.lit(False)))
    ends = ends.withColumn("_joined", F.coalesce(F.lag("_ok").over(w), F.lit(False))).where("_ok").withColumns(cells)
    x0, y0, dx, dy = F.col("_x0"), F.col("_y0"), F.col("_dx"), F.col("_dy")
    sx, sy = F.signum(F.col("x") - x0).cast("long"), F.signum(F.col("y") - y0).cast("long")
    ends = ends.withColumns({"_dx": F.abs(F.col("x") - x0), "_dy": F.abs(F.col("y") - y0), "_sx": sx, "_sy": sy})

    def cell(i: Column, j: Column, back_x: Column, back_y: Column) -> Column:
        x, y = x0 + F.col("_sx") * i, y0 + F.col("_sy") * j
        return F.struct((i + j).alias("step"), x.alias("x"), y.alias("y"), (x - back_x).alias("px"), (y - back_y).alias("py"))

    def steps(n: Column, of) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(0).cast("long"), n), lambda k: k < n), of)

    zero = F.lit(0).cast("long")
    along_x = steps(dx, lambda i: cell(i + 1, F.floor(((2 * i + 1) * dy + dx - 1) / (2 * dx)), F.col("_sx"), zero))
    along_y = steps(dy, lambda j: cell(F.floor(((2 * j + 1) * dx + dy) / (2 * dy)), j + 1, zero, F.col("_sy")))
    out = ends.select(line, order, "_joined", F.explode(F.concat(F.array(cell(zero, zero, zero, zero)), along_x, along_y)).alias("c"))

    def inside(x: str, y: str) -> Column:
        return F.col(x).between(0, width - 1) & F.col(y).between(0, height - 1)

    out = out.where(inside("c.x", "c.y") & ((F.col("c.step") > 0) | ~F.col("_joined")))
    return out.select(line, order, "c.step", "c.x", "c.y", ((F.col("c.step") == 0) | ~inside("c.px", "c.py")).alias("starts"))


class Registration(NamedTuple):
    """Longitude is linear in a pixel's x; latitude is a falling polynomial in y, coefficients in rising order."""

    x_mean: float
    x_scale: float
    lon: tuple[float, float]
    y_mean: float
    y_scale: float
    lat: Sequence[float]
    height: int

    def longitude(self, x: Column | float) -> Column | float:
        return self.lon[0] + (x - self.x_mean) / self.x_scale * self.lon[1]

    def latitude(self, y: Column | float) -> Column | float:
        t = (y - self.y_mean) / self.y_scale
        return reduce(lambda out, c: out * t + c, reversed(list(self.lat)[:-1]), t * 0 + self.lat[-1])

    def pixels(self, points: DataFrame, lon: str, lat: str) -> DataFrame:
        """``points`` with ``px`` and ``py``: x from the formula, longitudes wrapped; y between the rows' latitudes, missing beyond them.

        The gaps between rows are dealt over as many even buckets as there are rows, so a
        point looks into one bucket and the range join is an equi-join.
        """
        rows = [float(self.latitude(float(y))) for y in range(self.height)]
        if self.height < 2 or any(a <= b for a, b in zip(rows, rows[1:], strict=False)):
            raise ValueError("latitudes fall from row to row")
        top, bucket = rows[0], (rows[0] - rows[-1]) / (self.height - 1)

        def at(x: Column) -> Column:
            return F.floor((top - x) / bucket)

        gaps = points.sparkSession.createDataFrame([(y, rows[y + 1], rows[y], y == self.height - 2) for y in range(self.height - 1)], "_y long, _lo double, _hi double, _last boolean")
        gaps = gaps.withColumn("_bucket", F.explode(F.sequence(at(F.col("_hi")), at(F.col("_lo")))))
        start = float(self.longitude(0.0))
        px = (F.pmod(F.col(lon) - start, F.lit(360.0)) + start - self.lon[0]) / self.lon[1] * self.x_scale + self.x_mean
        here = F.col(lat)
        within = (F.col("_at") == F.col("_bucket")) & (here <= F.col("_hi")) & ((here > F.col("_lo")) | (F.col("_last") & (here == F.col("_lo"))))
        found = points.withColumn("_at", at(here)).join(gaps, within, "left")
        return found.select(*points.columns, px.alias("px"), (F.col("_y") + (F.col("_hi") - here) / (F.col("_hi") - F.col("_lo"))).alias("py"))
