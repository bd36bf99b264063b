"""Exact distance transforms in linear time, and the deepest cells of zones.

Cells are rows ``(row, col, ...)``.  Distances are separable: a pass along the
columns finds the nearest valid cells above and below by windows, and a pass
along the rows takes the lower envelope of the parabolas that these span.  A
row's task sees as many candidates as the grid has columns, each of which enters
and leaves the envelope once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lower_envelope(at: list[int], up: list) -> tuple[np.ndarray, np.ndarray]:
    """Which of the parabolas ``(x - at)^2 + up``, at ascending ``at``, are lowest somewhere, and from where on.

    Those that are lowest at a single point stay, so that several may be equally
    near there.  Whole numbers are compared exactly; heights are subtracted before
    squares are added, which the largest heights would swallow.
    """
    stays: list[int] = []
    # the point from which a member is at least as low as the one before it: a / (2 b)
    starts: list[tuple] = []
    for k, q in enumerate(at):
        while stays:
            p = at[stays[-1]]
            a, b = (up[k] - up[stays[-1]]) + (q * q - p * p), q - p
            if starts[-1] is None or a * starts[-1][1] >= starts[-1][0] * b:
                break
            stays.pop()
            starts.pop()
        starts.append((a, b) if stays else None)
        stays.append(k)
    return np.array(stays, np.int64), np.array([-np.inf] + [a / (2 * b) for a, b in starts[1:]])


def _nearest_in_row(col: np.ndarray, up: np.ndarray, source: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of candidates in ascending columns (no column twice) the nearest to each column asked for, and its squared distance.

    Ties: the smaller source row, then the smaller column.
    """
    stays, start = lower_envelope(col.tolist(), up.tolist())
    last = np.searchsorted(start, asked, "right") - 1
    best = stays[last]
    d2 = (asked - col[best]) ** 2 + up[best]
    # members further to the left that are just as near end where the next begins
    back = last - 1
    while (ties := (back >= 0) & (start[np.minimum(back + 1, len(start) - 1)] >= asked)).any():
        other = stays[np.maximum(back, 0)]
        od2 = (asked - col[other]) ** 2 + up[other]
        better = ties & (od2 <= d2) & ((od2 < d2) | (source[other] < source[best]) | ((source[other] == source[best]) & (col[other] < col[best])))
        best, d2 = np.where(better, other, best), np.where(better, od2, d2)
        back = np.where(ties, back - 1, -1)
    return best, d2


def nearest_valid_cell(cells: DataFrame, valid: Column, *, row_scale: float | None = None, col_scale: Column | None = None) -> DataFrame:
    """``(row, col, from_row, from_col, distance)``: the nearest valid cell of every cell, however far (ties: smaller row, then column).

    Distances are in cells; or ``row_scale`` is the way between rows and
    ``col_scale`` (of ``row``) that between columns, both in the unit wanted, the
    latter as it is at the cell that asks; a way has no sign, and may be 0.  Valid
    cells are their own nearest, at distance 0.  Without any valid cell there are no rows.
    """
    wide = F.abs((F.lit(1.0) if col_scale is None else col_scale).cast("double"))
    tall = 1.0 if row_scale is None else float(row_scale)
    exact = row_scale is None and col_scale is None
    own = cells.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.coalesce(valid, F.lit(False)).alias("ok")).distinct()
    known, asking = own.where("ok").select("row", "col"), own.where("not ok").select("row", "col")
    # every row that asks, under every column that has a valid cell: as many rows as the grid has cells at most
    columns = known.agg(F.collect_set("col").alias("_cols"))  # one row, as wide as the grid
    asked = asking.select("row").distinct().join(F.broadcast(columns)).select("row", F.explode("_cols").alias("col"), F.lit(False).alias("ok"))
    lines = known.withColumn("ok", F.lit(True)).unionByName(asked).groupBy("row", "col").agg(F.max("ok").alias("ok"))
    held = F.when(F.col("ok"), F.col("row"))
    # both frames grow from their start: one that shrinks to its end is summed anew at each row
    line, back = [Window.partitionBy("col").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("row"), F.desc("row"))]
    near = lines.withColumn("_up", F.max(held).over(line)).withColumn("_down", F.min(held).over(back))
    nearer = F.when(F.col("_down").isNull() | (F.col("row") - F.col("_up") <= F.col("_down") - F.col("row")), F.col("_up")).otherwise(F.col("_down"))
    candidates = near.join(asking.select("row").distinct(), "row", "left_semi").select("row", "col", nearer.alias("source"), F.lit(0).alias("kind"))
    laid = candidates.unionByName(asking.select("row", "col", F.lit(None).cast("long").alias("source"), F.lit(1).alias("kind")))
    laid = laid.withColumn("scale", wide)

    def look(part: pd.DataFrame) -> pd.DataFrame:
        row, scale = part["row"].iat[0], part["scale"].iat[0]
        have, ask = part[part["kind"] == 0].sort_values("col"), part.loc[part["kind"] == 1, "col"].to_numpy(np.int64)
        empty = pd.DataFrame({"row": ask[:0], "col": ask[:0], "from_row": ask[:0], "from_col": ask[:0], "distance": np.zeros(0)})
        if not len(have) or not len(ask):
            return empty
        col, source = have["col"].to_numpy(np.int64), have["source"].to_numpy(np.int64)
        if exact:
            best, d2 = _nearest_in_row(col, (source - row) ** 2, source, ask)
        elif scale:
            best, _ = _nearest_in_row(col, ((source - row) * (tall / scale)) ** 2, source, ask)
        else:  # all columns in one place
            best = np.full(len(ask), np.lexsort((col, source, np.abs(source - row)))[0])
        if not exact:
            d2 = ((source[best] - row) * tall) ** 2 + ((col[best] - ask) * scale) ** 2
        return pd.DataFrame({"row": row, "col": ask, "from_row": source[best], "from_col": col[best], "distance": np.sqrt(d2)})

    found = laid.groupBy("row").applyInPandas(look, "row long, col long, from_row long, from_col long, distance double")
    return known.select("row", "col", F.col("row").alias("from_row"), F.col("col").alias("from_col"), F.lit(0.0).alias("distance")).unionByName(found)


def nearest_fill(cells: DataFrame, value: str) -> DataFrame:
    """``(row, col, filled, distance)``: a missing value from the nearest valid cell, however far (ties: smaller row, then column).

    ``distance`` is null where the value was there.  Without any valid cell values stay missing.
    """
    near = nearest_valid_cell(cells, F.col(value).isNotNull())
    source = cells.where(F.col(value).isNotNull()).select(F.col("row").alias("from_row"), F.col("col").alias("from_col"), F.col(value).cast("double").alias("_v"))
    filled = near.where("distance > 0").join(source, ["from_row", "from_col"]).select("row", "col", "_v", F.col("distance").alias("_d"))
    return cells.join(filled, ["row", "col"], "left").select("row", "col", F.coalesce(F.col(value).cast("double"), "_v").alias("filled"), F.col("_d").alias("distance"))


def depth_in_zone(cells: DataFrame, zone: str) -> DataFrame:
    """``(row, col, zone, depth)``: steps along rows and columns to the nearest place outside the cell's zone.

    A place without a row, beyond the grid too, lies outside every zone; cells
    without a zone are left out.  Stretches of one zone are bounded by outside
    places, so the way along a row is a running minimum in each direction.
    """
    own = cells.where(F.col(zone).isNotNull()).select("row", "col", F.col(zone).alias("zone")).distinct()

    def stretch(df: DataFrame, across: str, along: str, name: str) -> DataFrame:
        return df.withColumn(name, F.col(along) - F.row_number().over(Window.partitionBy(across, "zone").orderBy(along)))

    tall = stretch(own, "col", "row", "_s")
    whole = Window.partitionBy("col", "zone", "_s")
    tall = tall.select("row", "col", "zone", F.least(F.col("row") - F.min("row").over(whole), F.max("row").over(whole) - F.col("row")).alias("_g"))
    wide = stretch(tall, "row", "col", "_s")
    part = Window.partitionBy("row", "zone", "_s")
    before, after = [part.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("col"), F.desc("col"))]
    # outside places are at cost 0, those of the stretch at their depth along the column
    ends = F.least(F.col("col") - F.min("col").over(part), F.max("col").over(part) - F.col("col")) + 1
    g = F.col("_g") + 1
    ways = F.least(F.min(g - F.col("col")).over(before) + F.col("col"), F.min(g + F.col("col")).over(after) - F.col("col"))
    return wide.select("row", "col", "zone", F.least(ends, ways).cast("long").alias("depth"))


def deepest_cells(cells: DataFrame, zone: str) -> DataFrame:
    """``(zone, row, col, depth)``: the cell of each zone that lies farthest from any place outside (ties: smaller row, then column)."""
    deep = depth_in_zone(cells, zone)
    return deep.groupBy("zone").agg(F.max(F.struct("depth", (-F.col("row")).alias("r"), (-F.col("col")).alias("c"))).alias("m")).select("zone", (-F.col("m.r")).alias("row"), (-F.col("m.c")).alias("col"), F.col("m.depth").alias("depth"))
