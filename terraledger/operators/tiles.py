"""Grids in tiles that bear a border of their neighbours' cells.

A cell goes to its own tile, and to those beside it whose border it lies in: to
four at most, and but for the borders to one.  A tile is a dense block of bounded
size in its task, so a neighbourhood of any shape within the border is an array
operation there, and the shuffle moves about one copy of the grid whatever the
radius.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and columns of a tile without its border.
SIZE = 256


def with_border(cells: DataFrame, radius: int, size: int = SIZE) -> DataFrame:
    """``cells`` with ``tile_row`` and ``tile_col``: each row once for each tile that needs it."""
    if not 0 <= radius <= size:
        raise ValueError("a border is at most as wide as a tile")

    def tiles(at: str) -> Column:
        first, last = F.floor((F.col(at) - radius) / size), F.floor((F.col(at) + radius) / size)
        return F.explode(F.sequence(first, last))

    return cells.withColumn("tile_row", tiles("row")).withColumn("tile_col", tiles("col"))


def over_tiles(cells: DataFrame, value: str, radius: int, work: Callable[[np.ndarray], dict[str, np.ndarray]], names: list[str], *, size: int = SIZE) -> DataFrame:
    """``cells`` with the columns ``names``, as ``work`` gives them for each tile.

    ``work`` takes a block of numbers with its border (unknown and absent ones are
    NaN) and returns blocks without the border; NaN comes back as null.  Values are
    read as doubles.  A place that stands twice raises.
    """
    laid = with_border(cells.select("row", "col", F.col(value).cast("double").alias("_v")), radius, size)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        top, left = part["tile_row"].iat[0] * size - radius, part["tile_col"].iat[0] * size - radius
        r, c = (part["row"] - top).to_numpy(np.int64), (part["col"] - left).to_numpy(np.int64)
        side = size + 2 * radius
        # blocks are as large as the cells in them ask for, borders included
        block = np.full((min(side, r.max() + 1 + radius), min(side, c.max() + 1 + radius)), np.nan)
        core = (r >= radius) & (r < radius + size) & (c >= radius) & (c < radius + size)
        if len(np.unique(r * side + c)) < len(r):
            raise ValueError("a place stands on several rows")
        if not core.any():
            return pd.DataFrame({"row": r[:0], "col": c[:0], "_o": part["_v"][:0], **{n: np.zeros(0) for n in names}})
        block[r, c] = part["_v"].to_numpy(np.float64)
        found = work(block)
        r, c = r[core], c[core]
        return pd.DataFrame({"row": r + top, "col": c + left, "_o": part["_v"].to_numpy()[core], **{n: found[n][r - radius, c - radius] for n in names}})

    schema = "row long, col long, _o double, " + ", ".join(f"{n} double" for n in names)
    found = laid.groupBy("tile_row", "tile_col").applyInPandas(run, schema)
    found = found.select("row", "col", "_o", *[F.when(~F.isnan(n), F.col(n)).alias(n) for n in names])
    if set(cells.columns) == {"row", "col", value} and cells.schema[value].dataType.typeName() == "double":
        # nothing else to bring back: no second shuffle
        return found.select("row", "col", F.when(~F.isnan("_o"), F.col("_o")).alias(value), *names)
    return cells.join(found.drop("_o"), ["row", "col"], "left")


def _extremes(block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest and least known number around each place, rows first and then columns."""
    width = 2 * radius + 1
    hi, lo = np.where(np.isnan(block), -np.inf, block), np.where(np.isnan(block), np.inf, block)
    for axis in (0, 1):
        hi, lo = sliding_window_view(hi, width, axis).max(-1), sliding_window_view(lo, width, axis).min(-1)
    return hi, lo


def moving_extreme(cells: DataFrame, value: str, radius: int, size: int = SIZE) -> DataFrame:
    """``moving_range``: maximum less minimum of the known cells up to ``radius`` rows and columns away; null where there are none."""

    def work(block: np.ndarray) -> dict[str, np.ndarray]:
        hi, lo = _extremes(block, radius)
        return {"moving_range": np.where(hi >= lo, hi - lo, np.nan)}

    return over_tiles(cells, value, radius, work, ["moving_range"], size=size)


def gradient(cells: DataFrame, value: str, size: int = SIZE) -> DataFrame:
    """``gradient``: the largest absolute step to a known cell beside; null without one, or where the cell is unknown."""

    def work(block: np.ndarray) -> dict[str, np.ndarray]:
        own = block[1:-1, 1:-1]
        steps = np.abs(np.stack([block[:-2, 1:-1], block[2:, 1:-1], block[1:-1, :-2], block[1:-1, 2:]]) - own)
        steps = np.where(np.isnan(steps), -1.0, steps).max(0)
        return {"gradient": np.where(steps >= 0, steps, np.nan)}

    return over_tiles(cells, value, 1, work, ["gradient"], size=size)


def nearest_valid(cells: DataFrame, value: str, radius: int, size: int = SIZE) -> DataFrame:
    """``filled`` and ``distance``: an unknown value from the nearest known cell at most ``radius`` rows and columns away (ties: smaller row, then column).

    ``distance`` is null where the value was there or none is near.
    """
    steps = range(-radius, radius + 1)
    order = sorted((dr * dr + dc * dc, dr, dc) for dr in steps for dc in steps if dr or dc)

    def work(block: np.ndarray) -> dict[str, np.ndarray]:
        h, w = block.shape[0] - 2 * radius, block.shape[1] - 2 * radius
        filled = block[radius : radius + h, radius : radius + w].copy()
        distance = np.full(filled.shape, np.nan)
        r, c = np.nonzero(np.isnan(filled))
        for d2, dr, dc in order:
            if not len(r):
                break
            near = block[r + radius + dr, c + radius + dc]
            met = ~np.isnan(near)
            filled[r[met], c[met]], distance[r[met], c[met]] = near[met], np.sqrt(d2)
            r, c = r[~met], c[~met]
        return {"filled": filled, "distance": distance}

    return over_tiles(cells, value, radius, work, ["filled", "distance"], size=size)
