"""Table and grid sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_ids_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose columns stay text: a tag spelled ``nan`` is a tag."""
    return spark.read.option("header", True).option("inferSchema", False).option("nanValue", "\0").option("emptyValue", "").csv(path)


def cell_coordinates(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """``row``, ``col``, ``lon`` and ``lat`` of the centre of each ``cell_id`` of a north-up global grid."""
    row, col = F.floor(F.col("cell_id") / cols), F.pmod(F.col("cell_id"), F.lit(cols))
    return cells.withColumns({"row": row, "col": col}).withColumns({"lon": -180 + (F.col("col") + 0.5) * 360 / cols, "lat": 90 - (F.col("row") + 0.5) * 180 / rows})


def cell_of(lon: Column, lat: Column, rows: int, cols: int) -> Column:
    """The cell under a point, for sampling layers by an equi-join."""
    row = F.least(F.floor((90 - lat) / 180 * rows), F.lit(rows - 1))
    return row * cols + F.pmod(F.floor((lon + 180) / 360 * cols), F.lit(cols))


def content_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(path, sha256)`` of the files under ``path``."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))
