"""Stages of a build that are kept and reused: a table is taken again while what it was made of is the same.

A stage's folder is named by a stamp over its inputs' contents, its settings and
the code's version.  Tables are written beside it and moved into place last, with
a manifest of their content, so a build that was cut off leaves nothing that looks
whole; what no longer agrees with its manifest is made anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.sources.sinks import fingerprint, stamp, table_digest


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def removed(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Gives a folder its final name, in one step; a folder of that name must not exist."""
    files, at = _files(spark, source)
    _, to = _files(spark, target)
    files.mkdirs(to.getParent())
    if files.exists(to) or not files.rename(at, to):
        raise FileExistsError(target)


def _issue(spark: SparkSession, folder: str) -> str | None:
    """Why a stage's folder can't be used: it is missing, or not what its manifest says."""
    if not exists(spark, f"{folder}/manifest"):
        return "missing"
    said = spark.read.parquet(f"{folder}/manifest").first()
    if not exists(spark, f"{folder}/table"):
        return "missing"
    df = spark.read.parquet(f"{folder}/table")
    if ",".join(df.columns) != said["columns"]:
        return "columns"
    return None if fingerprint(df) == said["digest"] else "content"


def stage(path: str, name: str, inputs: dict[str, DataFrame], settings: dict[str, object], code: str, build: Callable[[], DataFrame], *, keep: int | None = None) -> tuple[DataFrame, bool]:
    """The table of a stage, and whether it was there already.

    ``build`` is called only where no whole table of the same stamp exists.  ``keep``
    is how many older tables of this stage stay (all of them by default).
    """
    spark = next(iter(inputs.values())).sparkSession
    folder = f"{path}/{name}/{stamp(inputs, settings, code)}"
    issue = _issue(spark, folder)
    if issue is None:
        return spark.read.parquet(f"{folder}/table"), True
    staging = f"{path}/{name}/.{uuid.uuid4().hex}"
    build().write.option("compression", "zstd").parquet(f"{staging}/table")
    made = spark.read.parquet(f"{staging}/table")
    got = made.agg(F.count(F.lit(1)).alias("rows"), table_digest(made).alias("digest")).first()
    manifest = spark.createDataFrame([(name, got["rows"], ",".join(made.columns), got["digest"])], "name string, rows long, columns string, digest string")
    manifest.coalesce(1).write.parquet(f"{staging}/manifest")
    if exists(spark, folder):
        removed(spark, folder)
    moved(spark, staging, folder)
    if keep is not None:
        files, at = _files(spark, f"{path}/{name}")
        old = [s for s in files.listStatus(at) if s.getPath().getName() != folder.rpartition("/")[2]]
        for s in sorted(old, key=lambda s: -s.getModificationTime())[keep:]:
            files.delete(s.getPath(), True)
    return spark.read.parquet(f"{folder}/table"), False


def stage_issues(spark: SparkSession, path: str, expected: dict[str, str]) -> DataFrame:
    """``(stage, issue)`` of the stages ``{name: stamp}`` that a later one must not be built upon.

    ``missing``: nothing was made; ``stale``: only tables of other stamps are there;
    ``columns``, ``content``: the table is no longer what its manifest says.
    """
    rows = []
    for name, mark in expected.items():  # a row a stage
        issue = _issue(spark, f"{path}/{name}/{mark}")
        files, at = _files(spark, f"{path}/{name}")
        if issue == "missing" and files.exists(at) and any(not s.getPath().getName().startswith(".") for s in files.listStatus(at)):
            issue = "stale"
        if issue:
            rows.append((name, issue))
    return spark.createDataFrame(rows, "stage string, issue string")


def refuse_stale(spark: SparkSession, path: str, expected: dict[str, str]) -> None:
    """Raises where an earlier stage is missing, stale or changed."""
    found = stage_issues(spark, path, expected).collect()
    if found:
        raise ValueError("; ".join(f"{r['stage']}: {r['issue']}" for r in found))


def grid_contract(cells: DataFrame) -> DataFrame:
    """``(first_row, last_row, first_col, last_col, places, rows)`` of a layer of cells: what layers that are used together must share."""
    return cells.agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.min("col").alias("first_col"), F.max("col").alias("last_col"), F.count_distinct("row", "col").alias("places"), F.count(F.lit(1)).alias("rows")
    )


def alignment_issues(layers: dict[str, DataFrame], pins: dict[str, str] | None = None) -> DataFrame:
    """``(layer, issue)``: layers of cells that don't share the first one's places, hold a place twice, or whose content isn't the pinned one."""
    names: Sequence[str] = list(layers)
    spark = layers[names[0]].sparkSession
    rows = []
    contracts = {n: grid_contract(layers[n]).first() for n in names}
    for n in names:
        mine, first = contracts[n], contracts[names[0]]
        if mine["rows"] != mine["places"]:
            rows.append((n, "a place stands twice"))
        if tuple(mine)[:5] != tuple(first)[:5] or (n != names[0] and layers[n].select("row", "col").join(layers[names[0]].select("row", "col"), ["row", "col"], "left_anti").limit(1).count()):
            rows.append((n, "other places"))
        if pins is not None and pins.get(n) != fingerprint(layers[n]):
            rows.append((n, "not pinned" if n not in pins else "other content"))
    return spark.createDataFrame(rows, "layer string, issue string")
