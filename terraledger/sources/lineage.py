"""Tables written to the shared folder: they cut the lineage, so a lost executor costs only what comes after."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Without that setting a session on one machine gets a temporary folder; on a
    cluster executors would write to their own disks, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/terraledger-checkpoints"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; Parquet keeps columns pruned on each later read."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
