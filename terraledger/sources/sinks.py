"""Writers: text with fixed digits, JSON without non-finite numbers, contracts with a manifest, and stamps of stages."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FLOATS = ("double", "float")


def fixed_digits(df: DataFrame, digits: int = 15) -> DataFrame:
    """``df`` with its floating columns as text of that many significant digits; missing stays missing."""

    def text(c: str) -> Column:
        padded = F.format_string(f"%.{digits}g", F.col(c).cast("double"))
        short = F.regexp_replace(F.regexp_replace(padded, r"(\.\d*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")
        return F.when(F.col(c).isNotNull() & ~F.isnan(c), short)

    return df.select(*[text(f.name).alias(f.name) if f.dataType.simpleString() in FLOATS else F.col(f"`{f.name}`") for f in df.schema])


def write_csv(df: DataFrame, path: str, *, digits: int = 15) -> None:
    """CSV with a header; missing is the empty field, the empty text is quoted."""
    fixed_digits(df, digits).write.option("header", True).option("emptyValue", '""').option("nullValue", "").csv(path)


def finite_only(df: DataFrame) -> DataFrame:
    """``df`` with NaN and infinities as null, for formats that forbid them."""
    ok = lambda c: F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.col(c))
    return df.select(*[ok(f.name).alias(f.name) if f.dataType.simpleString() in FLOATS else F.col(f"`{f.name}`") for f in df.schema])


def write_json(df: DataFrame, path: str) -> None:
    finite_only(df).write.option("ignoreNullFields", False).json(path)


def table_digest(df: DataFrame) -> Column:
    """An aggregate that changes with any value of any row and not with the order of rows: count, and two sums of row hashes."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    sums = [F.sum(F.xxhash64(F.lit(k), row).cast("decimal(38,0)")).cast("string") for k in (1, 2)]
    return F.sha2(F.concat_ws("|", F.lit(",".join(df.columns)), F.count(F.lit(1)).cast("string"), *sums), 256)


def fingerprint(df: DataFrame) -> str:
    return df.agg(table_digest(df).alias("d")).first()["d"]


def write_contract(tables: dict[str, DataFrame], path: str, version: str, *, latest: bool = False) -> DataFrame:
    """Tables as Parquet below ``path/version`` with a manifest ``(name, version, rows, columns, digest)``, which is returned.

    All of it is written aside and moved to its name last: a version is whole or not
    there, and one that is there is never written over.  With ``latest`` the tables
    are mirrored below ``path/latest``, which is replaced as a whole.
    """
    from terraledger.sources import stages

    spark = next(iter(tables.values())).sparkSession
    if stages.exists(spark, f"{path}/{version}"):
        raise FileExistsError(f"{path}/{version}")
    staging = f"{path}/.{uuid.uuid4().hex}"
    rows = []
    for name, df in tables.items():
        df.write.option("compression", "zstd").parquet(f"{staging}/{name}")
        back = spark.read.parquet(f"{staging}/{name}")
        got = back.agg(F.count(F.lit(1)).alias("n"), table_digest(back).alias("d")).first()
        rows.append((name, version, got["n"], ",".join(back.columns), got["d"]))
    manifest = spark.createDataFrame(rows, "name string, version string, rows long, columns string, digest string")
    manifest.coalesce(1).write.parquet(f"{staging}/manifest")
    stages.moved(spark, staging, f"{path}/{version}")
    if latest:
        mirror = f"{path}/.{uuid.uuid4().hex}"
        for name in [*tables, "manifest"]:
            spark.read.parquet(f"{path}/{version}/{name}").write.option("compression", "zstd").parquet(f"{mirror}/{name}")
        stages.removed(spark, f"{path}/latest")
        stages.moved(spark, mirror, f"{path}/latest")
    return manifest


def broken(spark: SparkSession, path: str, version: str) -> DataFrame:
    """``(name, issue)`` of the tables below a manifest that are no longer what it says."""
    rows = []
    for r in spark.read.parquet(f"{path}/{version}/manifest").collect():  # a row a table
        try:
            df = spark.read.parquet(f"{path}/{version}/{r['name']}")
            if ",".join(df.columns) != r["columns"]:
                rows.append((r["name"], "columns"))
            elif fingerprint(df) != r["digest"]:
                rows.append((r["name"], "content"))
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            rows.append((r["name"], "missing"))
    return spark.createDataFrame(rows, "name string, issue string")


def stamp(inputs: dict[str, DataFrame], settings: dict[str, object], code: str) -> str:
    """One digest over the inputs' contents, the settings and the code's version: equal stamps, equal outputs."""
    parts = {"code": code, "settings": settings, "inputs": {k: fingerprint(df) for k, df in sorted(inputs.items())}}
    return _sha(json.dumps(parts, sort_keys=True, default=str))


def _sha(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()
