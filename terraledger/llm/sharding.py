"""Shards by proportional stratified interleaving.

Rows are ranked in a seeded shuffle within their source; the fractional rank
``(2 r - 1) / (2 n)`` orders all rows, so that any stretch of that order holds
the sources in their proportions; the order is cut into shards whose row counts
differ by one at most (law ``rows``).

No window spans a source or the table: a rank is the rows in the lower buckets
of an even hash (or of the even fractional rank) plus a row number within one
bucket of about ``bucket_rows`` rows.  A source with a third of all rows is
thereby spread over as many buckets as any stretch of the table.

Defined cases: a null text has size 8 and the checksum of no bytes; a null
source is a source of its own; repeated rows are placed like others (equal rows
are interchangeable); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _offsets(counts: DataFrame, key: str, span: int = 4096) -> DataFrame:
    """``counts(key, n)`` with ``before``: the rows under lower keys, summed in two levels so that no task sees all keys."""
    wide = counts.withColumn("_hi", F.floor(F.col(key) / span))
    upper = wide.groupBy("_hi").agg(F.sum("n").alias("_n"))
    upper = upper.select("_hi", (F.sum("_n").over(Window.orderBy("_hi")) - F.col("_n")).alias("_below"))
    within = F.sum("n").over(Window.partitionBy("_hi").orderBy(key)) - F.col("n")
    return wide.join(upper, "_hi").select(key, (F.col("_below") + within).alias("before"))


def interleave(df: DataFrame, shards: int, *, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", bucket_rows: int = 2048) -> DataFrame:
    """Rows ``(doc_id, source, size, text_crc32, shard, slot)``, slots from 0 without a gap in each shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")).alias("_source"),
        # the text takes part, so that rows without an id, or with the same one, are spread too
        F.xxhash64(F.lit(seed), F.col(id_col), F.crc32(text.cast("binary")), F.octet_length(text)).alias("_key"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    total = df.count()
    buckets = max(1, -(-total // bucket_rows))
    # the key as an unsigned number: buckets and the order within them agree
    rows = rows.withColumn("_unit", F.shiftrightunsigned("_key", 11)).withColumn("_bucket", F.floor(F.col("_unit") / F.lit(float(1 << 53)) * buckets))

    counts = rows.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    by_source = Window.partitionBy("_source")
    before = counts.select(
        "_source", "_bucket", F.sum("n").over(by_source).alias("_of"), (F.sum("n").over(by_source.orderBy("_bucket")) - F.col("n")).alias("_before")
    )
    order = Window.partitionBy("_source", "_bucket").orderBy("_unit", "_key", "doc_id", "text_crc32", "size")

    def ranked(part: DataFrame, tie: Window) -> DataFrame:
        rank = F.col("_before") + F.row_number().over(tie)
        out = part.join(before, ["_source", "_bucket"]).withColumn("_rank", rank)
        out = out.withColumn("_fraction", (2 * F.col("_rank") - 1) / (2 * F.col("_of")))
        return out.withColumn("_stretch", F.least(F.floor(F.col("_fraction") * buckets), F.lit(buckets - 1)))

    # how many rows a stretch of the fractional order holds follows from counts alone, so no text is read for it
    per_stretch = ranked(rows.select("_source", "_bucket", "_key"), Window.partitionBy("_source", "_bucket").orderBy("_key")).groupBy("_stretch").agg(F.count(F.lit(1)).alias("n"))
    placed = ranked(rows, order).join(_offsets(per_stretch, "_stretch"), "_stretch")
    within = F.row_number().over(Window.partitionBy("_stretch").orderBy("_fraction", "_source", "_rank"))
    at = F.col("before") + within - 1
    placed = placed.withColumn("_at", at.cast("long"))
    placed = placed.withColumn("shard", _exact_div(F.col("_at") * shards, total).cast("int"))
    first = _exact_div(F.col("shard").cast("long") * total + (shards - 1), shards)
    source = F.when(F.col("_source") != "", F.substring("_source", 2, 1 << 30))
    return placed.select("doc_id", source.alias("source"), "size", "text_crc32", "shard", (F.col("_at") - first).alias("slot"))


def _exact_div(a: Column, b: int) -> Column:
    """Whole-number quotient without a detour over doubles."""
    return ((a - F.pmod(a, F.lit(max(1, b)))) / F.lit(max(1, b))).cast("long")
