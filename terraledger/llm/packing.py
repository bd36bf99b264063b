"""Conflict-constrained best-fit packing.

Documents are laid into bins of ``capacity`` units (UTF-8 bytes).  A bin carries
two bitmaps: of the duplicate clusters and of the sources that it holds.  Two
members of one cluster never share a bin.  A source may use as many of a bin's
source bits as its share of all bytes entitles it to (with some slack, two at least), so a source
that makes up a third of the corpus still packs, and no bin is left to one source
by chance.  Bins are ordered by residual; the search starts at the smallest
residual that fits and goes to its successors until the tightest compatible bin
is found; a document that none takes opens a bin.

Rows are dealt over packing groups of about ``group_rows`` pieces by a hash of the
id, and each group is packed by itself, largest piece first.  A group has a fixed
size whatever the data, so hot sources and clusters are spread over all groups.

Defined cases: a null or empty text takes one unit; a text longer than a bin is
cut into pieces that fill bins, and its last piece is packed with the others (no
text is lost or shortened); duplicates are texts that are equal but for case and
white space; rows repeated with one id are packed like duplicates; a null source
is a source of its own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY, GROUP_ROWS = 32_768, 3000
SLACK, LEAST = 3.0, 2


class Bins:
    """The bins of one group, ordered by residual."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.at: dict[int, list[int]] = {}
        self.filled = 0  # bit r is set where a bin has residual r
        self.residual: list[int] = []
        self.clusters: list[int] = []
        self.sources: list[int] = []

    def _take(self, b: int, size: int, cluster: int, source: int) -> int:
        left = self.residual[b] - size
        self.residual[b] = left
        self.clusters[b] |= cluster
        self.sources[b] |= source
        if left:
            self.at.setdefault(left, []).append(b)
            self.filled |= 1 << left
        return b

    def place(self, size: int, cluster: int, slots: list[int]) -> int:
        """The tightest bin that takes the piece; ``cluster`` is its bit (0: no duplicates), ``slots`` the bits of its source."""
        r = size - 1
        while True:
            rest = self.filled >> (r + 1)
            if not rest:
                break
            r += (rest & -rest).bit_length()
            own = self.at[r]
            for k, b in enumerate(own):
                if self.clusters[b] & cluster:
                    continue
                free = next((s for s in slots if not self.sources[b] & s), None)
                if free is None:
                    continue
                own.pop(k)
                if not own:
                    del self.at[r]
                    self.filled &= ~(1 << r)
                return self._take(b, size, cluster, free)
        self.residual.append(self.capacity)
        self.clusters.append(0)
        self.sources.append(0)
        return self._take(len(self.residual) - 1, size, cluster, slots[0])


def pack_group(pieces: pd.DataFrame, capacity: int) -> list[int]:
    """The bin of each piece of a group: columns ``size``, ``cluster``, ``source``, ``quota``, in the order of placing."""
    seen = pieces["cluster"].value_counts()
    cluster_bit = {c: 1 << k for k, c in enumerate(sorted(seen.index[seen > 1]))}
    slots: dict[str, list[int]] = {}
    used = 0
    for source, quota in sorted(set(zip(pieces["source"], pieces["quota"], strict=True))):
        slots[source] = [1 << (used + k) for k in range(quota)]
        used += quota
    bins = Bins(capacity)
    return [bins.place(n, cluster_bit.get(c, 0), slots[s]) for n, c, s in zip(pieces["size"].tolist(), pieces["cluster"].tolist(), pieces["source"].tolist(), strict=True)]


def pack(df: DataFrame, *, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, piece, start, size, bin_id, source, cluster)``; ``start`` is the piece's place in the text's bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")).alias("source"),
        F.greatest(F.octet_length(text), F.lit(1)).cast("long").alias("total"),
        F.xxhash64(F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))).alias("cluster"),
    )
    # pieces that fill a bin take no part in the search, so only the rest goes through it
    piece = F.posexplode(F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / capacity)), lambda k: F.least(F.lit(capacity), F.col("total") - k * capacity)))
    pieces = rows.select("doc_id", "source", "cluster", piece.alias("piece", "size"))
    n_rows = df.count()
    groups = max(1, -(-n_rows // group_rows))

    shares = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("bytes"))
    # the documents of the source that an average bin would hold, with some slack
    per_bin = F.col("n") / F.greatest(F.ceil(F.sum("bytes").over(Window.partitionBy(F.lit(1))) / capacity), F.lit(1))
    quota = shares.select("source", F.least(F.greatest(F.ceil(per_bin * SLACK), F.lit(LEAST)), F.lit(4 * group_rows)).cast("int").alias("quota"))
    whole = pieces.where(F.col("size") == capacity)
    dealt = pieces.where(F.col("size") < capacity).join(quota, "source").withColumn("group", F.pmod(F.xxhash64(F.lit(5), "doc_id", "cluster"), F.lit(groups)))
    ordered = dealt.repartition("group").sortWithinPartitions("group", F.desc("size"), "cluster", "doc_id", "piece")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def packed(parts: list[pd.DataFrame]) -> pd.DataFrame:
            own = pd.concat(parts, ignore_index=True)
            bins = pack_group(own, capacity)
            own["bin_id"] = [f"{g}-{b}" for g, b in zip(own["group"], bins, strict=True)]
            return own.drop(columns=["quota", "group"])

        for batch in batches:
            for _, part in batch.groupby("group", sort=False):
                if held and held[-1]["group"].iat[-1] != part["group"].iat[0]:
                    yield packed(held)
                    held = []
                held.append(part)
        if held:
            yield packed(held)

    # ids pass as text: a null among them would turn longs into doubles
    schema = "source string, doc_id string, cluster long, piece int, size long, bin_id string"
    searched = ordered.select("source", F.col("doc_id").cast("string").alias("doc_id"), "cluster", "piece", "size", "quota", "group").mapInPandas(run, schema)
    searched = searched.withColumn("doc_id", F.col("doc_id").cast("long"))
    full = whole.withColumn("bin_id", F.concat(F.lit("full-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("-"), F.col("piece"), F.lit("-"), F.col("cluster")))
    out = searched.unionByName(full.select("source", "doc_id", "cluster", "piece", "size", "bin_id"))
    source = F.when(F.col("source") != "", F.substring("source", 2, 1 << 30))
    return out.select("doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), "size", "bin_id", source.alias("source"), "cluster")
