"""Alignment of two tokenizers' tokens by the bytes they cover.

A task lays the texts of a step of an Arrow batch end to end, with each text's
first and last byte, counts the byte offsets at which tokens of either tokenizer
end in one ``bincount``, and cuts where both end.  Groups, links and ids of every
text then follow from prefix sums taken at the texts' bounds; nothing walks a
text.  A (byte-level BPE) reads a space and the text; B (BPE with byte fallback)
reads the text and adds that space.

An id pair counts once for each document that links it.  The pairs of a document
are written once with how often they occur; counts are grouped over the whole
corpus, pre-aggregated in each task, and joined back.  The counts' table grows
with the vocabularies' joint use, so it is broadcast only up to ``most_broadcast``
pairs; beyond that the most frequent ones are, and the others, none of which is
frequent, go through a shuffled join.  Both ways give the same rows.

Both encoders work on stretches between a non-space and a single space or line
feed, at which no token of either can cross; a worker keeps what it has encoded.

Defined cases: a null or empty text, and one that a tokenizer doesn't give back
byte for byte (B reads U+2581 as a space), has no tokens: zeros and an empty
digest; texts are never cut; repeated rows are documents of their own; special
tokens' strings are plain text; an empty table gives no rows; other columns are
not read.  Memory in a task follows its longest text, about 60 bytes a byte.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraledger.llm.bpe import PairIndexBpe
from terraledger.llm.common import steps
from terraledger.sources.lineage import written

#: Pairs whose counts may be broadcast, about 60 bytes each in an executor.
MOST_BROADCAST = 2_000_000
#: Stretches a worker keeps encoded; a full store is emptied, which changes no result.
KNOWN = 300_000
#: Text bytes laid end to end at once; a longer text is one step of its own.
STEP = 2 << 20
#: Groups with more tokens than this on both sides are counted by distinct ids.
WIDE = 32
CUT, TWO_SPACES = re.compile(r"(?<=\S)(?=[ \n]\S)"), re.compile(r"\s\s")


class Encoded:
    """Token ids of stretches, laid end to end: those of number ``k`` are ``flat[start[k]:start[k + 1]]``."""

    def __init__(self) -> None:
        self.flat, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, lists: list[list[int]]) -> None:
        more = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in lists for i in x), np.int32, more[-1])])
        self.start = np.concatenate([self.start, self.start[-1] + more])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given stretches end to end, and how many each has."""
        n = self.start[numbers + 1] - self.start[numbers]
        before = np.cumsum(n) - n
        return self.flat[np.repeat(self.start[numbers] - before, n) + np.arange(n.sum())], n


class Pair:
    """Both tokenizers, and the stretches met so far."""

    def __init__(self, spec_a: str, model_b: bytes, known: int = KNOWN):
        self.a = PairIndexBpe(spec_a, match_specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.size_a, self.size_b = max(self.a.bytes_of) + 1, self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        if any(re.search(r"[^▁]▁|.\n|\n.", p) for p in pieces):
            raise ValueError("tokenizer B has pieces that go on after a space or over a line feed")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a = np.array([len(self.a.bytes_of.get(i, b"")) for i in range(self.size_a)], np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.space = self.b.piece_to_id("▁")
        self.text_of = _id_texts(max(self.size_a, self.size_b))
        self.known = known
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers()
        self.ids_a, self.ids_b, self.right = Encoded(), Encoded(), np.zeros(0, bool)

    @staticmethod
    def stretches(text: str) -> list[str]:
        """A space and the text, cut where no token of either tokenizer can cross.

        A stretch is spelled without its first space; one that starts with a
        line feed goes on from the stretch before, and NUL marks one in full.
        """
        spaced = " " + text
        if TWO_SPACES.search(spaced) or spaced[-1].isspace() or "\0" in text:
            return ["\0" + s for s in CUT.split(spaced)]
        return text.replace("\n", " \n").split(" ")

    def learn(self, new: list[str]) -> None:
        new = [s[1:] if s[:1] == "\0" else s if s[:1] == "\n" else " " + s for s in new]
        cut = [self.a.split.findall(s) for s in new]
        fresh = list({w: None for got in cut for w in got})
        words = dict(zip(fresh, self.a.merge_all([w.encode() for w in fresh]), strict=True))
        ids_a = [words[got[0]] if len(got) == 1 else [i for w in got for i in words[w]] for got in cut]
        # B puts its own space first: it stands for the stretch's, or is taken off where that starts with a line feed
        ids_b = self.b.encode([s[1:] if s[0] == " " else s for s in new], num_threads=1)
        ids_b = [ids if s[0] == " " else ids[1:] if ids[:1] == [self.space] else [] for s, ids in zip(new, ids_b, strict=True)]
        byte_a, byte_b = self.a.bytes_of.__getitem__, self.bytes_b.__getitem__
        right = [b"".join(map(byte_a, a)) == (raw := s.encode()) and b"".join(map(byte_b, b)) == raw for s, a, b in zip(new, ids_a, ids_b, strict=True)]
        self.ids_a.add(ids_a)
        self.ids_b.add(ids_b)
        self.right = np.concatenate([self.right, np.array(right, bool)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The stretch numbers of all texts end to end, and of how many each text consists; texts without tokens have none."""
        if len(self.number) > self.known:
            self.forget()
        cut = [self.stretches(t) if t else [] for t in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, n.sum())
        if self.number.new:
            self.learn(self.number.new)
            self.number.new = []
        wrong = ~self.right[numbers]
        if not wrong.any():
            return numbers, n
        of = np.repeat(np.arange(len(texts)), n)
        whole = np.bincount(of[wrong], minlength=len(texts)) == 0
        return numbers[whole[of]], np.where(whole, n, 0)


class _Numbers(dict):
    """Numbers strings as they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


def _id_texts(n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Decimal ids behind nothing, ``,``, ``|`` and ``;``, as rows of bytes with their lengths."""
    texts = [f"{mark}{i}".encode() for mark in ("", ",", "|", ";") for i in range(n)]
    width = max(map(len, texts))
    return np.frombuffer(b"".join(t.ljust(width) for t in texts), np.uint8).reshape(-1, width), np.array(list(map(len, texts)), np.int64), n


def _segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the stretches between consecutive bounds, from one prefix sum."""
    return np.diff(np.r_[0, np.cumsum(values)][bounds])


def align(own: Pair, texts: list[str | None]) -> dict[str, object]:
    """Groups, links, digests and counted pairs of every text of a step."""
    numbers, n = own.encode(texts)
    bounds = np.r_[0, np.cumsum(n)]
    a, a_each = own.ids_a.of(numbers)
    b, b_each = own.ids_b.of(numbers)
    n_a, n_b = _segment_sums(a_each, bounds), _segment_sums(b_each, bounds)
    ends_a, ends_b = np.cumsum(own.length_a[a]), np.cumsum(own.length_b[b])
    last = np.r_[0, ends_a][np.r_[0, np.cumsum(n_a)]]  # the byte at which each text ends

    both = np.bincount(np.concatenate([ends_a, ends_b]), minlength=int(last[-1]) + 1) == 2
    cuts = np.cumsum(both)
    groups = int(cuts[-1])
    group_a, group_b = (cuts - both)[ends_a], (cuts - both)[ends_b]
    in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    at_group = cuts[last]  # groups before each text's end
    n_links = _segment_sums(in_a * in_b, at_group)

    # decimal ids in the order of the digest: a group's A ids, then its B ids
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    rows, lengths, ids = own.text_of
    code = np.empty(len(a) + len(b), np.int64)
    opens_a, opens_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    opens_a[first_a], opens_b[first_b] = True, True
    mark = np.where(opens_a, 3, 1)
    mark[np.r_[0, np.cumsum(n_a)][:-1][n_a > 0]] = 0
    code[np.arange(len(a)) + first_b[group_a]] = mark * ids + a
    code[np.arange(len(b)) + (first_a + in_a)[group_b]] = np.where(opens_b, 2, 1) * ids + b
    length = lengths[code]
    flat = rows[code][np.arange(rows.shape[1]) < length[:, None]]
    stop = np.r_[0, np.cumsum(length)][np.r_[0, np.cumsum(n_a + n_b)]]
    digests = [sha256(flat[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(stop[:-1].tolist(), stop[1:].tolist(), strict=True)]

    # the links of each group as pairs of ids; most groups hold one, wide ones are counted by their distinct ids
    text_of = np.repeat(np.arange(len(texts)), np.diff(at_group)) * (own.size_a * own.size_b)
    key = lambda g, x, y: text_of[g] + x * np.int64(own.size_b) + y
    one = in_a * in_b == 1
    wide = (in_a > WIDE) & (in_b > WIDE)
    single = np.flatnonzero(one)
    several = np.flatnonzero(~(one | wide))
    links = in_a[several] * in_b[several]
    g = np.repeat(several, links)
    within = np.arange(len(g)) - np.repeat(np.cumsum(links) - links, links)
    x, y = np.divmod(within, in_b[g])
    keys = np.concatenate([key(single, a[first_a[single]], b[first_b[single]]), key(g, a[first_a[g] + x], b[first_b[g] + y])])
    pairs, times = np.unique(keys, return_counts=True)
    if wide.any():
        more, often = [pairs], [times]
        for w in np.flatnonzero(wide).tolist():
            x, nx = np.unique(a[first_a[w] : first_a[w] + in_a[w]], return_counts=True)
            y, ny = np.unique(b[first_b[w] : first_b[w] + in_b[w]], return_counts=True)
            more.append(key(w, x.astype(np.int64)[:, None], y).ravel())
            often.append((nx[:, None] * ny).ravel())
        pairs, back = np.unique(np.concatenate(more), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, back, np.concatenate(often))
    space = own.size_a * own.size_b
    offsets = np.searchsorted(pairs, np.arange(len(texts) + 1) * space)
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.diff(at_group), "n_links": n_links, "digests": digests, "pairs": pairs % space, "times": times, "offsets": offsets}


def encoded_pairs(df: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)``: what a document gives by itself.

    The two files (a few MB, of fixed size) are broadcast once.
    """
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        files = df.sparkSession.sparkContext.broadcast((f.read(), g.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(files)
        gc.disable()  # millions of strings and no cycles: the collector would only walk them
        try:
            for batch, texts in steps(batches, limit=STEP):
                x = align(own, texts)
                of = lambda v: pa.ListArray.from_arrays(pa.array(x["offsets"].astype(np.int32)), pa.array(x[v]))  # noqa: E731, B023
                columns = [batch.column(0), *[pa.array(x[v]) for v in ("n_a", "n_b", "n_groups", "n_links")], pa.array(x["digests"], pa.string()), of("pairs"), of("times")]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
        finally:
            gc.enable()

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


_HELD: dict[int, Pair] = {}


def _loaded(files) -> Pair:
    """One pair of tokenizers a worker process; it outlives its task."""
    key = files.id if hasattr(files, "id") else id(files)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Pair(*files.value)
    return _HELD[key]


def pair_counts(encoded: DataFrame, size_b: int) -> DataFrame:
    """Rows ``(pair, n, best)``: the documents that link a pair, and whether no other pair of its A id has more."""
    counts = encoded.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy(F.expr(f"pair div {size_b}"))  # as many rows at most as B has ids
    return counts.withColumn("best", F.col("n") == F.max("n").over(of))


def linked(df: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    encoded = written(encoded_pairs(df, path_a, path_b, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()))
    counts = written(pair_counts(encoded, size_b))
    links = encoded.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))).alias("pair", "times"))
    size = counts.count()
    if size <= most_broadcast:
        met = links.join(F.broadcast(counts), "pair")
    else:
        # at most `most_broadcast` pairs lie above this count, give or take a ten-thousandth of all
        least = counts.agg(F.percentile_approx("n", 1 - most_broadcast / size, 10_000)).first()[0]
        often = F.broadcast(counts.where(F.col("n") > least))
        met = links.join(often, "pair").unionByName(links.join(often, "pair", "left_anti").join(counts.where(F.col("n") <= least), "pair"))
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    known = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return encoded.join(sums, "row", "left").select("id", "n_a", "n_b", "n_groups", "n_links", known("n_best"), known("count_sum"), "groups_sha256")
