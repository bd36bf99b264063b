"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
A text is cut into windows of one word; each window is compressed under both
dictionaries, and the difference of the two lengths is its margin.  Toxic text
is ordinary language plus insult, so the toxic dictionary is trained on what toxic
documents over-use, and the ordinary one's content follows it: on ordinary windows
the lengths then agree, and a positive margin is a toxic match.  What toxic
documents over-use are word starts (insults are inflected and compounded) that a
much larger share of toxic than of ordinary training documents holds once, or holds
twice: a rare language's insult may be an ordinary text's accident, but not twice.
No list of words or languages is given.  Each window ends in a fixed tail that both
dictionaries hold, since zstandard stores what it cannot shorten as it is, and a
word alone would never be compressed.

How many windows reach each of the thresholds ``LEVELS``, and what share of the
text they are, is calibrated to the score by a logistic model.

Fitting takes a bounded sample of labelled rows (``per_class`` toxic and twice
as many ordinary ones, of ``max_chars`` characters at most, in the order of a
hash of the id).  The classes' counts over all training labels correct the
intercept for the sample's shares.  Scoring takes every window of every whole text.

Defined cases: null and empty texts count as one empty window and get the score
of a text with no margin; labels that are null are skipped; where one of the two
classes has no training row every score is the share of toxic rows (0 with no
labelled row at all); repeated rows get equal scores; extra columns are left as
they are and never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraledger.llm.common import steps
from terraledger.llm.models import fit_logistic, logistic

#: Both dictionaries together fit the compressor's window of 16 KB.
TOXIC_BYTES, ORDINARY_BYTES, TAIL, LEVEL = 4_096, 9_000, 64, 6
#: Bytes of the word starts that are counted, with the space before them.
STARTS, START_BITS = range(4, 13), 22
#: How much more often toxic documents hold a word start that counts as over-used.
OVER = 20
#: Margins from which a window counts.
LEVELS = (1, 2, 3, 4, 5, 6)
#: Margins of words that a task remembers; a full store is emptied, which changes no result.
KNOWN = 400_000
#: Texts whose words the fit holds at once.
FIT_TEXTS = 100


def clean(text: str | None) -> bytes:
    return (" " + " ".join((text or "").lower().split())).encode()


def windows(texts: list[bytes], words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts end to end, and each window's start, length and text."""
    data = b"".join(texts)
    length = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(length)
    space = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    of = np.searchsorted(ends, space, "right")
    first = np.searchsorted(space, ends - length)
    chosen = (np.arange(len(space)) - first[of]) % words == 0
    starts = space[chosen]
    return data, starts, np.append(starts[1:], len(data)) - starts, of[chosen]


def word_starts(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word and each length of ``STARTS`` that it has: the start's hash cell, its place and its length."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    space = np.flatnonzero(a == 32)
    room = np.append(space[1:], len(a)) - space
    h = np.zeros(len(space), np.uint64)
    cells, at, size = [], [], []
    for k in range(max(STARTS)):
        live = room > k
        h[live] = h[live] * np.uint64(1099511628211) + a[space[live] + k] + np.uint64(1)
        if k + 1 in STARTS:
            cells.append((((h[live] + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - START_BITS)).astype(np.int64))
            at.append(space[live])
            size.append(np.full(len(cells[-1]), k + 1))
    return np.concatenate(cells), np.concatenate(at), np.concatenate(size)


class CompressionDistance:
    """Both dictionaries and the calibration."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic, ordinary
        self.weights: np.ndarray | None = None
        self.prior = 0.0

    def compressors(self) -> tuple[zs.ZstdCompressor, zs.ZstdCompressor]:
        def made(content: bytes) -> zs.ZstdCompressor:
            own = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            rule = zs.ZstdCompressionParameters(window_log=14, hash_log=14, chain_log=14, search_log=8, target_length=64, min_match=4, strategy=zs.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False)
            own.precompute_compress(compression_params=rule)
            return zs.ZstdCompressor(dict_data=own, compression_params=rule)

        return made(self.ordinary), made(self.toxic + self.ordinary)

    def measured(self, words: list[bytes], pair) -> np.ndarray:
        """The margin of each window."""
        tail = b" " + self.ordinary[-TAIL:]
        data = [b" " + w + tail for w in words]
        length = np.array([len(d) for d in data], np.int64)
        cut = zs.BufferWithSegments(b"".join(data), np.stack([np.cumsum(length) - length, length], 1).astype(np.uint64).tobytes())
        plain, toxic = (c.multi_compress_to_buffer(cut) for c in pair)
        return np.fromiter((len(plain[k]) - len(toxic[k]) for k in range(len(data))), np.float64, len(data))

    def margins(self, texts: list[str | None], pair, known: dict[bytes, float] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Each window's margin, and the text that it belongs to; equal windows are compressed once."""
        known = {} if known is None else known
        cut = [clean(t).split() or [b""] for t in texts]
        of = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        new = list({w for c in cut for w in c if w not in known})
        if new:
            if len(known) > KNOWN:
                known.clear()
                new = list({w for c in cut for w in c})
            known.update(zip(new, self.measured(new, pair).tolist(), strict=True))
        return np.fromiter((known[w] for c in cut for w in c), np.float64, len(of)), of

    def features(self, margin: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        count = np.bincount(of, minlength=n)
        over = [np.bincount(of, margin >= q, n) for q in LEVELS]
        return np.column_stack([*map(np.log1p, over), *[np.log((o + 0.5) / (count + 20)) for o in over], np.log(count)])

    def score(self, texts: list[str | None], pair, known: dict[bytes, float] | None = None) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        return logistic(self.features(*self.margins(texts, pair, known), len(texts)), self.weights)


def _held_by(texts: list[bytes], often: int) -> np.ndarray:
    """How many of the texts hold each word start ``often`` times at least."""
    held = np.zeros(1 << START_BITS, np.min_scalar_type(len(texts)))
    for t in texts:
        cell, n = np.unique(word_starts(t)[0], return_counts=True)
        held[cell[n >= often]] += 1
    return held


def over_used(toxic: list[bytes], ordinary: list[bytes]) -> list[tuple[bytes, int]]:
    """Word starts that toxic texts over-use and how often they stand there, most frequent first.

    Of the starts of a family (those that begin with the same shortest one) the
    longest that still covers half of its uses is taken.
    """
    least = min(5, max(2, len(toxic) // 20))
    marked = np.zeros(1 << START_BITS, bool)
    for often in (1, 2):
        own, other = (_held_by(side, often) for side in (toxic, ordinary))
        cell = np.flatnonzero(own >= least)
        marked[cell] |= (own[cell] + 0.1) / len(toxic) > OVER * (other[cell] + 0.1) / len(ordinary)
    uses: Counter[bytes] = Counter()
    for t in toxic:
        cell, at, size = word_starts(t)
        hit = marked[cell]
        uses.update(t[a : a + n] for a, n in zip(at[hit].tolist(), size[hit].tolist(), strict=True))
    best: dict[bytes, bytes] = {}
    for start in sorted(uses, key=lambda s: (len(s), s)):
        family = next(start[:k] for k in STARTS if start[:k] in uses)
        if uses[start] * 2 >= uses[family]:
            best[family] = start
    return sorted(((s, uses[f]) for f, s in best.items() if uses[f] >= 2 * least), key=lambda x: (-x[1], x[0]))


def fit(toxic: list[str], ordinary: list[str]) -> CompressionDistance:
    """Dictionaries and calibration from labelled texts."""
    if not toxic or not ordinary:
        model = CompressionDistance(b"", b"")
        model.prior = float(bool(toxic))
        return model
    sides = [list(map(clean, x)) for x in (toxic, ordinary)]
    marks = over_used(*sides)
    # the most frequent last: what lies nearest is the cheapest to refer to
    toxic_part = b"".join(s + b" " for s, _ in reversed(marks[: TOXIC_BYTES // (max(STARTS) + 1)]))
    ordinary_part = _dictionary(_picked(sides[1], 4, 30_000), ORDINARY_BYTES)
    del sides
    model = CompressionDistance(toxic_part, ordinary_part)
    label = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    # by parts: the words of all texts together take many times the texts' bytes
    pair, known, parts = model.compressors(), {}, []
    for side in (toxic, ordinary):
        for at in range(0, len(side), FIT_TEXTS):
            own = side[at : at + FIT_TEXTS]
            parts.append(model.features(*model.margins(own, pair, known), len(own)))
    model.weights = fit_logistic(np.concatenate(parts), label)
    return model


def _picked(texts: list[bytes], words: int, n: int) -> list[bytes]:
    """Some windows of the texts, in an order drawn once for all."""
    data, starts, length, _ = windows(texts, words)
    pick = np.random.RandomState(0).permutation(len(starts))[:n]
    return [data[s : s + k] for s, k in zip(starts[pick], length[pick], strict=True)]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zs.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


def training_labels(labels: DataFrame, label: str, training: Column, id_col: str) -> DataFrame:
    """``(_id, _label)``, one training row for each id."""
    own = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")).where(F.col("_id").isNotNull())
    return own.where(training).groupBy("_id").agg(F.min("_label").alias("_label"))


def class_counts(labels: DataFrame, label: str, training: Column, *, id_col: str = "doc_id") -> dict[int, int]:
    """How many training labels each class has, over all rows."""
    rows = training_labels(labels, label, training, id_col).where("_label is not null").groupBy("_label").count().collect()
    return {r["_label"]: r["count"] for r in rows}


def class_shift(counts: dict[int, int], per_class: dict[int, int]) -> float:
    """What takes log-odds of class 1 in a sample capped by ``per_class`` to the shares of all training labels."""
    if not counts.get(0) or not counts.get(1):
        return 0.0
    over = {c: math.log(counts[c] / min(counts[c], per_class[c])) for c in (0, 1)}
    return over[1] - over[0]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, counts: dict[int, int], per_class: dict[int, int], *, max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """A bounded sample of labelled training texts, for each class the first ids in the order of a hash.

    The label rows are chosen first: a threshold on the hash leaves about four times
    as many as are asked for, whatever the table's size, and only those are sorted.
    So what is broadcast and collected has the size that ``per_class`` and
    ``max_chars`` allow.  Of rows that repeat an id the smallest text is taken.
    """
    own = training_labels(labels, label, training, id_col).withColumn("_h", F.xxhash64("_id"))
    chosen = None
    for value, n in per_class.items():
        share = min(1.0, (4 * n + 200) / max(1, counts.get(value, 0)))
        low = own.where((F.col("_label") == value) & (F.col("_h") <= F.lit(min((1 << 63) - 1, int(share * 2.0**64) - (1 << 63)))))
        part = low.orderBy("_h", "_id").limit(n).drop("_h")
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.length("_text") <= max_chars)
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text")).collect()
    return [(r._text, r._label) for r in sorted(rows, key=lambda r: r._id)]


def fit_on(docs: DataFrame, labels: DataFrame, training: Column, *, label: str = "toxic", per_class: int = 1500, max_chars: int = 20_000) -> CompressionDistance:
    caps = {1: per_class, 0: 2 * per_class}
    counts = class_counts(labels, label, training)
    rows = labelled_sample(docs, labels, label, training, counts, caps, max_chars=max_chars)
    model = fit([t for t, y in rows if y], [t for t, y in rows if not y])
    if model.weights is not None:
        model.weights[0, 0] += class_shift(counts, caps)
    return model


def score(df: DataFrame, model: CompressionDistance, *, text_col: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 up); the texts stay where they are.

    Columns of ``df`` with these names are replaced.
    """
    kept = [c for c in df.columns if c not in ("score", "predicted")]
    held = df.sparkSession.sparkContext.broadcast(model)
    schema = df.select(kept).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        pair = own.compressors() if own.weights is not None else None
        known: dict[bytes, float] = {}
        for batch, texts in steps(batches, text_col):
            p = np.clip(own.score(texts, pair, known), 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return df.select(kept).mapInArrow(run, schema)
