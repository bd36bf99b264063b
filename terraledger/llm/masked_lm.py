"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token (a word) is predicted from the two words on either side of it; the
sum of the conditional log-probabilities over a document's tokens is its score.
The network, in numpy, embeds the four neighbours, has one hidden layer and gives
a distribution over word classes; a word's share of its class comes from counts
over all documents.  Words beyond the ``vocabulary`` most frequent belong to
classes of their ending and length; their shares come from their own counts too,
joined from the table of all words.  The vocabulary grows with the cube root of the
corpus: ``ROOTS`` times that of its tokens, ``VOCABULARY`` at least.

Counts cover the whole corpus.  Rows are dealt by a hash of id and text to replicas
of about ``REPLICA_TOKENS`` tokens (more where the weights are large beside that);
each replica trains on all windows of its rows in a fixed order,
starting from weights fitted to a bounded sample (``warm_rows`` rows of at
most ``warm_chars`` characters); the replicas' weights are averaged by tokens in
two levels, in the order of the replicas, so what is gathered grows with the input,
what one task holds does not, and neither the layout of the table nor a repeated task
changes the model.

Defined cases: null and empty texts have no token and score 0; words outside a
document's ends are one pad symbol; repeated rows get equal scores; an empty table
gives no rows; extra columns are not read.  Texts are never cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraledger.llm.common import steps, words
from terraledger.sources.lineage import written

SIDE, DIM, HIDDEN = 2, 12, 24
KNOWN_CLASSES, OTHER_CLASSES = 48, 16
CLASSES = KNOWN_CLASSES + OTHER_CLASSES
VOCABULARY, ROOTS, SLOTS = 16_384, 40, 20
#: Tokens of a replica, and the least of them for each word of the vocabulary.
REPLICA_TOKENS, TOKENS_A_WORD = 2_000_000, 100
#: Logarithms of counts are summed as whole numbers of this unit, so that their order tells nothing.
UNIT = 1e-8
STEP, BATCH = 1 << 20, 4096
WARM_ROWS, WARM_CHARS = 400, 20_000
PART = 8192


def other_class(length: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Classes of rare words: by length and last byte."""
    return KNOWN_CLASSES + np.minimum(length // 5, 3) * 4 + (last.astype(np.int64) * 2654435761 >> 7 & 3)


@dataclass
class Lexicon:
    """The frequent words' hashes, in order of frequency, each word's class, and log shares of classes."""

    hashes: np.ndarray
    class_of: np.ndarray
    log_share: np.ndarray
    log_other: np.ndarray
    slot_bits: int = SLOTS

    def __post_init__(self) -> None:
        self.slots = np.full(1 << self.slot_bits, -1, np.int32)
        at = (self.hashes >> np.uint64(64 - self.slot_bits)).astype(np.int64)
        self.slots[at[::-1]] = np.arange(len(at), dtype=np.int32)[::-1]

    @property
    def size(self) -> int:
        return len(self.hashes) + OTHER_CLASSES + 1

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per token: symbol, class, log share in the class (of rare words without the log of their count), text, and word."""
        h, of, length, last = words(texts)
        at = self.slots[(h >> np.uint64(64 - self.slot_bits)).astype(np.int64)]
        known = (at >= 0) & (self.hashes[at] == h) if len(self.hashes) else np.zeros(len(h), bool)
        rare = other_class(length, last)
        symbol = np.where(known, at, len(self.hashes) + rare - KNOWN_CLASSES)
        if not len(self.hashes):
            return symbol, rare, self.log_other[rare - KNOWN_CLASSES], of, h
        return symbol, np.where(known, self.class_of[at], rare), np.where(known, self.log_share[at], self.log_other[rare - KNOWN_CLASSES]), of, h

    def contexts(self, symbol: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The symbols on both sides of each token, a pad beyond its text."""
        pad, n = self.size - 1, len(symbol)
        out = np.full((n, 2 * SIDE), pad, np.int32)
        for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
            a, b = max(0, -shift), min(n, n - shift)
            if b > a:
                same = of[a:b] == of[a + shift : b + shift]
                out[a:b, k] = np.where(same, symbol[a + shift : b + shift], pad)
        return out


class WindowNet:
    """Embeddings, one hidden layer and a softmax over classes."""

    def __init__(self, size: int, seed: int = 0):
        rng = np.random.RandomState(seed)
        self.w = [
            (rng.randn(size, DIM) * 0.1).astype(np.float32), (rng.randn(2 * SIDE * DIM, HIDDEN) / np.sqrt(2 * SIDE * DIM) * 2).astype(np.float32),
            np.zeros(HIDDEN, np.float32), (rng.randn(HIDDEN, CLASSES) / np.sqrt(HIDDEN)).astype(np.float32), np.zeros(CLASSES, np.float32),
        ]
        self.square = [np.full_like(w, 1e-3) for w in self.w[1:]]

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e, w1, b1, w2, b2 = self.w
        x = e[context].reshape(len(context), -1)
        h = np.tanh(x @ w1 + b1)
        y = h @ w2 + b2
        y -= y.max(1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(1, keepdims=True)
        return x, h, y

    def learn(self, context: np.ndarray, target: np.ndarray, rate: float = 0.05) -> None:
        """One pass over the windows, in batches."""
        for a in range(0, len(target), BATCH):
            ids, t = context[a : a + BATCH], target[a : a + BATCH]
            x, h, d = self.forward(ids)
            d[np.arange(len(t)), t] -= 1
            d /= len(t)
            dh = (d @ self.w[3].T) * (1 - h * h)
            dx = dh @ self.w[1].T
            for k, g in enumerate((x.T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                self.square[k] += g * g
                self.w[k + 1] -= rate * g / np.sqrt(self.square[k])
            # embeddings: plain steps on the sums of their windows' gradients
            order = np.argsort(ids, axis=None, kind="stable")
            own = ids.ravel()[order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            self.w[0][own[first]] -= (rate * 20) * np.add.reduceat(dx.reshape(-1, DIM)[order], first, axis=0)

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """In double precision and rounded, so that equal windows get equal values wherever they lie in a batch."""
        exact = WindowNet.__new__(WindowNet)
        exact.w = [w.astype(np.float64) for w in self.w]
        out = np.empty(len(target))
        for a in range(0, len(target), BATCH):
            y = exact.forward(context[a : a + BATCH])[2]
            out[a : a + BATCH] = np.round(np.log(np.maximum(y[np.arange(len(y)), target[a : a + BATCH]], 1e-12)), 9)
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.w])

    def set_flat(self, flat: np.ndarray) -> None:
        at = 0
        for k, w in enumerate(self.w):
            self.w[k] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, rare_class, n)`` over all documents ``(id, text)``; words are named by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in steps(batches, limit=STEP):
            h, _, length, last = words(texts)
            if len(h):
                word, first, n = np.unique(h, return_index=True, return_counts=True)
                rare = other_class(length[first], last[first])
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(rare.astype(np.int32)), pa.array(n)], names=["word", "rare_class", "n"])

    counted = docs.mapInArrow(run, "word long, rare_class int, n long")
    return counted.groupBy("word").agg(F.min("rare_class").alias("rare_class"), F.sum("n").alias("n"))


def token_sums(counts: DataFrame) -> dict[int, int]:
    """The tokens of each class of length and ending."""
    return {r["rare_class"]: r["n"] for r in counts.groupBy("rare_class").agg(F.sum("n").alias("n")).collect()}


def frequent(counts: DataFrame, vocabulary: int) -> pd.DataFrame:
    """The ``vocabulary`` most frequent words.

    A histogram of the counts first gives a count that about as many words reach, so
    what is sorted and gathered has the size of the vocabulary, however many parts there are.
    """
    level = F.floor(F.log2("n") * 16).cast("long")
    sizes = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    low, held = 0, 0
    for low, n in sizes:
        held += n
        if held >= vocabulary:
            break
    return counts.where(level >= low).orderBy(F.desc("n"), "word").limit(vocabulary).select("word", "rare_class", "n").toPandas()


def lexicon(counts: DataFrame, vocabulary: int | None = None) -> Lexicon:
    """The most frequent words in classes of about equal mass; of words that share a slot the most frequent stays known."""
    total = token_sums(counts)
    if vocabulary is None:
        vocabulary = max(VOCABULARY, int(ROOTS * math.cbrt(sum(total.values()))))
    slot_bits = max(SLOTS, vocabulary.bit_length() + 4)
    top = frequent(counts, vocabulary)
    slot = pd.Series(top["word"].to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - slot_bits))
    top = top[~slot.duplicated().to_numpy()]
    n = top["n"].to_numpy(np.float64)
    class_of = np.minimum((np.cumsum(n) - n / 2) / max(1.0, n.sum()) * KNOWN_CLASSES, KNOWN_CLASSES - 1).astype(np.int64)
    mass = np.bincount(class_of, n, KNOWN_CLASSES)
    tokens = np.array([total.get(KNOWN_CLASSES + c, 0) for c in range(OTHER_CLASSES)], np.float64)
    known = np.bincount(top["rare_class"] - KNOWN_CLASSES, n, OTHER_CLASSES) if len(top) else np.zeros(OTHER_CLASSES)
    share = np.log(n / np.maximum(mass[class_of], 1)) if len(n) else np.zeros(0)
    return Lexicon(top["word"].to_numpy(np.int64).view(np.uint64), class_of, share, -np.log(np.maximum(tokens - known, 1)), slot_bits)


def warm_start(docs: DataFrame, lex: Lexicon, warm_rows: int, warm_chars: int) -> WindowNet:
    """Weights fitted to the rows that come first in the order of a hash; a threshold on it leaves few to sort."""
    net = WindowNet(lex.size)
    short = docs.where(F.length("text") <= warm_chars).withColumn("_h", F.xxhash64(F.lit(9), "id", "text"))
    share = min(1.0, (4 * warm_rows + 200) / max(1, docs.count()))
    rows = short.where(F.col("_h") <= F.lit(min((1 << 63) - 1, int(share * 2.0**64) - (1 << 63)))).orderBy("_h", "id", "text").limit(warm_rows).select("text").collect()
    symbol, target, _, of, _ = lex.read([r.text for r in rows])
    context = lex.contexts(symbol, of)
    order = np.random.RandomState(1).permutation(len(target))
    for _ in range(2):
        net.learn(context[order], target[order])
    return net


def train(docs: DataFrame, lex: Lexicon, tokens: int, *, warm_rows: int = WARM_ROWS, warm_chars: int = WARM_CHARS) -> WindowNet:
    """Replicas on all windows of all rows ``(id, text)``, averaged by their tokens."""
    net = warm_start(docs, lex, warm_rows, warm_chars)
    held = docs.sparkSession.sparkContext.broadcast((lex, net))
    replicas = max(8, -(-tokens // max(REPLICA_TOKENS, TOKENS_A_WORD * lex.size)))
    # as many lanes as there are replicas in a lane: no group holds more than the root of the replicas
    lanes = max(1, math.isqrt(replicas))
    h = F.xxhash64(F.lit(3), "id", "text")
    dealt = docs.where("text is not null").select(F.pmod(h, F.lit(replicas)).cast("int").alias("replica"), h.alias("h"), "id", "text")
    kind = np.uint16 if lex.size < 1 << 16 else np.int32

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_lex = held.value[0]
        for batch, texts in steps(batches, limit=STEP):
            symbol, _, _, of, _ = own_lex.read(texts)
            cuts = np.searchsorted(of, np.arange(len(texts) + 1)) * np.dtype(kind).itemsize
            raw = symbol.astype(kind).tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["replica", "h", "id", "symbols"])

    # symbols are shuffled and not texts: a third of their size, and read once
    read = dealt.mapInArrow(coded, "replica int, h long, id long, symbols binary")
    laid = read.repartition(replicas, "replica").sortWithinPartitions("replica", "h", "id").select("replica", "symbols")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_lex, start = held.value
        own, now, seen, rows, size = WindowNet(own_lex.size), None, 0, [], 0
        known = len(own_lex.hashes)
        classes = np.r_[own_lex.class_of, KNOWN_CLASSES + np.arange(OTHER_CLASSES)] if known else KNOWN_CLASSES + np.arange(OTHER_CLASSES)

        def learnt() -> None:
            # steps are cut by what the replica has read, so batches and neighbours tell nothing
            nonlocal seen, rows, size
            if size:
                s = np.frombuffer(b"".join(rows), kind).astype(np.int64)
                text = np.repeat(np.arange(len(rows)), [len(r) // np.dtype(kind).itemsize for r in rows])
                own.learn(own_lex.contexts(s, text), classes[s])
                seen += len(s)
            rows, size = [], 0

        def ended() -> Iterator[pa.RecordBatch]:
            learnt()
            if seen:
                flat = own.flat().astype(np.float64) * seen
                parts = [flat[a : a + PART] for a in range(0, len(flat), PART)]
                n = len(parts)
                arrays = [pa.array(range(n), pa.int32()), pa.array([now % lanes] * n, pa.int32()), pa.array([now] * n, pa.int32()), pa.array([seen] * n, pa.int64()), pa.array(parts, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "lane", "replica", "seen", "weights"])

        for batch in batches:
            for replica, symbols in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if replica != now:
                    if now is not None:
                        yield from ended()
                    now, seen = replica, 0
                    own.set_flat(start.flat())
                    own.square = [s.copy() for s in start.square]
                rows.append(symbols)
                size += len(symbols)
                if size >= STEP:
                    learnt()
        if now is not None:
            yield from ended()

    def summed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("replica")
        total = np.zeros(len(pdf["weights"].iat[0]))
        for w in pdf["weights"]:
            total += w
        return pd.DataFrame({"part": [key[0]], "lane": [0], "replica": [pdf["replica"].iat[0]], "seen": [pdf["seen"].sum()], "weights": [total]})

    shape = "part int, lane int, replica int, seen long, weights array<double>"
    by_lane = laid.mapInArrow(run, shape).groupBy("part", "lane").applyInPandas(summed, shape)
    rows = by_lane.groupBy("part").applyInPandas(summed, shape).orderBy("part").collect()
    if rows:
        net.set_flat(np.concatenate([np.array(r.weights) / r.seen for r in rows]))
    return net


def score(docs: DataFrame, lex: Lexicon, net: WindowNet, counts: DataFrame) -> DataFrame:
    """``(id, n_tokens, log_likelihood, mean_log_probability)`` of whole texts ``(id, text)``."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((lex, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_lex, own = held.value
        row = TaskContext.get().partitionId() << 36
        for batch, texts in steps(batches, limit=STEP):
            symbol, target, share, of, word = own_lex.read(texts)
            logs = own.log_probability(own_lex.contexts(symbol, of), target) + share
            n = np.bincount(of, minlength=len(texts))
            total = np.bincount(of, logs, len(texts))
            # each text's rare words, once with their number
            rare = symbol >= len(own_lex.hashes)
            r_of, r_word = of[rare], word[rare]
            order = np.lexsort((r_word, r_of))
            r_of, r_word = r_of[order], r_word[order]
            first = np.flatnonzero(np.r_[True, (np.diff(r_of) != 0) | (r_word[1:] != r_word[:-1])]) if len(r_of) else np.zeros(0, np.int64)
            times = np.diff(np.r_[first, len(r_of)])
            offsets = np.searchsorted(r_of[first], np.arange(len(texts) + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(r_word[first].view(np.int64)), pa.array(times.astype(np.int64))], names=["word", "times"])
            uid = pa.array(row + np.arange(len(texts), dtype=np.int64))
            row += len(texts)
            yield pa.RecordBatch.from_arrays([uid, batch.column(0), pa.array(n), pa.array(total), pa.ListArray.from_arrays(pa.array(offsets), entries)], names=["uid", "id", "n_tokens", "total", "rare"])

    read = written(docs.mapInArrow(run, "uid long, id long, n_tokens long, total double, rare array<struct<word:long,times:long>>"))
    logs = counts.select("word", F.round(F.log("n") / UNIT).cast("long").alias("log_n"))
    own = read.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.times").join(logs, "word").groupBy("uid").agg(F.sum(F.col("times") * F.col("log_n")).alias("of_rare"))
    total = F.col("total") + F.coalesce("of_rare", F.lit(0)) * UNIT
    out = read.select("uid", "id", "n_tokens", "total").join(own, "uid", "left").select("id", "n_tokens", total.alias("log_likelihood"))
    return out.withColumn("mean_log_probability", F.col("log_likelihood") / F.greatest("n_tokens", F.lit(1)))


def pseudo_likelihood(df: DataFrame, *, vocabulary: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on all of ``df`` and score each of its rows."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counts = written(word_counts(docs))
    lex = lexicon(counts, vocabulary)
    return score(docs, lex, train(docs, lex, sum(token_sums(counts).values())), counts)
