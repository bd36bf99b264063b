"""Quality by attention-based multiple-instance learning.

A document is a bag of passages.  Each passage is encoded from its hashed byte
trigrams and a few shares of its bytes; gated attention weighs the passages, and
the weighted representation gives the document's score.  Encoder, gate and
output are trained together in numpy from document labels alone.

Fitting takes a bounded sample of labelled rows (``per_class`` of each class, of
``max_chars`` characters at most, first in the order of a hash of the id),
and corrects the bias by the classes' counts over all training labels;
scoring takes every passage of every whole text.

Defined cases: null and empty texts are one empty passage and get the model's
score for it; null labels are skipped; where a class has no training row every
score is 1 or 0 as the other class is (0 with none); repeated rows get equal
scores; extra columns stay and are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from terraledger.llm.common import steps
from terraledger.llm.models import sigmoid
from terraledger.llm.toxicity import class_counts, class_shift, labelled_sample, windows

WORDS, BUCKETS, HIDDEN, GATE = 48, 1024, 24, 12
STEP = 1 << 20
SHARES = 8
#: Texts that a fit encodes at once.
ENCODED = 20


def spaced(text: str | None) -> bytes:
    return (" " + (text or "").replace("\n", " ").replace("\t", " ")).encode()


def encode_passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Each passage's features, and the text that it belongs to."""
    data, start, length, of = windows([spaced(t) for t in texts], WORDS)
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    n = len(start)
    passage = np.repeat(np.arange(n, dtype=np.int64), length)
    h = (a[:-2] * np.uint32(0x1F1F1F) + a[1:-1] * np.uint32(0x9E3779B1) + a[2:] * np.uint32(0x85EBCA6B)) if len(a) > 2 else a[:0]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    inside = passage[2:] == passage[:-2] if len(a) > 2 else np.zeros(0, bool)
    key = passage[:-2][inside] * BUCKETS + (h[inside] >> np.uint32(22)).astype(np.int64) if len(a) > 2 else np.zeros(0, np.int64)
    x = np.zeros((n, BUCKETS + SHARES), np.float32)
    x[:, :BUCKETS] = np.sqrt(np.bincount(key, minlength=n * BUCKETS).reshape(n, BUCKETS))
    x[:, :BUCKETS] /= np.maximum(np.linalg.norm(x[:, :BUCKETS], axis=1, keepdims=True), 1e-6)
    kinds = (a == 32, (a >= 65) & (a <= 90), (a >= 48) & (a <= 57), (a >= 33) & (a <= 47), (a >= 58) & (a <= 64), a >= 128, (a >= 91) & (a <= 96) | (a >= 123) & (a < 128))
    for k, kind in enumerate(kinds):
        x[:, BUCKETS + k] = np.bincount(passage, kind, n) / np.maximum(length, 1)
    x[:, BUCKETS + len(kinds)] = np.log1p(length) / 8
    return x, of


class Bags:
    """The passages of texts, kept as the features that are not 0: most are, and the driver holds all of a fit's."""

    def __init__(self, texts: list[str]):
        self.passages = np.zeros(len(texts), np.int64)
        #: Of each ``ENCODED`` texts: places, values, and where each text's begin and end.
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(texts), ENCODED):
            own = texts[at : at + ENCODED]
            x, of = encode_passages(own)
            self.passages[at : at + len(own)] = np.bincount(of, minlength=len(own))
            row, feature = np.nonzero(x)
            # places count from the first passage of the text
            place = (row - np.searchsorted(of, of)[row]) * x.shape[1] + feature
            self.parts.append((place.astype(np.int32), x[row, feature], np.searchsorted(of[row], np.arange(len(own) + 1))))

    def laid(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The passages of the texts ``own`` end to end, and the place in ``own`` that each belongs to."""
        n = self.passages[own]
        x = np.zeros((n.sum(), BUCKETS + SHARES), np.float32)
        flat = x.reshape(-1)
        for k, start in zip(own, (np.cumsum(n) - n) * x.shape[1], strict=True):
            place, value, cuts = self.parts[k // ENCODED]
            at = slice(cuts[k % ENCODED], cuts[k % ENCODED + 1])
            flat[start + place[at]] = value[at]
        return x, np.repeat(np.arange(len(own)), n)


class GatedAttention:
    """Weights of encoder, gate and output; a forward pass over bags laid end to end."""

    def __init__(self, seed: int = 0):
        rng = np.random.RandomState(seed)
        d = BUCKETS + SHARES
        draw = lambda *s: (rng.randn(*s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {"enc": draw(d, HIDDEN) * 3, "enc_b": np.zeros(HIDDEN, np.float32), "v": draw(HIDDEN, GATE), "u": draw(HIDDEN, GATE), "a": draw(GATE, 1)[:, 0], "out": draw(HIDDEN, 1)[:, 0], "out_b": np.zeros(1, np.float32)}
        self.only: float | None = None

    def forward(self, x: np.ndarray, of: np.ndarray, n: int) -> dict[str, np.ndarray]:
        w = self.w
        h = np.tanh(x @ w["enc"] + w["enc_b"])
        t, g = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
        e = (t * g) @ w["a"]
        starts = np.searchsorted(of, np.arange(n))
        e = np.exp(e - np.maximum.reduceat(e, starts)[of])
        weight = e / np.add.reduceat(e, starts)[of]
        z = np.add.reduceat(weight[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "p": sigmoid(z @ w["out"] + w["out_b"]), "starts": starts}

    def gradients(self, x: np.ndarray, of: np.ndarray, y: np.ndarray, f: dict) -> dict[str, np.ndarray]:
        w, n = self.w, len(y)
        dy = (f["p"] - y) / n
        dz = dy[:, None] * w["out"]
        part = (dz[of] * f["h"]).sum(1)
        de = f["weight"] * (part - np.add.reduceat(f["weight"] * part, f["starts"])[of])
        gate = de[:, None] * w["a"]
        dt, dg = gate * f["g"] * (1 - f["t"] ** 2), gate * f["t"] * f["g"] * (1 - f["g"])
        dh = f["weight"][:, None] * dz[of] + dt @ w["v"].T + dg @ w["u"].T
        dh *= 1 - f["h"] ** 2
        return {"enc": x.T @ dh, "enc_b": dh.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "a": (f["t"] * f["g"]).T @ de, "out": f["z"].T @ dy, "out_b": dy.sum(keepdims=True)}

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.only is not None:
            return np.full(len(texts), self.only)
        x, of = encode_passages(texts)
        exact = GatedAttention.__new__(GatedAttention)
        exact.w = {k: v.astype(np.float64) for k, v in self.w.items()}
        # in double precision and rounded, so that equal texts get equal scores whatever shares their step
        return np.round(exact.forward(x.astype(np.float64), of, len(texts))["p"], 9)


def fit(rows: list[tuple[str, int]], *, epochs: int = 14, bag: int = 48, rate: float = 0.01, decay: float = 1e-4, seed: int = 0) -> GatedAttention:
    """Adam on the log-loss of documents."""
    model = GatedAttention(seed)
    y = np.array([v for _, v in rows], np.float32)
    if not len(y) or y.min() == y.max():
        model.only = float(y[0]) if len(y) else 0.0
        return model
    rng = np.random.RandomState(seed)
    model.w["out_b"][0] = np.log(y.mean() / (1 - y.mean()))
    bags = Bags([t for t, _ in rows])
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), bag):
            own = order[at : at + bag]
            x, of = bags.laid(own)
            f = model.forward(x, of, len(own))
            step += 1
            now = rate * (1 - epoch / epochs)
            for k, g in model.gradients(x, of, y[own], f).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                model.w[k] -= (now * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32) + now * decay * model.w[k]
    return model


def fit_on(docs: DataFrame, labels: DataFrame, training: Column, *, label: str = "quality", per_class: int = 1500, max_chars: int = 20_000) -> GatedAttention:
    caps = {0: per_class, 1: 2 * per_class}
    counts = class_counts(labels, label, training)
    model = fit(labelled_sample(docs, labels, label, training, counts, caps, max_chars=max_chars))
    if model.only is None:
        model.w["out_b"] += np.float32(class_shift(counts, caps))
    return model


def score(df: DataFrame, model: GatedAttention, *, text_col: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 up); columns with these names are replaced."""
    kept = [c for c in df.columns if c not in ("score", "predicted")]
    held = df.sparkSession.sparkContext.broadcast(model)
    schema = df.select(kept).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch, texts in steps(batches, text_col, STEP):
            p = np.clip(own.score(texts), 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return df.select(kept).mapInArrow(run, schema)
