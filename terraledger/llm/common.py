"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text bytes that one step inside a task works on; a longer text is one step of its own.
STEP_BYTES = 4 << 20


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus) == F.lit(remainder)


def by_size(batch: pa.RecordBatch, texts: list[str | None], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` characters each."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts) or not texts:
        yield start, len(texts)


def steps(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Arrow batches cut into steps, each with the whole texts of its rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        texts = batch.column(at).to_pylist()
        for start, end in by_size(batch, texts, limit):
            yield batch.slice(start, end - start), texts[start:end]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_R = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        inverse = np.uint64(pow(int(_R), -1, 1 << 64))
        made = []
        for base in (_R, inverse):
            a = np.full(n + n // 4, base, np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        _POWERS, _INVERSES = made
    return _POWERS[:n], _INVERSES[:n]


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words (runs of bytes above 32) of whole texts: ``(hash, text, length in bytes, last byte)``."""
    raw = [(t or "").encode() for t in texts]
    a = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends = np.cumsum(np.array([len(r) + 1 for r in raw], np.int64))
    edge = np.diff(np.r_[False, a > 32, False].view(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(a))
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(a.astype(np.uint64) * power, out=sums[1:])
    h = mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
    return h, np.searchsorted(ends, start, "right"), stop - start, a[stop - 1]
