"""Byte-level BPE encoding and decoding with a pair occurrence index.

The vocabulary and merge ranks come from a ``tokenizers`` JSON file, whose place
is a parameter.  Spark deals out the rows; inside a task the distinct pre-tokens
that are not yet known are laid end to end, an index maps each mergeable pair to
all its positions in that sequence, and the active ranks are applied in
ascending order, each to all its positions at once, updating the position lists
of the neighbouring pairs.

Defined cases: a null text counts as empty and gives no ids; the empty text gives
no ids; repeated rows give equal results; every input column may be present, only
``doc_id`` and ``text`` (names are parameters) are read.  Texts are never cut.
Special tokens in a text are matched first, longest first, as the library does
(``match_specials=False`` reads them as ordinary text).
"""

from __future__ import annotations

import gc
import heapq
import json
from collections.abc import Iterator
from hashlib import sha256
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraledger.llm.common import steps

#: Fixed value: the split pattern of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a task keeps of what it has encoded before; a full store is emptied, which changes no result.
KNOWN = 400_000
#: Characters encoded at once; a longer text is one step of its own.
STEP = 12 << 20
#: Marks of units: at the start of a text, after a line feed; what stands for the ids of a unit that needs its neighbours.
START, FEED, ALONE = "\0", "\n", "alone"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte, as byte-level vocabularies spell them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in stand_in):
        stand_in[b] = chr(256 + k)
    return {c: b for b, c in stand_in.items()}


def _leftmost(p: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of ascending positions of a pair of equal symbols, those that a scan from the left merges."""
    taken, last = [], -1
    for at in p.tolist():
        if at != last:
            taken.append(at)
            last = int(after[at])
    return np.array(taken, np.int64)


class PairIndexBpe:
    """Merge ranks, and the two directions between texts and ids."""

    def __init__(self, spec: str, match_specials: bool = True, known: int = KNOWN):
        model = json.loads(spec)
        vocab, byte_of = model["model"]["vocab"], byte_alphabet()
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        first = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1:
                first[byte_of[token]] = i
        self.shift = max(self.bytes_of).bit_length()
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << self.shift | vocab[b], (rank, vocab[a + b]))
        self.specials = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        for content, i in self.specials.items():
            self.bytes_of[i] = content.encode()
        names = sorted(self.specials, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names and match_specials else None
        self.split = regex.compile(SPLIT)
        self.bytes_of_text = {str(i): b for i, b in self.bytes_of.items()}
        self.known = known
        self.units: dict[str, str] = {}
        self.first_ids = np.array(first, np.int64)
        self.feed = str(first[10])
        self.words: dict[str, str] = {}

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, by one occurrence index over all of them.

        ``places`` maps a pair to all its positions.  The active ranks are taken
        in ascending order from a heap; one rank is applied to all its positions,
        and the pairs that arise beside them go to their own lists.
        """
        shift, merges, mask = self.shift, self.merges, (1 << self.shift) - 1
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        symbols = self.first_ids[raw]
        symbols[ends] = -1
        n = len(symbols)
        after, before, fresh = np.arange(1, n + 1), np.arange(-1, n - 1), np.zeros(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        active: list[tuple[int, int]] = []

        def index(keys: np.ndarray, at: np.ndarray) -> None:
            order = np.argsort(keys, kind="stable")
            keys, at = keys[order], at[order]
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts = [0, *cuts.tolist(), len(keys)]
            for key, lo, hi in zip(keys[starts[:-1]].tolist(), starts, starts[1:], strict=False):
                if key in merges:
                    if key in places:
                        places[key].append(at[lo:hi])
                    else:
                        places[key] = [at[lo:hi]]
                        heapq.heappush(active, (merges[key][0], key))

        if n > 1:
            at = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
            if len(at):
                index(symbols[at] << shift | symbols[at + 1], at)
        while active:
            _, key = heapq.heappop(active)
            found = places.pop(key)
            left, right, made = key >> shift, key & mask, merges[key][1]
            p = found[0] if len(found) == 1 else np.concatenate(found)
            p = p[(symbols[p] == left) & (symbols[after[p]] == right)]
            if left == right and len(p) > 1:
                p = _leftmost(np.unique(p), after)
            if not len(p):
                continue
            q = after[p]
            r = after[q]
            symbols[p], symbols[q], after[p], before[r] = made, -2, r, p
            s, o = symbols[r], before[p]
            fresh[p] = True
            sides = s >= 0
            keys, at = made << shift | s[sides], p[sides]
            o = o[o >= 0]
            o = o[(symbols[o] >= 0) & ~fresh[o]]
            fresh[p] = False
            if len(o):
                keys, at = np.concatenate([keys, symbols[o] << shift | made]), np.concatenate([at, o])
            if len(keys):
                index(keys, at)
        kept = symbols[symbols != -2]
        stops = np.flatnonzero(kept == -1).tolist()
        ids = kept.tolist()
        return [ids[lo:hi] for lo, hi in zip([0, *[x + 1 for x in stops[:-1]]], stops, strict=False)]

    def _pieces(self, unit: str) -> tuple[str, list[str]] | None:
        """What stands before a unit's first id, and its pre-tokens; None if the unit can't be encoded by itself."""
        before, core = "", unit
        if unit[:1] == FEED:
            before, core = self.feed, unit[1:]
        elif unit[:1] == START:
            core = unit[1:]
        if not core or core[0].isspace() or core[-1].isspace():
            return None
        spaced = core if unit[:1] in (FEED, START) else " " + core
        if core.isalpha():
            return before, [spaced]
        if core[-1] in ",." and core[:-1].isalpha():
            return before, [spaced[:-1], core[-1]]
        return before, self.split.findall(spaced)

    def _learn(self, units: set[str]) -> None:
        """Encode the units not met before; those that can't stand alone are marked for the whole-text path."""
        words, cut = self.words, {u: self._pieces(u) for u in units}
        self._learn_words({w: None for got in cut.values() if got for w in got[1] if w not in words})
        for unit, got in cut.items():
            if got is None:
                self.units[unit] = ALONE
            else:
                ids = ",".join([words[w] for w in got[1]]) if len(got[1]) != 1 else words[got[1][0]]
                self.units[unit] = f"{got[0]},{ids}" if got[0] else ids

    def _learn_words(self, new: dict[str, None]) -> None:
        if new:
            fresh = list(new)
            for word, ids in zip(fresh, self.merge_all([w.encode() for w in fresh]), strict=True):
                self.words[word] = ",".join(map(str, ids))

    def _whole(self, text: str) -> str:
        got = self.split.findall(text)
        self._learn_words({w: None for w in got if w not in self.words})
        return ",".join([self.words[w] for w in got])

    def encode(self, texts: list[str]) -> list[str]:
        """For each text its decimal ids joined by commas.

        A boundary between a non-space and one space or line feed that another
        non-space follows is always a boundary of the split pattern, so texts
        fall into units that can be encoded once; other texts go whole.  A unit
        is a word that one space precedes; a leading mark tells those after a
        line feed and at the start of a text.
        """
        if len(self.words) > self.known or len(self.units) > self.known:
            self.words.clear()
            self.units.clear()
        missing: set[str] = set()
        met = self.units.__contains__
        for text in texts:
            for part in self._parts(text):
                if part not in self.specials:
                    missing.update(filterfalse(met, self._units(part)))
        if missing:
            self._learn(missing)
        get, out = self.units.get, []
        for text in texts:
            ids = []
            for part in self._parts(text):
                if part in self.specials and self.special_split is not None:
                    ids.append(str(self.specials[part]))
                    continue
                got = list(map(get, self._units(part)))
                ids.append(self._whole(part) if START in part or ALONE in got or None in got else ",".join(got))
            out.append(",".join(ids))
        return out

    def _parts(self, text: str) -> list[str]:
        if self.special_split is None or not any(s in text for s in self.specials):
            return [text] if text else []
        return [p for p in self.special_split.split(text) if p]

    @staticmethod
    def _units(part: str) -> list[str]:
        return (START + part).replace(FEED, " " + FEED).split(" ")

    def decode(self, ids: str) -> str:
        """The text of decimal ids joined by commas."""
        if not ids:
            return ""
        return b"".join(map(self.bytes_of_text.__getitem__, ids.split(","))).decode("utf-8", errors="replace")


def encode_decode(df: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", match_specials: bool = True, keep_ids: bool = True) -> DataFrame:
    """Rows ``(id, ids, n_tokens, decoded, ids_sha256, decoded_sha256)`` of whole texts.

    The tokenizer's file (a few MB, of fixed size) is broadcast once; texts are
    neither shuffled nor collected, so a lost executor costs its own tasks only.
    ``keep_ids=False`` leaves out the ids and the decoded text.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec, match_specials)
        gc.disable()  # millions of strings and no cycles: the collector would only walk them
        try:
            for batch, texts in steps(batches, limit=STEP):
                ids = bpe.encode([t or "" for t in texts])
                decoded = [bpe.decode(x) for x in ids]
                columns = [
                    batch.column(0),
                    pa.array([x.count(",") + 1 if x else 0 for x in ids], pa.int64()),
                    pa.array([sha256(x.encode()).hexdigest() for x in ids], pa.string()),
                    pa.array([sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                ]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns += [pa.array([[int(i) for i in x.split(",")] if x else [] for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            gc.enable()

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


_HELD: dict[tuple, PairIndexBpe] = {}


def _loaded(spec, match_specials: bool) -> PairIndexBpe:
    """One model a worker process: it outlives its task, as the store of encoded units does."""
    key = (spec.id if hasattr(spec, "id") else id(spec), match_specials)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = PairIndexBpe(spec.value, match_specials)
    return _HELD[key]
