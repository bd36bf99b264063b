"""Centroids, license scans and token alignment against brute force, with the awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from terraledger.llm import alignment, centroids, licenses
from terraledger.llm.queries import ORACLE, QUERIES
from tests.llm.test_llm import LONG, ROWS, awkward

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- 11 centroids ------------------------------------------------------------
def plain_clusters(rows, k, rounds, seed, dims):
    """All distances in Python's whole numbers."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, of, strict=True) if c == j]
            if own:
                centres[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    of = assign()
    inertia = Counter()
    for d, c in of:
        inertia[c] += d
    return sorted(
        ((i is None, i or 0, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, of, strict=True)),
    )


def test_centroids_match_all_distances(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss((i % 7) / 4, 0.3) for _ in range(12)]) for i in range(300)]
    rows += [(7, rows[7][1]), (900, rows[8][1]), (None, rows[9][1]), (901, None), (902, []), (903, [1.0] * 11), (904, [None] + [1.0] * 11), (905, [float("nan")] * 12), (906, [float("inf")] * 12), (907, [-0.001] * 12), (908, [0.0] * 12)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, distance int, id string").repartition(5)
    got = centroids.cluster(df, k=9, rounds=3, dims=12)
    want = plain_clusters(rows, 9, 3, 2, 12)
    assert sorted((r.id is None, r.id or 0, *r[1:]) for r in got.collect()) == want
    few = [rows[0], rows[1], rows[1], rows[303]]
    got = centroids.cluster(spark.createDataFrame(few, "vec_id long, embedding array<float>"), k=9, rounds=2, dims=12)
    assert sorted((r.id is None, r.id or 0, *r[1:]) for r in got.collect()) == plain_clusters(few, 9, 2, 2, 12)
    none = centroids.cluster(df.limit(0), k=3, dims=12)
    assert none.count() == 0 and none.columns == got.columns
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [2e9] * 12)], "vec_id long, embedding array<float>"), k=3, dims=12)


def test_partial_distances_abandon_nothing_near():
    rng = np.random.RandomState(0)
    x, c = rng.randint(-9, 9, (400, 20)), rng.randint(-9, 9, (30, 20))
    c[7], c[21] = c[3], c[3]
    full = ((x[:, None] - c) ** 2).sum(2)
    of, best = centroids.nearest(x, c, np.argsort(-x.var(0)))
    assert (of == full.argmin(1)).all() and (best == full.min(1)).all()


# --- 12 licenses -------------------------------------------------------------
def plain_scan(rows, phrases, templates, threshold):
    rules = [(label, t.split(), 1.0) for label, t in phrases] + [(label, t.split(), threshold) for label, t in templates]
    span = max(len(w) for _, w, _ in rules)
    out = []
    for i, text in rows:
        words = re.findall(licenses.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        places = [(p, label) for label, w, _ in rules[: len(phrases)] for p in range(len(words)) if words[p : p + len(w)] == w]
        met = set()
        for b in range(0, len(words) // span + 1):
            held = set(words[b * span : (b + 2) * span])
            for label, w, share in rules[len(phrases) :]:
                if len(held & set(w)) >= share * len(set(w)) - 1e-9:
                    met.add((b, label, len(held & set(w)), len(set(w))))
        at = [p for p, _ in places]
        base = {x for _, x in places}
        score = max([1.0 if base else 0.0, *[c / n for _, _, c, n in met]])
        out.append((i is None, i or 0, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | {m[1] for m in met})), score, sorted(met)))
    return sorted(out, key=repr)


def scanned(df, **kw):
    return sorted(((r.id is None, r.id or 0, *r[1:8], sorted(map(tuple, r.matches))) for r in licenses.scan(df, **kw).collect()), key=repr)


def test_licenses_match_every_block(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        *ROWS, (20, "Released under the MIT License."), (21, "under\nthe (MIT)\tlicense under the mit license"), (22, f"{'the mit license under ' * 30}"), (23, gpl), (23, gpl),
        (24, gpl.replace("work", "software")), (25, gpl.replace("work is licensed", "")), (26, "x " * 40 + gpl + " y" * 50 + " Apache License, Version 2.0 CC BY-NC 4.0"), (27, "ünder the mit license"),
        (28, "Key cc by nc"), (29, "Licensed under CC BY-NC 4.0."), (30, LONG + " " + gpl + " " + LONG + " cc by nc"), (31, "license"), (32, "licensed licensed apache license version 2"),
        (33, "a x b x c x d"), (34, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ]
    df = awkward(spark, rows)
    assert scanned(df) == plain_scan(rows, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD)
    own = {"phrases": [("p", "x a"), ("p", "a b"), ("q", "b")], "templates": [("t", "a b c d a"), ("u", "d c x"), ("v", "a")], "threshold": 0.6}
    rng = random.Random(2)
    made = [(i, " ".join(rng.choice("abcdxyz,") for _ in range(rng.randint(0, 40)))) for i in range(200)]
    assert scanned(awkward(spark, made), **own) == plain_scan(made, own["phrases"], own["templates"], 0.6)
    assert licenses.scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no phrase"):
        licenses.scan(df, phrases=[], templates=[])


# --- 13 alignment ------------------------------------------------------------
def plain_links(rows):
    """The two libraries, byte offsets in sets, and counts in dictionaries."""
    import sentencepiece
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = __import__("terraledger.llm.bpe", fromlist=["x"]).byte_alphabet()
    of_a = {i: bytes(alphabet[c] for c in t) for t, i in lib.get_vocab(with_added_tokens=False).items() if all(c in alphabet for c in t)}
    docs, held = [], Counter()
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(x) else p.replace("▁", " ").encode() for x in b for p in [sp.id_to_piece(x)]]
        if b"".join(of_a[x] for x in a) != raw or b"".join(bytes_b) != raw:
            a, b, bytes_b = [], [], []
        ends_a, ends_b = np.cumsum([len(of_a[x]) for x in a]), np.cumsum([len(x) for x in bytes_b])
        groups, lo_a, lo_b = [], 0, 0
        for e in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            hi_a, hi_b = np.searchsorted(ends_a, e, "right"), np.searchsorted(ends_b, e, "right")
            groups.append((a[lo_a:hi_a], b[lo_b:hi_b]))
            lo_a, lo_b = hi_a, hi_b
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        held.update(links.keys())
        docs.append((i, a, b, groups, links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for i, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        best = sum(m for (x, y), m in links.items() if held[x, y] == most[x])
        out.append((i is None, i or 0, len(a), len(b), len(groups), sum(links.values()), best, sum(m * held[p] for p, m in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out)


def linked(df, **kw):
    return sorted((r.id is None, r.id or 0, *r[1:]) for r in alignment.linked(df, A, B, **kw).collect())


def test_alignment_matches_the_libraries(spark):
    rows = [
        *ROWS, (40, " lead"), (41, "trail "), (42, "two  spaces \n\n and\n \nlines"), (43, "\n"), (44, " "), (45, "a\tb\t c\r\nd"), (46, "a▁b"), (47, "<s>x</s> <|endoftext|><unk>"), (48, "𝒳é漢字" * 30),
        (49, "=" * 3000 + "漢" * 100), (50, " x 　y z"), (51, "\x1c \x1d a"), (52, "x\x00y \n\x00"), (53, "\nfoo \nbar"), (54, "é ́"),
    ]
    df = awkward(spark, rows)
    want = plain_links(rows)
    assert linked(df) == want
    assert linked(df, most_broadcast=40) == want
    assert alignment.linked(df.limit(0), A, B).count() == 0


def test_alignment_of_random_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab 1'st\n\té漢▁<s>  😀-aaaa \0") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [" ".join(rng.choice(["the", "Öl", "naïve.", "x\n", "\ny", "", "12,5", "ü" * 40]) for _ in range(30)) for _ in range(100)]
    own = alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read(), known=100)
    got = []
    for lo in range(0, 500, 50):
        x = alignment.align(own, texts[lo : lo + 50])
        got += list(zip(x["n_a"].tolist(), x["n_b"].tolist(), x["n_groups"].tolist(), x["n_links"].tolist(), x["digests"], strict=True))
    want = plain_links(list(enumerate(texts)))
    assert got == [(*r[2:6], r[8]) for r in sorted(want, key=lambda r: r[1])]


@pytest.mark.parametrize("name", ["op11_partial_distance", "op12_license_join"])
def test_sql_gives_the_same_rows(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, folder).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    rows = lambda d: sorted(d[columns].astype(object).where(d[columns].notna(), None).itertuples(index=False, name=None), key=repr)
    assert rows(got) == rows(want)
