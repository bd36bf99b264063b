"""Every training-data operator against brute force, a round trip or held-out accuracy, with the awkward rows."""

import hashlib
import json
import math
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, score double, bands int"
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
ROWS = [
    (1, None), (2, ""), (3, "one"), (4, "two words"), (5, "the quick brown fox jumps over the lazy dog again and again"), (6, "the quick brown fox jumps over the lazy dog again and again"),
    (7, LONG), (8, LONG + " tail"), (9, "\n\t  \n"), (10, "é漢字 😀 <|endoftext|> it's  x\x00y"), (11, ""), (3, "one"), (None, "no id here at all ok"), (12, "a" * 5000),
]


def awkward(spark, rows=ROWS):
    """Rows with nulls, repeats, long texts, and columns whose names clash with what operators add."""
    return spark.createDataFrame([(i, t, None, None if k % 4 == 0 else f"s{k % 3}", 0.5, k) for k, (i, t) in enumerate(rows)], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# --- 1 BPE -----------------------------------------------------------------
def test_bpe_matches_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from terraledger.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    df = awkward(spark)
    got = sorted((r.id is None, r.id or 0, tuple(r.ids), r.decoded, r.n_tokens) for r in bpe.encode_decode(df, path).collect())
    want = []
    for i, t in ROWS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i is None, i or 0, tuple(ids), lib.decode(ids, skip_special_tokens=False), len(ids)))
    assert got == sorted(want)
    assert bpe.encode_decode(df.limit(0), path).count() == 0


def test_bpe_random_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    from terraledger.llm.bpe import PairIndexBpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, own = Tokenizer.from_file(path), PairIndexBpe(open(path, encoding="utf-8").read(), known=50)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab 1'st\n\té漢<|endoftext|>  😀-aaaa") for _ in range(rng.randint(0, 50))) for _ in range(500)]
    ids = own.encode(texts)
    for t, x in zip(texts, ids, strict=True):
        want = lib.encode(t, add_special_tokens=False).ids
        assert x == ",".join(map(str, want)) and own.decode(x) == t


# --- 2 toxicity, 10 quality -------------------------------------------------
def synthetic(n=400, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["er", "th", "on", "an", "re", "he", "in"]) for _ in range(rng.randint(1, 4))) for _ in range(600)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(40, 120))]
        toxic, poor = i % 3 == 0, i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["grumblefuss", "nincompoop", "dunderhead"])
        if poor:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), int(toxic), int(not poor)))
    return rows


def quality_scores(df, docs, labels):
    from terraledger.llm import quality

    return quality.score(df, quality.fit_on(docs, labels, F.lit(True), label="toxic"))


def test_toxicity_learns_and_defines_all_cases(spark):
    from terraledger.llm import toxicity
    from terraledger.llm.common import held_out

    rows = synthetic()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x, _ in rows] + [(9999, None)], "doc_id long, toxic int")
    model = toxicity.fit_on(docs, labels, ~held_out(F.col("_id"), 5, 0))
    truth = {i: x for i, _, x, _ in rows}
    out = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(out[i] == truth[i] for i in out) / len(out) > 0.85
    df = awkward(spark)
    scored = toxicity.score(df, model)
    assert set(scored.columns) == set(df.columns) | {"predicted"} and scored.count() == len(ROWS)
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(df.limit(0), model).count() == 0
    nothing = toxicity.fit([], [])
    assert {r.score for r in toxicity.score(df, nothing).collect()} == {0.0}
    for again in (scored, quality_scores(df, docs, labels)):
        same = {}
        for r in again.select("text", "score").collect():
            same.setdefault(r.text or "", set()).add(r.score)
        assert all(len(x) == 1 for x in same.values())
    assert toxicity.fit(["bad"], []).prior == 1.0


def test_toxicity_is_caught_in_every_language():
    import duckdb

    from terraledger.llm import toxicity

    folder = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT doc_id, text, lang, toxic FROM '{folder}/labels.parquet' JOIN '{folder}/documents.parquet' USING (doc_id) WHERE toxic IS NOT NULL ORDER BY doc_id").fetchall()
    held = [zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows]
    train = [r for r, h in zip(rows, held, strict=True) if not h and len(r[1] or "") <= 20_000]
    test = [r for r, h in zip(rows, held, strict=True) if h]
    model = toxicity.fit([r[1] for r in train if r[3]], [r[1] for r in train if not r[3]])
    score = model.score([r[1] for r in test], model.compressors())
    assert (model.score([r[1] for r in test[:50]], model.compressors(), {}) == score[:50]).all()  # what shares a step changes nothing
    caught = np.array([p >= 0.5 for p in score])
    toxic, lang = np.array([r[3] for r in test]), np.array([r[2] for r in test])
    assert caught[toxic == 1].mean() >= 0.9 and caught[toxic == 0].mean() <= 0.03
    for own in ("en", "de", "fr", "es"):
        assert caught[(toxic == 1) & (lang == own)].mean() >= 0.8, own


def test_quality_learns_and_defines_all_cases(spark):
    from terraledger.llm import quality
    from terraledger.llm.common import held_out

    rows = synthetic(seed=1)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows], "doc_id long, quality int")
    model = quality.fit_on(docs, labels, ~held_out(F.col("_id"), 3, 1))
    truth = {i: q for i, _, _, q in rows}
    out = {r.doc_id: r.predicted for r in quality.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(out[i] == truth[i] for i in out) / len(out) > 0.95
    df = awkward(spark)
    out = quality.score(df, model)
    assert set(out.columns) == set(df.columns) | {"predicted"} and out.where("score between 0 and 1").count() == len(ROWS)
    assert quality.score(df.limit(0), model).count() == 0
    assert quality.fit([("x", 1)]).only == 1.0


def test_caps_do_not_move_the_class_shares(spark):
    from terraledger.llm import quality, toxicity

    # nothing in the texts tells the classes apart: scores are the share of class 1 among all labels
    rng = random.Random(3)
    plain = ["er", "on", "the", "any", "in", "re", "word"]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(40)), int(i % 10 == 0), int(i % 10 != 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x, q) for i, _, x, q in rows], "doc_id long, toxic int, quality int")
    for module, share in ((toxicity, 0.1), (quality, 0.9)):
        model = module.fit_on(docs, labels, F.lit(True), per_class=40)
        mean = module.score(docs, model).agg(F.avg("score")).first()[0]
        assert abs(mean - share) < 0.1, (module.__name__, mean)


def test_attention_gradients():
    from terraledger.llm.quality import GatedAttention, encode_passages

    model = GatedAttention(1)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, of = encode_passages([LONG[:2000], "short text", ""])
    x = x.astype(np.float64)
    y = np.array([1.0, 0.0, 1.0])
    loss = lambda: -(y * np.log((p := model.forward(x, of, 3)["p"])) + (1 - y) * np.log(1 - p)).mean()
    grads = model.gradients(x, of, y, model.forward(x, of, 3))
    for k in model.w:
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        model.w[k][at] += 1e-6
        up = loss()
        model.w[k][at] -= 2e-6
        down = loss()
        model.w[k][at] += 1e-6
        assert (up - down) / 2e-6 == pytest.approx(grads[k][at], rel=1e-3, abs=1e-8)


# --- 3 MinHash ---------------------------------------------------------------
def brute_classes(rows, similarity=0.8):
    """By comparing all pairs."""
    cut = [None if t is None else t.split() for _, t in rows]
    sets = [None if w is None else frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset() for w in cut]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] is None or sets[j] is None or rows[i][0] is None or rows[j][0] is None:
                continue
            same = rows[i][1] == rows[j][1]
            if same or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, low[find(i)]) for i, (d, _) in enumerate(rows) if d is not None)


def test_minhash_matches_brute_force(spark):
    from terraledger.llm import minhash

    rng = random.Random(5)
    rows = list(ROWS)
    base = [f"word{rng.randrange(400)}" for _ in range(120)]
    for i in range(100, 160):  # a group of near copies of each other, and strangers
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i, " ".join(words)))
        rows.append((i + 100, " ".join(f"x{rng.randrange(9999)}" for _ in range(60))))
    for i in range(300, 340):  # and some that link with few of them
        words = list(base)
        for _ in range(2 + i % 6):
            words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(awkward(spark, rows))
    assert sorted((r.doc_id, r.class_id) for r in got.collect() if r.doc_id is not None) == brute_classes(rows)
    for weighting in ("set", "count"):  # no repeated shingle in the group, so the classes are the same
        crowded = minhash.near_duplicates(awkward(spark, rows), small=2, weighting=weighting)
        assert sorted((r.doc_id, r.class_id) for r in crowded.collect() if r.doc_id is not None) == brute_classes(rows)
    assert minhash.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    from terraledger.llm.common import mix
    from terraledger.llm.minhash import dart_signatures

    rng = np.random.RandomState(0)
    errors = []
    for _ in range(25):
        h = np.sort(mix(rng.randint(0, 2**62, 150).astype(np.uint64)))
        a = rng.randint(1, 9, 150) + 0.5
        b = np.where(rng.rand(150) < 0.3, rng.randint(1, 9, 150) + 0.25, a)
        s = dart_signatures(np.r_[h, h], np.repeat([0, 1], 150), np.r_[a, b], 2, 100)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1


# --- 4 AVI --------------------------------------------------------------------
def test_avi_round_trip(spark):
    from terraledger.llm import avi

    rng = np.random.RandomState(0)
    frames = rng.randint(0, 256, (20, avi.SIDE, avi.SIDE)).astype(np.uint8)
    assert (avi.decode_frames(avi.encode_frames(frames)) == frames).all()
    out = {(r.id, r.n_bytes): r for r in avi.stored(awkward(spark)).collect()}
    for i, t in ROWS:
        raw = (t or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 576)) * 576, b"\xff")
        r = out[(i, len(raw))]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.media_sha256 == hashlib.sha256(bytes(r.media)).hexdigest() and bytes(r.media[:4]) == b"RIFF"
    clips = avi.clips(avi.stored(awkward(spark)))
    assert clips.groupBy("id").agg(F.sum("n_frames").alias("n")).where("id = 7").first().n == -(-len(LONG) // 576)
    with pytest.raises(ValueError):
        avi.read_avi(b"nothing")


def test_avi_finds_a_cut():
    from terraledger.llm import avi

    rng = np.random.RandomState(1)
    frames = np.concatenate([rng.randint(0, 60, (12, 24, 24)), rng.randint(150, 250, (12, 24, 24))]).astype(np.uint8)
    start, _ = avi.shot_starts(frames, np.zeros(24, int))
    assert np.flatnonzero(start).tolist() == [0, 12]
    alone, _ = avi.shot_starts(np.concatenate([frames[:5], frames]), np.r_[np.zeros(5, int), np.ones(24, int)])
    assert (alone[5:] == start).all()


# --- 5 packing ------------------------------------------------------------------
def brute_place(pieces, capacity, quota):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for size, cluster, source in pieces:
        fit = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= size and (cluster is None or cluster not in b["clusters"]) and b["sources"].count(source) < quota[source]]
        if fit:
            k = min(fit)[1]
        else:
            bins.append({"left": capacity, "clusters": set(), "sources": []})
            k = len(bins) - 1
        bins[k]["left"] -= size
        bins[k]["clusters"].add(cluster)
        bins[k]["sources"].append(source)
        out.append((bins[k]["left"], size))
    return out, len(bins)


def test_packing_is_best_fit():
    from terraledger.llm.packing import pack_group

    rng = random.Random(2)
    rows = sorted(((rng.randint(1, 99), rng.randrange(12) if rng.random() < 0.4 else None, f"s{rng.choice([0, 0, 0, 1, 2])}") for _ in range(300)), key=lambda r: -r[0])
    quota = {"s0": 5, "s1": 2, "s2": 2}
    frame = pd.DataFrame([{"size": n, "cluster": 1000 + k if c is None else c, "source": s, "quota": quota[s]} for k, (n, c, s) in enumerate(rows)])
    bins = pack_group(frame, 100)
    left, got = {}, []
    for b, (n, _, _) in zip(bins, rows, strict=True):
        left[b] = left.get(b, 100) - n
        got.append((left[b], n))
    want, n_bins = brute_place(rows, 100, quota)
    assert got == want and len(left) == n_bins


def test_packing_keeps_every_byte(spark):
    from terraledger.llm import packing

    out = packing.pack(awkward(spark), capacity=1000)
    want = sum(max(1, len((t or "").encode())) for _, t in ROWS)
    assert out.agg(F.sum("size")).first()[0] == want
    assert out.groupBy("bin_id").agg(F.sum("size").alias("s")).where("s > 1000").count() == 0
    assert out.groupBy("bin_id", "cluster").count().where("count > 1").count() == 0
    assert packing.pack(awkward(spark).limit(0)).count() == 0


# --- 6 masked LM ------------------------------------------------------------------
def test_masked_lm_prefers_the_corpus_order(spark):
    from terraledger.llm import masked_lm

    rng = random.Random(0)
    cycle = [f"t{k}" for k in range(12)]
    rows = [(i, " ".join(cycle[(i + k) % 12] for k in range(200))) for i in range(60)]
    shuffled = rows[0][1].split()
    rng.shuffle(shuffled)
    docs = spark.createDataFrame([*rows, (1000, " ".join(shuffled)), (1001, None), (1002, ""), (0, rows[0][1])], "doc_id long, text string")
    out = {}
    for r in masked_lm.pseudo_likelihood(docs).collect():
        out.setdefault(r.id, []).append(r)
    assert out[0][0].mean_log_probability > out[1000][0].mean_log_probability + 0.5
    assert out[0][0].log_likelihood == out[0][1].log_likelihood
    assert out[1001][0].n_tokens == 0 and out[1002][0].log_likelihood == 0
    assert masked_lm.pseudo_likelihood(docs.limit(0)).count() == 0


def test_masked_lm_tells_rare_words_apart_by_their_counts(spark):
    from terraledger.llm import masked_lm

    rows = [(i, "a b c a b c") for i in range(40)] + [(100 + i, f"a b c {'xxxxq' if i else 'yyyyq'} a b c") for i in range(31)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.id: r for r in masked_lm.pseudo_likelihood(docs, vocabulary=3).collect()}
    assert len(out) == len(rows)
    # same length, last byte and context: only the words' shares of their class differ
    assert out[101].log_likelihood - out[100].log_likelihood == pytest.approx(np.log(30))
    # the vocabulary follows the corpus
    counts = lambda n: spark.createDataFrame([(1, masked_lm.KNOWN_CLASSES, n)], "word long, rare_class int, n long")
    assert masked_lm.lexicon(counts(10**11)).slot_bits > masked_lm.lexicon(counts(10**6)).slot_bits


def test_masked_lm_matches_brute_force_in_any_layout(spark):
    from terraledger.llm import masked_lm as m
    from terraledger.llm.common import words

    rng = random.Random(1)
    texts = [None, "", "alone", "two words"] + [" ".join(rng.choice(["a", "bb", "ccc", "dddd", f"x{rng.randrange(60)}"]) for _ in range(rng.randint(1, 40))) for _ in range(60)] + [" ".join(f"w{k % 977}" for k in range(60_000))]
    rows = [(k, t, 1.0, "clash") for k, t in enumerate(texts)] + [(3, "two words", 2.0, "clash"), (None, "no id", 0.0, "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, total double, rare string")
    both = [{(r.id, r.n_tokens): (r.log_likelihood, r.mean_log_probability) for r in m.pseudo_likelihood(df.repartition(n), vocabulary=40).collect()} for n in (2, 16)]
    assert both[0] == both[1]
    # the sum over tokens by plain loops, for the same weights
    docs = df.select(F.col("doc_id").alias("id"), "text")
    counts = m.word_counts(docs)
    lex = m.lexicon(counts, 40)
    net = m.train(docs, lex, 1000)
    count = {r.word: r.n for r in counts.collect()}
    known = {int(h): k for k, h in enumerate(lex.hashes)}
    mass, other = {}, {}
    e, w1, b1, w2, b2 = [w.astype(np.float64) for w in net.w]
    kind = lambda h, n, last: lex.class_of[known[h]] if h in known else int(m.other_class(np.array([n]), np.array([last]))[0])
    for t in [*texts, "no id"]:
        for h, n, last in zip(*[x.tolist() for x in np.array(words([t]), object)[[0, 2, 3]]], strict=True):
            (mass if h in known else other).setdefault(kind(h, n, last), {})[h] = count[np.uint64(h).astype(np.int64).item()]
    for k, t in enumerate(texts[:40]):
        h, _, n, last = (x.tolist() for x in words([t]))
        symbol = [known[x] if x in known else len(lex.hashes) + kind(x, a, b) - m.KNOWN_CLASSES for x, a, b in zip(h, n, last, strict=True)]
        want = 0.0
        for i, (x, a, b) in enumerate(zip(h, n, last, strict=True)):
            near = [symbol[j] if 0 <= j < len(h) else lex.size - 1 for j in (i - 2, i - 1, i + 1, i + 2)]
            y = np.tanh(np.concatenate([e[c] for c in near]) @ w1 + b1) @ w2 + b2
            c = kind(x, a, b)
            shares = mass[c] if x in known else other[c]
            want += y[c] - y.max() - math.log(np.exp(y - y.max()).sum()) + math.log(shares[x] / sum(shares.values()))
        got = both[0][(k, len(h))][0]
        assert got == pytest.approx(want, abs=1e-5), (k, t)


def test_window_net_gradients():
    from terraledger.llm import masked_lm as m

    rng = np.random.RandomState(0)
    context, target = rng.randint(0, 30, (8, 4)), rng.randint(0, m.CLASSES, 8)
    loss = lambda n: -np.log(n.forward(context)[2][np.arange(8), target]).mean()
    for k in range(5):
        net = m.WindowNet(30, 1)
        net.w = [w.astype(np.float64) for w in net.w]
        if k:  # with a unit of squared gradients, one step moves weights by the gradient itself
            before, net.square = net.w[k].copy(), [np.ones_like(w) for w in net.w[1:]]
        else:
            before = net.w[0].copy()
        rate = 1e-6
        net.learn(context, target, rate=rate)
        step = (before - net.w[k]) / (rate * (1 if k else 20))
        at = np.unravel_index(np.abs(step).argmax(), step.shape)
        probe = m.WindowNet(30, 1)
        probe.w = [w.astype(np.float64) for w in probe.w]
        probe.w[k][at] += 1e-5
        up = loss(probe)
        probe.w[k][at] -= 2e-5
        slope = (up - loss(probe)) / 2e-5
        assert step[at] * (np.sqrt(1 + slope * slope) if k else 1) == pytest.approx(slope, rel=1e-3)
    net = m.WindowNet(30, 1)
    context, target = rng.randint(0, 30, (400, 4)), rng.randint(0, m.CLASSES, 400)
    before = net.log_probability(context, target).mean()
    for _ in range(60):
        net.learn(context, target)
    assert net.log_probability(context, target).mean() > before + 0.5


# --- 7 NN-descent -------------------------------------------------------------------
def test_nn_descent_matches_brute_force(spark):
    from terraledger.llm import neighbours

    rng = np.random.RandomState(0)
    x = rng.randn(300, 16)
    x[100:160] = x[0] + 0.05 * rng.randn(60, 16)
    x[200] = x[201]
    label = [int(i % 3) if not 100 <= i < 160 else 0 for i in range(300)]
    rows = [(i, [float(v) for v in x[i]], label[i]) for i in range(300)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, rows[0][1], None), (404, [], 1), (405, [None] + [1.0] * 15, 1), (406, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in neighbours.near_duplicates(df).collect()}
    keep = [r for r in rows if r[0] < 300 or r[0] == 406]
    y = np.array([r[1] for r in keep])
    y /= np.linalg.norm(y, axis=1)[:, None]
    same = np.array([r[2] for r in keep])
    near = (y @ y.T >= 0.93) & (same[:, None] == same[None, :])
    np.fill_diagonal(near, False)
    for k, r in enumerate(keep):
        assert got[r[0]].n_links == near[k].sum()
    for i in (400, 401, 402, 403, 404, 405):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[406].component_id == 0 and got[100].recall >= 0.98


def brute_links(rows):
    """Links and components of ``(id, vector, label)`` by comparing all pairs."""
    y = np.array([r[1] for r in rows])
    y /= np.linalg.norm(y, axis=1)[:, None]
    same = np.array([r[2] for r in rows])
    near = (y @ y.T >= 0.93) & (same[:, None] == same[None, :])
    label = np.array([r[0] for r in rows])
    for _ in rows:
        low = np.where(near, label, label.max()).min(1)
        if (low == label).all():
            break
        label = low
    np.fill_diagonal(near, False)
    return {r[0]: (int(near[k].sum()), int(label[k])) for k, r in enumerate(rows)}


def around(rng, center, n, inner):
    """Unit vectors about a center, with cosines of about ``inner`` between them."""
    noise = rng.randn(n, len(center))
    noise -= (noise @ center)[:, None] * center
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return np.sqrt(inner) * center + np.sqrt(1 - inner) * noise


def test_nn_descent_keeps_links_between_dense_groups(spark):
    from terraledger.llm import neighbours

    rng = np.random.RandomState(4)
    x = np.concatenate([around(rng, np.eye(64)[0], 40, 0.98), around(rng, 0.959 * np.eye(64)[0] + np.sqrt(1 - 0.959**2) * np.eye(64)[1], 40, 0.98), rng.randn(800, 64)])
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(len(x))]
    want = brute_links(rows)
    assert {want[i][1] for i in range(80)} == {0} and len({want[i][0] for i in range(80)}) > 1
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == want


def test_nn_descent_finds_lone_pairs_beside_large_groups(spark):
    from terraledger.llm import neighbours as m

    # a pair on the threshold meets as surely in a large table as in a small one
    for n in (1_000, 20_000, 200_000, 20_000_000):
        assert (1 - m.meeting(n, 0.93, m.NEAR)) ** m.tables_for(n, 0.93, m.NEAR, m.MISSED) <= m.MISSED
    rng = np.random.RandomState(6)
    unit = lambda n: (lambda v: v / np.linalg.norm(v, axis=1)[:, None])(rng.randn(n, 64))
    one = unit(300)
    other = np.concatenate([around(rng, v, 1, 0.935**2) for v in one])
    x = np.concatenate([one, other, around(rng, np.eye(64)[0], 300, 0.99)])
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(len(x))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute_links(rows)
    assert sum(n == 1 for n, _ in want.values()) == 600
    # with hardly any start the audit sees the pairs, and the group is compared whole
    got = m.near_duplicates(df, tables=1, rounds=0, most_passes=1, missed=0.9).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and got[0].recall == 1.0


def test_nn_descent_awkward_vectors(spark):
    from terraledger.llm import neighbours

    schema = "vec_id long, embedding array<double>, label int, id string, component_id int"
    far = [(i, [x, x], 0) for i, x in enumerate([1e-200, 1e-160, 1.0, 7.0, 1e200, 3e200], 1)]
    ids = [(11, [1.0, 0.0], 1), (11, [0.0, 1.0], 1), (12, [1.0, 0.0], 1), (13, [0.0, 1.0], 1), (14, [0.0, 1.0], 1), (15, [0.0, 2.0], 2), (15, [0.0, 2.0], 2)]
    edge = math.acos(0.93)  # pairs just inside and just outside of the threshold
    ties = [(20, [1.0, 0.0], 3), (21, [math.cos(edge - 1e-6), math.sin(edge - 1e-6)], 3), (30, [1.0, 0.0], 4), (31, [math.cos(edge + 1e-6), math.sin(edge + 1e-6)], 4), (None, [1.0, 0.0], 3), (40, [0.0, 0.0], None)]
    df = spark.createDataFrame([(*r, "x", 7) for r in far + ids + ties], schema)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in neighbours.near_duplicates(df).collect()), key=str)
    want = [(i, 5, 1) for i in range(1, 7)] + [(11, 1, 11), (11, 2, 11), (12, 1, 11), (13, 2, 11), (14, 2, 11), (15, 1, 15), (15, 1, 15), (20, 1, 20), (21, 1, 20), (30, 0, 30), (31, 0, 31), (None, 0, None), (40, 0, 40)]
    assert got == sorted(want, key=str)
    assert neighbours.near_duplicates(df.limit(0)).count() == 0
    assert neighbours.near_duplicates(df.where("vec_id >= 30")).first().recall is None  # no link to find: nothing measured


# --- 8 chat ---------------------------------------------------------------------------
def test_tool_calls_are_linked_ordered_and_checked(spark):
    from terraledger.llm import chat

    call = lambda *calls: json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})
    rows = [
        (1, 0, "user", "hi \"there\"\n\x01"), (1, 1, "assistant", call(("b", "add", {"x": "$a", "y": 2}), ("a", "add", {"x": 1, "y": 2}))), (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "3"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "b", "content": "5"})), (1, 4, "assistant", call(("c", "add", {"x": 1, "z": 0}), ("d", "nope", {}), ("e", "add", {"x": "$f", "y": 1}), ("f", "add", {"x": "$e", "y": 1}))),
        (1, 5, "tool", json.dumps({"tool_call_id": "zz", "content": "?"})), (2, 0, None, None), (None, 0, "user", "alone"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, status int")
    schemas = {"add": {"x": ("integer", True), "y": ("integer", True)}}
    out = {(r.conv_id, r.id): r for r in chat.formatted(df, schemas=schemas, as_calls=False).collect()}
    assert [out[(1, i)].level for i in "abcd"] == [0, 1, 0, 0]
    assert json.loads(out[(1, "a")].json) == {"arguments": {"x": 1, "y": 2}, "call_turn": 1, "content": "3", "id": "a", "level": 0, "name": "add", "problems": [], "result_turn": 2, "status": "ok"}
    assert json.loads(out[(1, "b")].json)["problems"] == ["type:x"]
    assert json.loads(out[(1, "c")].json)["problems"] == ["missing:y", "unknown:z"]
    assert [out[(1, i)].status for i in ("d", "e", "f", "zz")] == ["unknown_tool", "cyclic", "cyclic", "orphan"]
    plain = chat.formatted(df)
    lines = {(r.conv_id, r.id): json.loads(r.json) for r in plain.collect()}
    assert lines[(1, "t0")]["arguments"]["text"] == "hi \"there\"\n\x01" and lines[(None, "t0")]["status"] == "unanswered"
    assert sorted(r.seq for r in plain.where("conv_id = 1").collect()) == list(range(plain.where("conv_id = 1").count()))
    assert chat.formatted(df.limit(0)).count() == 0


def brute_links_of_calls(rows, schemas):
    """Calls and results of ``(conv, turn, role, text)`` linked by plain loops; JSON values by ``(conv, id, nth)``."""
    calls, results = {}, {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        try:
            got = json.loads(text) if (text or "").lstrip().startswith("{") else None
        except ValueError:
            got = None
        if isinstance(got, dict) and isinstance(got.get("tool_calls"), list):
            for place, c in enumerate(got["tool_calls"]):
                given = c.get("arguments", {})
                if isinstance(given, str):
                    given = json.loads(given) if given.startswith("{") else given
                calls.setdefault((conv, str(c["id"])), []).append((turn, place, c.get("name"), given))
        elif isinstance(got, dict) and role == "tool" and got.get("tool_call_id") is not None:
            results.setdefault((conv, str(got["tool_call_id"])), []).append((turn, got.get("content")))
    kind = lambda v: "null" if v is None else "boolean" if isinstance(v, bool) else "integer" if isinstance(v, int) else "number" if isinstance(v, float) else {str: "string", dict: "object", list: "array"}[type(v)]
    refs = {}

    def strings(v):
        return [v] if isinstance(v, str) else [s for x in (v.values() if isinstance(v, dict) else v) for s in strings(x)] if isinstance(v, (dict, list)) else []

    for (conv, i), own in calls.items():
        for c in own:
            values = strings(c[3]) if isinstance(c[3], dict) else []
            refs.setdefault((conv, i), set()).update((conv, v[1:]) for v in values if v.startswith("$") and (conv, v[1:]) in calls)

    def level(key, seen=()):
        if key in seen:
            return None
        below = [level(k, (*seen, key)) for k in refs[key]]
        return None if None in below else max(below, default=-1) + 1

    out = {}
    for key in calls.keys() | results.keys():
        asked, said = sorted(calls.get(key, []), key=lambda c: c[:2]), sorted(results.get(key, []), key=lambda r: r[0])
        for n in range(max(len(asked), len(said))):
            c, r = asked[n] if n < len(asked) else None, said[n] if n < len(said) else None
            wrong = []
            if c:
                fields = schemas.get(c[2])
                if fields is None:
                    wrong = ["unknown_tool"]
                elif not isinstance(c[3], dict):
                    wrong = ["no_object"]
                else:
                    for f, (k, needed) in sorted(fields.items()):
                        if f not in c[3]:
                            wrong += [f"missing:{f}"] * needed
                        elif kind(c[3][f]) != k and not (k == "number" and kind(c[3][f]) == "integer"):
                            wrong.append(f"type:{f}")
                    wrong += [f"unknown:{f}" for f in sorted(set(c[3]) - set(fields))]
            at = level(key) if c else None
            status = "orphan" if not c else "cyclic" if at is None else "unknown_tool" if wrong == ["unknown_tool"] else "invalid" if wrong else "ok" if r else "unanswered"
            out[(*key, n + 1)] = {"arguments": c[3] if c and isinstance(c[3], dict) else None, "call_turn": c and c[0], "content": r and r[1], "id": key[1], "level": at, "name": c and c[2], "problems": wrong, "result_turn": r and r[0], "status": status}
    return out


def test_tool_calls_match_brute_force(spark):
    from terraledger.llm import chat

    rng = random.Random(8)
    values = [1, "12", "$a", "$b", "$c", 2.5, 10**19, None, True, {"k": [1, "q\"\n", None]}, [], "é\u0001", "", "$nobody", ["x", {"$e": "$d"}], {"deep": {"er": ["$a"]}}, 'no "$b', "\x0b\x1f\\u000B\\\\u001F"]
    schemas = {"add": {"x": ("integer", True), "y": ("number", False)}, "say": {"text": ("string", True), "deep": ("object", False)}, "none": {}}
    rows = []
    for conv in (1, 2, None):
        for turn in range(60):
            if rng.random() < 0.5:
                own = [{"id": rng.choice("abcdefgh"), "name": rng.choice(["add", "say", "none", "other"]), "arguments": {k: rng.choice(values) for k in rng.sample(["x", "y", "text", "deep"], rng.randrange(4))}} for _ in range(rng.randint(1, 3))]
                if rng.random() < 0.2:
                    own[0]["arguments"] = rng.choice([[1], "no", json.dumps({"x": 1})])
                rows.append((conv, turn, "assistant", json.dumps({"tool_calls": own})))
            else:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": rng.choice(["a", "b", "c", "d", 7]), "content": rng.choice(values)})))
    rows += [(1, 100, "tool", '{"tool_call_id": "a"'), (1, 101, "user", '{"tool_calls": "none"}')]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, status int, json string")
    want = brute_links_of_calls(rows, schemas)
    linked = chat.canonical(chat.link(df, schemas=schemas, as_calls=False)).collect()
    assert {(r.conv_id, r.id, r.nth): json.loads(r.json) for r in linked} == want
    assert {v["status"] for v in want.values()} == {"ok", "unanswered", "orphan", "cyclic", "invalid", "unknown_tool"}


def test_values_have_one_spelling(spark):
    from terraledger.llm import chat

    odd = "".join(map(chr, range(32))) + "\x0b" + "\\u000B \\\\u001F \\\\\x1e"
    rows = [(1, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "n", "arguments": {"k": odd, "l": [odd, {odd: 1}]}}]})), (2, 0, "user", odd)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    called, plain = (r.json for r in chat.formatted(df).orderBy("conv_id").collect())
    text = lambda json_: json_[json_.index("text") + 6 :].split(',"turn')[0]
    literal = text(plain)[: text(plain).index('"},')] + '"'
    assert json.loads(literal) == odd and called.count(literal) == 3
    assert json.loads(called)["arguments"] == {"k": odd, "l": [odd, {odd: 1}]}


def test_long_chains_of_calls_have_levels(spark):
    from terraledger.llm import chat

    chain = [{"id": f"c{k}", "name": "n", "arguments": {"on": [f"$c{k - 1}", "$c0"]} if k else {}} for k in range(12)]
    rows = [(c, 0, "assistant", json.dumps({"tool_calls": chain[::-1]})) for c in range(3)]
    out = chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), schemas={"n": {"on": ("array", False)}}, as_calls=False)
    assert {(r.conv_id, r.id): (r.level, r.status) for r in out.collect()} == {(c, f"c{k}"): (k, "unanswered") for c in range(3) for k in range(12)}


def test_derived_tool_calls_match_their_sql(spark):
    import duckdb

    from terraledger.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    want = con.execute(ORACLE["chat_tool_calls"])
    names = [d[0] for d in want.description]
    got = QUERIES["chat_tool_calls"](spark, DATA)
    rows = want.fetchall()
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(rows) and len({r[names.index("status")] for r in rows}) >= 5


def test_plain_chat_is_text_whatever_it_looks_like(spark):
    from terraledger.llm import chat

    texts = ["{oops", "[1, not json", "42", "true", "$t0", '"', "\x00\x01\x1f", '{"a": 1}', "null", '{"tool_calls": 3}', "\\", "", None]
    rows = [(c, t, role, text) for c, text in enumerate(texts) for t, role in enumerate(("user", "assistant"))]
    out = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(out) == len(texts)
    for r in out:
        assert json.loads(r.json) == {"arguments": {"role": "user", "text": texts[r.conv_id] or ""}, "call_turn": 0, "content": texts[r.conv_id] or "", "id": "t0", "level": 0, "name": "respond", "problems": [], "result_turn": 1, "status": "ok"}
    lost = spark.createDataFrame([(None, None, "tool", '{"tool_call_id": null, "content": 1}'), (1, 0, "a", '{"tool_calls": [{"name": "respond"}, {"name": "respond"}]}')], "conv_id long, turn long, role string, text string")
    assert sorted(r.status for r in chat.formatted(lost, as_calls=False).collect()) == ["invalid", "invalid"]


def test_op8_sql_matches(spark):
    import duckdb

    from terraledger.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    want = con.execute(queries.ORACLE["op8_tool_links"])
    names = [d[0] for d in want.description]
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in queries.op8_tool_links(spark, DATA).collect())


# --- 9 sharding --------------------------------------------------------------------------
def test_interleaving_follows_fractional_ranks(spark):
    from terraledger.llm import sharding

    rows = [(i, f"text {i}") for i in range(700)]
    df = awkward(spark, rows + ROWS)
    out = sharding.interleave(df, 24, bucket_rows=32)
    got = out.collect()
    n = len(rows) + len(ROWS)
    size = [0] * 24
    for r in got:
        size[r.shard] += 1
    assert sum(size) == n and max(size) - min(size) <= 1
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(size[s]))
    # the same order by plain sorting, in any bucket width
    key = {(r.doc_id, r.text_crc32): r.k for r in out.select("doc_id", "text_crc32", F.xxhash64(F.lit(17), "doc_id", "text_crc32", (F.col("size") - 8).cast("int")).alias("k")).distinct().collect()}
    flip = lambda k: k if k >= 0 else k + (1 << 64)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    ranked = []
    for source, own in by.items():
        own.sort(key=lambda r: (flip(key[(r.doc_id, r.text_crc32)]), r.text_crc32))
        ranked += [((2 * k + 1) / (2 * len(own)), source or "", r.doc_id, r.text_crc32) for k, r in enumerate(own)]
    ranked.sort(key=lambda x: x[:2])
    place = [(r.doc_id, r.text_crc32) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert place == [(d, c) for _, _, d, c in ranked]
    for source, own in by.items():
        per = [sum(r.shard == s for r in own) for s in range(24)]
        assert max(per) - min(per) <= 2, source
    assert sharding.interleave(df.limit(0), 24).count() == 0


# --- pipeline and registration --------------------------------------------------------------
def test_one_row_of_each_class_stays(spark):
    from terraledger.llm import minhash

    x, y = "one two three four five six seven eight", "other words that nothing else here shares at all"
    near = " ".join(f"n{k}" for k in range(60))
    rows = [(1, x), (5, x), (5, y), (7, "text a of seven"), (7, "text b of seven"), (None, x), (None, "only null"), (None, "only null"), (8, None), (8, None), (9, near), (9, near), (10, near + " more"), (11, ""), (12, "")]
    df = awkward(spark, rows)
    kept = minhash.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, x), (5, y), (7, "text a of seven"), (7, "text b of seven"), (None, "only null"), (8, None), (8, None), (9, near), (11, "")], key=str)
    assert minhash.one_of_each(df.limit(0)).count() == 0


def test_pipeline_matches_brute_force(spark, tmp_path):
    import corpus_pipeline
    from terraledger.llm import quality, toxicity
    from terraledger.llm.common import held_out

    docs = documents(spark).limit(120)
    more = [(900_000, "extra text of its own"), (900_000, "extra text that shares the id"), (None, "without an id"), (900_001, None), (900_002, ""), (900_003, "extra text of its own")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in more], docs.schema)).withColumn("score", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    # the same models over all rows at once, then near copies by comparing all pairs
    bad = toxicity.fit_on(docs, labels, ~held_out(F.col("_id"), 5, 0))
    good = quality.fit_on(docs, labels, ~held_out(F.col("_id"), 3, 1))
    rows = docs.select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r, p in zip(rows, bad.score([r.text for r in rows], bad.compressors() if bad.weights is not None else None), strict=True) if p < 0.5]
    rows = [r for r, p in zip(rows, good.score([t for _, t in rows]), strict=True) if p >= 0.5]
    lowest = {}
    for (i, t), c in zip(rows, brute_groups(rows), strict=True):
        key = (c, i, t) if t is None else c
        lowest[key] = min(lowest.get(key, (True, 1 << 62, "")), (i is None, i or 0, t or ""))
    want = sorted((i, max(1, len(t.encode()))) for _, i, t in lowest.values())
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_poor, corpus_pipeline.drop_near_copies):
        mixed = docs.withColumn("Predicted", F.lit(7.5)).withColumn("_own_score", F.lit("mine"))
        out = stage(spark, mixed, str(tmp_path))
        assert out.columns == mixed.columns and out.select("score", "Predicted", "_own_score").distinct().collect() == [("clash", 7.5, "mine")]
    got = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id", "cluster").agg(F.sum("size").alias("size"))
    assert sorted((r.doc_id or 0, r["size"]) for r in got.collect()) == want


def brute_groups(rows, similarity=0.8):
    """The class of each row by comparing all pairs; null texts are alone."""
    cut = [None if t is None else t.split() for _, t in rows]
    sets = [None if w is None else frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset() for w in cut]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] is not None and sets[j] is not None and (rows[i][1] == rows[j][1] or sets[i] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = documents(spark)
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, DATA)
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in seen.select("doc_id").collect()}
        kept = [r.doc_id for r in out.select("doc_id").collect()]
        assert set(kept) <= ids and len(kept) == len(set(kept)) and len(kept) > 0.5 * len(ids)
        assert stage(spark, docs.limit(0), DATA).count() == 0


def test_all_are_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert sorted(int(q[2:].split("_")[0]) for q in found if q.startswith("op")) == list(range(1, 14)) and "pipeline" in found


def _peak_mb(run) -> float:
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_fits_leave_the_driver_its_memory():
    from terraledger.llm import quality, toxicity

    rng = np.random.RandomState(3)
    texts = [" ".join(f"w{k}" for k in rng.randint(0, 3000, 900)) for _ in range(1000)]
    dense = sum(quality.encode_passages([t])[0].nbytes for t in texts) / 1e6
    assert dense > 60
    rows = [(t, k % 2) for k, t in enumerate(texts)]
    assert _peak_mb(lambda: quality.fit(rows, epochs=1)) < 0.8 * dense
    assert _peak_mb(lambda: toxicity.fit([t for t, y in rows if y], [t for t, y in rows if not y])) < 80


def test_bags_are_the_passages_of_their_texts():
    from terraledger.llm import quality

    texts = ["", "one", *(" ".join(f"word{k * j % 37}" for k in range(120 + j)) for j in range(120))]
    bags, own = quality.Bags(texts), np.array([101, 0, 57, 3, 1, 49, 50, 0])
    x, of = bags.laid(own)
    want = [quality.encode_passages([texts[k]])[0] for k in own]
    assert (x == np.concatenate(want)).all() and of.tolist() == np.repeat(np.arange(len(own)), [len(w) for w in want]).tolist()
