"""Near-duplicate classes by DartMinHash, banded joining and an exact check.

Darts fall on an element's weight (cut into dyadic regions) and on a rank axis,
as a Poisson process that the element's hash alone decides: region by region the
arrivals are drawn in rank order, and those whose weight coordinate lies beyond
the element's weight miss.  Ranks run up to ``t / W`` for a text of total weight
``W``, so a signature costs its elements plus about ``t = k ln k + 2 k`` darts.
Each dart belongs to one of ``k`` coordinates; the earliest of each is kept, and
texts with an empty coordinate are thrown again with twice the range.

Elements are shingles of five words.  In sets (``weighting="set"``) each distinct
shingle weighs 1, and agreement estimates the Jaccard similarity that the check
uses; ``"count"`` weighs by occurrence (weighted Jaccard).

Texts that are byte for byte equal are one node, named by a 64-bit hash of the
text, so ids may be missing or repeated.  A bucket of a band is joined as
a star to its smallest member, links are checked exactly, and only buckets whose
members this leaves in different classes are opened: those of up to ``small``
members pair by pair, the members of larger ones through prefixes of their
elements, rarest first.  Sets that reach the similarity share an element of those
prefixes at places that leave room for it, so no link is lost; each element is
first joined as a star to the member in which it stands foremost, and what then
still lies in different classes is paired.  So groups of copies do not multiply.

Defined cases: a null text is alone in its class and kept; a text with no word is
in a class with its byte-for-byte copies; a text of under five words is one
shingle; rows without an id take part like others (the class takes its smallest id,
null where it has none); an id that stands on different texts is decided for each
of them apart; repeated rows are copies of each other; different texts whose hashes
agree (a second hash tells them apart) are in classes with their own copies alone,
so none is lost; an empty table gives no rows; extra columns are not read.
Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraledger.llm.common import mix, steps, words
from terraledger.operators.graph import components
from terraledger.sources.lineage import drop_written, written

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
STEP = 1 << 20
CHUNK = 256
#: Words of the bit filter that precedes a join with texts: 2^20 of 8 bytes at most.
WORDS = 1 << 20
#: Members of an open bucket that are compared pair by pair; members of larger ones go through prefixes.
SMALL = 32
#: Band entries that one task joins.
ENTRIES_A_PART = 1_000_000


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes by text: ``(hash, text, count)``, ascending within a text."""
    word, of = words(texts)[:2]
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = np.bincount(of, minlength=len(texts))
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):  # words that hash to 0 fill up short texts
        at = np.repeat(np.cumsum(count)[short], SHINGLE - count[short])
        word = np.insert(word, at, np.uint64(0))
        of = np.insert(of, at, np.repeat(short, SHINGLE - count[short]))
    n = len(word) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h = h * np.uint64(0xD6E8FEB86659FD93) + word[k : k + n]
    whole = of[:n] == of[SHINGLE - 1 :]
    h, of = mix(h[whole]), of[:n][whole]
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])]
    first = np.flatnonzero(new)
    return h[first], of[first], np.diff(np.r_[first, len(h)])


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def dart_signatures(h: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """Signatures ``(n, k)`` of weighted sets: elements ``h`` of set ``of`` with ``weight``; rows of empty sets are 0."""
    total = np.bincount(of, weight, n)
    reach = np.zeros(n)
    reach[total > 0] = (k * np.log(k) + 2 * k) / total[total > 0]
    # dyadic regions of the weight axis: [0, 1), [1, 2), [2, 4), ...
    regions = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64) + 1
    element = np.repeat(np.arange(len(h)), regions)
    region = np.arange(len(element)) - np.repeat(np.cumsum(regions) - regions, regions)
    low = np.where(region > 0, 2.0 ** (region - 1), 0.0)
    width = np.maximum(low, 1.0)
    seed = mix(h[element] + region.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    best = np.full(n * k, np.inf)
    out = np.zeros(n * k, np.uint64)
    todo = np.ones(n, bool)
    while True:
        live = np.flatnonzero(todo[of[element]])
        rank = np.zeros(len(live))
        state = seed[live]
        while len(live):
            state = mix(state + np.uint64(0x9FB21C651E98DF25))
            rank = rank - np.log(_unit(state)) / width[live]
            inside = rank < reach[of[element[live]]]
            live, rank, state = live[inside], rank[inside], state[inside]
            dart = mix(state ^ np.uint64(0x5851F42D4C957F2D))
            own = element[live]
            hit = low[live] + width[live] * _unit(mix(dart + np.uint64(1))) < weight[own]
            key = of[own[hit]] * k + (dart[hit] % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, key, rank[hit])
            first = rank[hit] == best[key]
            out[key[first]] = dart[hit][first]
        todo = (total > 0) & np.isinf(best.reshape(n, k)).any(1)
        if not todo.any():
            return out.reshape(n, k)
        reach[todo] *= 2
        best.reshape(n, k)[todo] = np.inf


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    n = len(signature)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), (n, bands)).copy()
    for r in range(rows):
        key = mix(key * np.uint64(31) + signature[:, r :: rows][:, :bands])
    return key.view(np.int64)


def named(text: Column) -> dict[str, Column]:
    """The two hashes that tell texts apart; null for a null text."""
    return {"node": F.when(text.isNotNull(), F.xxhash64(text)), "check": F.when(text.isNotNull(), F.xxhash64(F.lit(1), text))}


def signed(df: DataFrame, *, bands: int = BANDS, rows: int = ROWS, weighting: str = "set", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, node, check, bands)`` of whole texts; of equal texts in a step the first bears the bands, which are empty without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, limit=STEP):
            node = np.array(batch.column(1).fill_null(0))
            first = np.sort(np.unique(node, return_index=True)[1])
            own = [texts[k] for k in first]
            h, of, count = shingles(own)
            weight = np.ones(len(h)) if weighting == "set" else count.astype(np.float64)
            keys = band_keys(dart_signatures(h, of, weight, len(own), bands * rows), bands, rows)
            some = np.bincount(of, minlength=len(own)) > 0
            size = np.zeros(len(texts), np.int64)
            size[first[some]] = bands
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(keys[some].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), lists], names=["id", "node", "check", "bands"])

    text = F.col(text_col)
    rows_of = df.select(F.col(id_col).cast("long").alias("id"), *[c.alias(k) for k, c in named(text).items()], text.alias("text"))
    return rows_of.mapInArrow(run, "id long, node long, check long, bands array<long>")


def bit_words(keys: DataFrame, *columns: str) -> DataFrame:
    """``(_word, _set)``: the bits that the keys set in at most ``WORDS`` words of 64, a table of a bounded size."""
    h = F.xxhash64(F.lit(31), *columns)
    word, bit = F.pmod(F.shiftright("_h", 6), F.lit(WORDS)).cast("int"), F.expr("shiftleft(1L, cast(_h & 63 as int))")
    return keys.select(h.alias("_h")).select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_set"))


def marked(df: DataFrame, words_set: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``_maybe``: true for every row whose key is in the filter, and for few others while its bits are many for its keys."""
    out = df.withColumn("_h", F.xxhash64(F.lit(31), *columns))
    out = out.withColumn("_word", F.pmod(F.shiftright("_h", 6), F.lit(WORDS)).cast("int")).withColumn("_bit", F.expr("shiftleft(1L, cast(_h & 63 as int))"))
    met = out.join(F.broadcast(words_set), "_word", "left")
    return met.withColumn("_maybe", F.coalesce(F.col("_set").bitwiseAND(F.col("_bit")) != 0, F.lit(False))).drop("_h", "_word", "_bit", "_set")


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose ``id`` is not in ``ids``, before anything is shuffled.

    Every row whose id is in ``ids`` passes; of the others, few while the bits are
    many for the ids, and all of them once they are not, which costs only time.
    """
    return marked(docs, bit_words(ids, "id"), "id").where("_maybe").select("id", "text")


def checked(pairs: DataFrame, docs: DataFrame, *, similarity: float = SIMILARITY, weighting: str = "set") -> DataFrame:
    """Of ``pairs(a, b)`` those whose texts ``docs(id, text)`` reach ``similarity``, with it.

    A text with many partners meets them in chunks, each with a copy of it, so no
    task holds more than one such text and the rows that stream past it.
    """
    chunks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(chunks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"))
    heads = chunks.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    rows = heads.select("a", "chunk", F.lit(None).cast("long").alias("b"), F.col("a").alias("id")).unionByName(dealt.select("a", "chunk", "b", F.col("b").alias("id")))
    involved = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    # merged on either size of the table: whether the ids happen to fit a broadcast shall not decide the plan
    texts = likely(docs, involved).dropDuplicates(["id"])
    laid = rows.hint("merge").join(texts, "id").repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weight = np.zeros(0, np.uint64), np.zeros(0)
        for batch, texts in steps(batches, limit=STEP):
            h, of, count = shingles(texts)
            w = np.ones(len(h)) if weighting == "set" else count.astype(np.float64)
            cuts = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
            found = []
            for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own, own_weight = h[cuts[k] : cuts[k + 1]], w[cuts[k] : cuts[k + 1]]
                if b is None:
                    head, weight = own, own_weight
                    continue
                _, i, j = np.intersect1d(head, own, assume_unique=True, return_indices=True)
                shared = np.minimum(weight[i], own_weight[j]).sum()
                whole = weight.sum() + own_weight.sum() - shared
                if whole and shared / whole >= similarity:
                    found.append((a, b, float(shared / whole)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["a", "b", "similarity"])

    return laid.select("a", "b", "text").mapInArrow(run, "a long, b long, similarity double")


def prefixes(members: DataFrame, docs: DataFrame, *, similarity: float = SIMILARITY, weighting: str = "set") -> DataFrame:
    """Rows ``(id, size, pos, token)``: the rarest elements of each of ``members(id)``, as far as a link needs them.

    A set of ``size`` shares at least ``similarity * size`` elements with any set
    that it links to, so one of its first ``size - similarity * size + 1`` in any
    order that all sets have in common.  Weights count as repeated elements.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, limit=STEP):
            h, of, count = shingles(texts)
            if weighting != "set":
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                h, of = mix(np.repeat(h, count) + nth.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), np.repeat(of, count)
            cuts = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cuts), pa.array(h.view(np.int64)))], names=["id", "tokens"])

    texts = members.hint("merge").join(likely(docs, members).dropDuplicates(["id"]), "id").select("id", "text")
    sets = written(_even(texts.mapInArrow(run, "id long, tokens array<long>"), members.count(), 500))
    each = sets.select("id", F.explode("tokens").alias("token"))
    rare = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = each.join(rare, "token").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("ranked")).withColumn("size", F.size("ranked"))
    length = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1
    out = ranked.select("id", "size", F.posexplode(F.slice("ranked", F.lit(1), length.cast("int"))).alias("pos", "own")).select("id", "size", "pos", "own.token")
    out = written(out)
    drop_written(sets)
    return out


def _reach(x: str, y: str, similarity: float) -> Column:
    """Whether sets that have an element at these places in common can share enough from there on."""
    left = F.least(F.col(f"{x}.size") - F.col(f"{x}.pos"), F.col(f"{y}.size") - F.col(f"{y}.pos"))
    return left * (1 + similarity) >= (F.col(f"{x}.size") + F.col(f"{y}.size")) * similarity - 1e-9


def prefix_stars(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of ``rows(id, size, pos, token, component)`` with the member in which their element stands foremost."""
    hubs = rows.groupBy("token").agg(F.min(F.struct("pos", "id", "size", "component")).alias("hub"))
    met = rows.select("token", F.struct("id", "size", "pos", "component").alias("own")).join(hubs, "token").where((F.col("own.component") != F.col("hub.component")) & _reach("own", "hub", similarity))
    return met.select(F.least("own.id", "hub.id").alias("a"), F.greatest("own.id", "hub.id").alias("b")).distinct()


def prefix_pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of all members of different components that prefixes leave possible.

    Of two sets the smaller shares ``2 s / (1 + s)`` of itself, so fewer of its
    first elements are looked at than of the larger one's.
    """
    side = F.struct("id", "size", "pos", "component")
    x = rows.where(F.col("pos") <= F.col("size") - F.ceil(F.col("size") * (2 * similarity / (1 + similarity)) - 1e-9)).select("token", side.alias("x"))
    y = rows.select("token", side.alias("y"))
    met = x.join(y, "token").where((F.col("x.component") != F.col("y.component")) & (F.col("x.size") <= F.col("y.size")) & _reach("x", "y", similarity))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def classes(nodes: DataFrame, docs: DataFrame, *, similarity: float = SIMILARITY, bands: int = BANDS, weighting: str = "set", small: int = SMALL) -> DataFrame:
    """``(node, component)`` of the nodes that a link connects, from ``nodes(id, bands)`` and their texts ``docs(id, text)``."""
    n_nodes = nodes.count()
    # one partitioning by key serves the smallest member and the star; as many parts as the entries ask for
    entries = nodes.select("id", F.explode("bands").alias("key")).repartition(-(-n_nodes * bands // ENTRIES_A_PART) or 1, "key")
    hubs = entries.groupBy("key").agg(F.min("id").alias("a"))
    tested = written(_even(entries.join(hubs, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct(), n_nodes, 20_000))
    passed = lambda pairs: written(_even(checked(pairs, docs, similarity=similarity, weighting=weighting), pairs.count(), 2_000))
    links = passed(tested)
    label = written(components(links))

    def with_component(rows_of: DataFrame) -> DataFrame:
        return rows_of.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))

    def try_pairs(pairs: DataFrame) -> None:
        nonlocal links, label, tested
        new = written(pairs.join(tested, ["a", "b"], "left_anti"))
        more = passed(new)
        tested = tested.unionByName(new)
        if more.limit(1).count():
            links = links.unionByName(more)
            old, label = label, written(components(links))
            drop_written(old)

    state = with_component(nodes).select("component", "id", F.explode("bands").alias("key"))
    ends = state.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
    open_ = written(state.join(ends.where("lo <> hi"), "key").select("key", "id", "component", "n"))
    near = open_.where(F.col("n") <= small)
    other = near.select("key", F.col("id").alias("b"), F.col("component").alias("other"))
    pairs = near.withColumnRenamed("id", "a").join(other, "key").where("a < b and component <> other").select("a", "b").distinct()
    crowd = open_.where(F.col("n") > small).select("id").distinct()
    if crowd.limit(1).count():
        foremost = prefixes(crowd, docs, similarity=similarity, weighting=weighting)
        try_pairs(pairs.unionByName(prefix_stars(with_component(foremost), similarity)).distinct())
        pairs = prefix_pairs(with_component(foremost), similarity)
    try_pairs(pairs)
    drop_written(open_, tested, links)
    return label


def decided(df: DataFrame, *, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighting: str = "set", id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """One row per document: ``(id, node, check, class_id, kept)``.

    A class keeps one of its texts, the one with the smallest id, on the rows with that id.
    """
    sig = written(signed(df, bands=bands, rows=rows, weighting=weighting, id_col=id_col, text_col=text_col))
    docs = df.select(named(F.col(text_col))["node"].alias("id"), F.col(text_col).alias("text")).where("text is not null")
    nodes = written(sig.where(F.size("bands") > 0).select(F.col("node").alias("id"), "bands").dropDuplicates(["id"]))
    label = classes(nodes, docs, similarity=similarity, bands=bands, weighting=weighting, small=small)
    texts = sig.where("node is not null").groupBy("node", "check").agg(F.min("id").alias("rep"))
    clash = texts.groupBy("node").count().where("count > 1").select("node", F.lit(True).alias("clash"))
    texts = written(texts.join(label, "node", "left").join(clash, "node", "left").select("node", "check", "rep", F.when(F.col("clash"), F.xxhash64("node", "check")).otherwise(F.coalesce("component", "node")).alias("component")))
    first = F.min_by(F.struct("node", "check"), F.struct(F.col("rep").isNull(), "rep", "node", "check"))
    chosen = texts.groupBy("component").agg(first.alias("keep"), F.min("rep").alias("class_id"))
    per_text = texts.join(chosen, "component").select("node", "check", "rep", "class_id", (F.struct("node", "check") == F.col("keep")).alias("keep"))
    out = sig.select("id", "node", "check").join(per_text, ["node", "check"], "left")
    kept = F.coalesce(F.col("keep") & F.col("id").eqNullSafe(F.col("rep")), F.lit(True))
    result = written(out.select("id", "node", "check", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), kept.alias("kept")))
    drop_written(sig, nodes, label, texts)
    return result


def near_duplicates(df: DataFrame, **options: object) -> DataFrame:
    """One row per document: ``(doc_id, class_id, kept)``; the class is its smallest ``doc_id``; options are those of ``decided``."""
    return decided(df, **options).select(F.col("id").alias("doc_id"), "class_id", "kept")


def one_of_each(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The rows of ``df`` that stay when each near-duplicate class keeps exactly one row; columns as they are.

    A row goes by its id and its text together: no other text is lost that shares the
    id, and rows without an id go like others.
    """
    kinds = decided(df, id_col=id_col, text_col=text_col, **options)
    found = kinds.where("node is not null").groupBy(F.col("node").alias("_node"), F.col("check").alias("_check"), F.col("id").alias("_id")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    found = written(found.where("not kept or n > 1"))
    drop_written(kinds)
    keyed = df.withColumns({f"__{k}": c for k, c in named(F.col(text_col)).items()}).withColumn("__id", F.col(id_col).cast("long"))
    # most rows stay: those that the filter doesn't know go past the join, and their texts are never shuffled
    keyed = marked(keyed, bit_words(found, "_node", "_check", "_id"), "__node", "__check", "__id")
    same = (F.col("__node") == F.col("_node")) & (F.col("__check") == F.col("_check")) & F.col("__id").eqNullSafe(F.col("_id"))
    maybe = keyed.where("_maybe")
    alone = maybe.join(found, same, "left_anti")
    again = maybe.join(found.where("kept"), same, "left_semi").dropDuplicates(["__node", "__check", "__id"])
    return keyed.where("not _maybe").unionByName(alone).unionByName(again).select(*[F.col(f"`{c}`") for c in df.columns])


def _even(df: DataFrame, n_rows: int, rows_a_task: int) -> DataFrame:
    """As many tasks as ``n_rows`` ask for, where the shuffle made more."""
    return df.coalesce(max(1, -(-n_rows // rows_a_task)))
