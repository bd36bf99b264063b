"""Near-duplicate links between embeddings by NN-descent.

Equal vectors of one label are one node first.  Neighbour lists start from the
orders of random hyperplane codes: in each of ``tables`` orders a vector is measured
against the few next to it.  NN-descent then refines the lists: the neighbours of a node,
in both directions, meet at that node and are measured against each other, and each
keeps its ``k`` best.
The lists serve the search; every pair measured at or above the threshold is kept
as a link in a table of its own, and components come from that table.  In a component
with a node of ``k`` links or more, members within half the threshold's angle of its
best linked node are all linked with each other, so they are counted and not compared;
the others are compared with the whole component, in square blocks that give
counts and not pairs.  The number of orders grows with the largest group, so that
the share of pairs on the threshold that never meet stays at ``missed``.  A recall
audit compares query vectors, of each class of degree about as many, with all rows;
while a group falls short, another round with more tables runs, and groups that
are short after the last are compared whole, in the same blocks.

Only cosines in double precision decide; the links kept are those at or above the
threshold, between nodes of one label that is not null.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or id, link with nothing and are their own
component; vectors of other lengths than the most common one are compared only
among equals in length; vectors of any finite length are scaled by their largest
component first; repeated rows, and different rows that bear one id, are separate
vectors; the recall is null where the audited vectors have no link at all;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraledger.operators.graph import components
from terraledger.sources.lineage import drop_written, written

THRESHOLD, K, TABLES, NEAR, BLOCK = 0.93, 12, 12, 3, 256
AUDIT = 200
#: Vectors of one cell of an order that pass through a task together.
CELL = 512
#: The share of pairs on the threshold, with no neighbour in common, that no start may meet.
MISSED = 0.002


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_list()).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def can_link(id_col: str, vec_col: str, label_col: str) -> Column:
    """Whether a row's vector may link at all; never null."""
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda v: v != 0)
    return F.coalesce(usable, F.lit(False))


def vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Rows ``(id, grp, vec)`` of vectors that can link: ``grp`` is the label with the vector's length."""
    # vectors of single precision stay so on their way; every task reads them as doubles
    vec = F.col(vec_col) if df.schema[vec_col].dataType.simpleString() == "array<float>" else F.col(vec_col).cast("array<double>")
    grp = F.concat_ws(":", F.col(label_col).cast("string"), F.size(vec))
    return df.where(can_link(id_col, vec_col, label_col)).select(F.col(id_col).cast("long").alias("id"), grp.alias("grp"), vec.alias("vec"))


def meeting(n: int, threshold: float, near: int) -> float:
    """The chance that a pair on the threshold meets in one order of ``n`` vectors.

    It shares each bit with probability ``same``; of the ``n / 2^d`` that share ``d``
    bits, those within ``near`` places of each other meet.
    """
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    return sum(same**d * (1 - same) * min(1.0, 2 * near / max(1.0, n / 2**d)) for d in range(30)) + same**30


def tables_for(n: int, threshold: float, near: int, missed: float) -> int:
    """As many orders of ``n`` vectors as leave the share ``missed`` of pairs on the threshold without a meeting."""
    return math.ceil(math.log(missed) / math.log1p(-min(1 - 1e-9, meeting(n, threshold, near))))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Unit vectors of an Arrow list column; rows of other lengths than the longest are filled up with zeros, which changes no product of equals."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat, ends = np.asarray(vectors.flatten(), np.float64), np.asarray(vectors.value_lengths(), np.int64)
    d = int(ends.max(initial=1))
    if (ends == d).all():
        x = flat.reshape(len(ends), d).copy()
    else:
        x = np.zeros((len(ends), d))
        x[np.repeat(np.arange(len(ends)), ends), np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)] = flat
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _runs(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """A number for each row that changes where one of the key columns does."""
    new = np.zeros(batch.num_rows, bool)
    for k in keys:
        column = batch.column(k)
        values = np.asarray(column.dictionary_encode().indices if pa.types.is_string(column.type) else column)
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def beside(batches: Iterator[pa.RecordBatch], keys: list[str], node: str, reach: int, good: Callable[..., np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """Cosines of the rows that stand up to ``reach`` places apart under equal keys, in one stream of sorted batches.

    ``good(sim, batch, i, j)`` may leave pairs out.  Only the last ``reach`` rows are held between batches.
    """
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = held.num_rows if held is not None else 0
        whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        run, own, x = _runs(whole, keys), np.asarray(whole.column(node)), matrix(whole.column("vec"))
        for k in range(1, reach + 1):
            j = np.arange(max(fresh, k), whole.num_rows)
            j = j[run[j] == run[j - k]]
            if not len(j):
                continue
            i = j - k
            sim = (x[i] * x[j]).sum(1)
            if good is not None:
                keep = good(sim, whole, i, j)
                i, j, sim = i[keep], j[keep], sim[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(own[i], own[j])), pa.array(np.maximum(own[i], own[j])), pa.array(sim)], names=["a", "b", "sim"])
        held = whole.slice(max(0, whole.num_rows - reach))


def starts(nodes: DataFrame, tables: int, seed: int, near: int) -> DataFrame:
    """Measured pairs ``(a, b, sim)``: neighbours in the orders of random hyperplane codes.

    An order is cut into cells (label, table, leading code bits, and a salt where a
    cell is large), so no sort spans a label; the vectors of a cell pass through one
    task in order, and only the last few are held.
    """
    total = max(1, nodes.count())
    bits = min(20, max(1, int(np.log2(max(2, total / 64)))))

    def codes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        x = matrix(batch.column("vec"))
        length = np.asarray(batch.column("vec").value_lengths())
        for t in range(tables):
            code = np.zeros(len(x), np.int64)
            for d in np.unique(length):
                own = length == d
                planes = np.random.RandomState([seed, t, int(d)]).randn(int(d), 30)
                code[own] = (((x[own, :d] @ planes) > 0).astype(np.int64) << np.arange(29, -1, -1)).sum(1)
            yield t, code

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp = batch.column("grp").to_pandas()
            for t, code in codes(batch):
                n = pd.DataFrame({"grp": grp, "cell": code >> (30 - bits)}).value_counts().reset_index(name="n")
                yield pa.RecordBatch.from_arrays([pa.array(n["grp"], pa.string()), pa.array(np.full(len(n), t, np.int32)), pa.array(n["cell"], pa.int64()), pa.array(n["n"], pa.int64())], names=["grp", "t", "cell", "n"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, code in codes(batch):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(code), t, np.int32)), pa.array(code), pa.array(code >> (30 - bits))], names=["id", "grp", "vec", "t", "code", "cell"])

    vec = nodes.schema["vec"].dataType.simpleString()
    rows = nodes.select("id", "grp", "vec")
    size = rows.mapInArrow(sized, "grp string, t int, cell long, n long").groupBy("grp", "t", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > CELL)
    cells = rows.mapInArrow(coded, f"id long, grp string, vec {vec}, t int, code long, cell long")
    # large cells are salted: their members also meet in the other orders, and through their neighbours
    cells = cells.join(size, ["grp", "t", "cell"], "left").withColumn("salt", F.pmod(F.xxhash64("id", "t"), F.coalesce(F.ceil(F.col("n") / CELL), F.lit(1))).cast("long"))
    keys = ["grp", "t", "cell", "salt"]
    laid = cells.select("id", "vec", *keys, "code").repartition(*keys).sortWithinPartitions(*keys, "code", "id")
    return once(laid.mapInArrow(lambda batches: beside(batches, keys, "id", near), "a long, b long, sim double"))


def once(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def best(edges: DataFrame, k: int) -> DataFrame:
    """Neighbour lists ``(u, v, sim, place)`` of undirected edges, the ``k`` nearest of each node."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"), "sim").unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"), "sim"))
    return both.withColumn("place", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))).where(F.col("place") <= k)


def descend(edges: DataFrame, nodes: DataFrame, threshold: float, k: int, sample: int = 5) -> DataFrame:
    """What one round measures ``(a, b, sim)``: of each node's list the ``sample`` nearest, in both directions but bounded, meet at it.

    Of the pairs measured those go on that reach the threshold, or are better than the
    worst in a full list of one of their ends.
    """
    lists = best(edges, k)
    worst = lists.groupBy("u").agg(F.when(F.count(F.lit(1)) >= k, F.min("sim")).otherwise(-2.0).alias("worst")).withColumnRenamed("u", "v")
    near = lists.where(F.col("place") <= sample)
    reverse = near.select(F.col("v").alias("u"), F.col("u").alias("v")).withColumn("place", F.row_number().over(Window.partitionBy("u").orderBy(F.xxhash64("u", "v")))).where(F.col("place") <= sample)
    around = near.select("u", "v").unionByName(reverse.select("u", "v")).distinct().join(worst, "v")
    laid = around.join(nodes.select(F.col("id").alias("v"), "vec"), "v").repartition("u").sortWithinPartitions("u", "v")

    def good(sim: np.ndarray, batch: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        w = np.asarray(batch.column("worst"))
        return (sim >= threshold) | (sim > w[i]) | (sim > w[j])

    # a node has at most twice the sample around it, so all of its pairs stand that near to each other
    rows = laid.select("u", "v", "vec", "worst")
    return once(rows.mapInArrow(lambda batches: beside(batches, ["u"], "v", 2 * sample - 1, good), "a long, b long, sim double"))


def nearest(edges: DataFrame, k: int) -> DataFrame:
    """The edges that stand in the list of one of their ends."""
    return once(best(once(edges), k).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "sim"))


def blocks_of(members: DataFrame, size: int = BLOCK) -> DataFrame:
    """``members(node, component, core)`` with ``block``: even parts of each component, those outside its core first.

    ``shell`` is the number of these, ``blocks`` that of all.
    """
    parts = lambda c: F.ceil(F.count_if(c) / size).cast("int")
    n = members.groupBy("component").agg(parts(~F.col("core")).alias("shell"), parts(F.col("core")).alias("inner"))
    n = n.where("shell > 0").select("component", "shell", (F.col("shell") + F.col("inner")).alias("blocks"))
    h = F.xxhash64("node")
    block = F.when(F.col("core"), F.col("shell") + F.pmod(h, F.col("blocks") - F.col("shell"))).otherwise(F.pmod(h, F.col("shell")))
    return members.join(n, "component").withColumn("block", block.cast("int"))


def full_degrees(blocked: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``(node, n_links, other)`` inside each component, but for links within its core.

    Every pair of blocks of which one lies outside the core is one piece of work that
    yields counts.  ``other`` is the smallest node that the links of a piece of work
    connect a node to, so a node has a row for each piece that it takes part in.
    """
    rows = blocked.join(nodes, blocked["node"] == nodes["id"]).select("component", "node", "block", "shell", "blocks", "core", "vec", "copies")
    i, j = F.least("block", "other"), F.greatest("block", "other")
    others = F.sequence(F.lit(0), F.when(F.col("core"), F.col("shell")).otherwise(F.col("blocks")) - 1)
    dealt = rows.withColumn("other", F.explode(others)).withColumn("i", i).withColumn("j", j)
    laid = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "block")

    def count(part: pd.DataFrame) -> pd.DataFrame:
        x, copies, ids = _unit(part["vec"]), part["copies"].to_numpy(np.int64), part["node"].to_numpy()
        first = (part["block"] == part["i"]).to_numpy()
        if part["i"].iat[0] == part["j"].iat[0]:
            near = _dots(x, x) >= threshold
            np.fill_diagonal(near, False)
            return pd.DataFrame({"node": ids, "n_links": near @ copies, "other": _lowest(near, ids, ids)[0]})
        near = _dots(x[first], x[~first]) >= threshold
        links = np.r_[near @ copies[~first], near.T @ copies[first]]
        return pd.DataFrame({"node": np.r_[ids[first], ids[~first]], "n_links": links, "other": np.concatenate(_lowest(near, ids[first], ids[~first]))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key = [], None
        for batch in batches:
            for k, part in batch.groupby(["component", "i", "j"], sort=False):
                if key is not None and k != key:
                    yield count(pd.concat(held, ignore_index=True))
                    held = []
                key = k
                held.append(part)
        if held:
            yield count(pd.concat(held, ignore_index=True))

    return laid.select("component", "i", "j", "block", "node", "vec", "copies").mapInPandas(run, "node long, n_links long, other long")


def _lowest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that the links ``near`` between two blocks connect each member to."""
    a, b = left.copy(), right.copy()
    linked = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    near = near[np.ix_(*linked)]
    top = np.iinfo(np.int64).max
    while len(linked[0]):
        low_b = np.minimum(b[linked[1]], np.where(near, a[linked[0]][:, None], top).min(0))
        b[linked[1]] = low_b
        low_a = np.minimum(a[linked[0]], np.where(near, low_b, top).min(1))
        if (low_a == a[linked[0]]).all():
            break
        a[linked[0]] = low_a
    return a, b


def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Dot products summed like ``measured`` sums them, so a pair on the threshold is decided alike everywhere."""
    out = np.empty((len(x), len(y)))
    for k in range(len(x)):
        out[k] = (x[k] * y).sum(1)
    return out


def audit(nodes: DataFrame, links: DataFrame, threshold: float, queries: int) -> dict[str, float | None]:
    """Recall of ``links(node, n_links)`` for each group with a link, and at ``""`` for all.

    About ``queries`` nodes of each class of found degree (by powers of two) are
    compared with all nodes of their group.  Recall is a query's own; its means
    over the classes of true degree are averaged, so a large group of copies does
    not outweigh pairs.
    """
    weighed = nodes.join(links.withColumnRenamed("node", "id"), "id", "left").withColumn("found", F.coalesce("n_links", F.lit(0)))
    weighed = weighed.withColumn("class", F.floor(F.log2(F.col("found") + 1)).cast("int"))
    sizes = {r["class"]: r["count"] for r in weighed.groupBy("class").count().collect()}
    if not sizes:
        return {"": None}
    every = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, -(-n // queries))])
    drawn = weighed.where(F.pmod(F.xxhash64(F.lit(99), "id"), F.element_at(every, F.col("class"))) == 0)
    asked = drawn.select(F.col("id").alias("node"), F.col("grp").alias("q_grp"), F.col("vec").alias("q"), "found").collect()
    by_grp: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for g in {r.q_grp for r in asked}:
        own = [r for r in asked if r.q_grp == g]
        by_grp[g] = np.array([r.node for r in own]), _unit(pd.Series([np.array(r.q) for r in own]))
    held = nodes.sparkSession.sparkContext.broadcast(by_grp)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for g, part in batch.groupby("grp", sort=False):
                if g in held.value:
                    ids, q = held.value[g]
                    near = (_unit(part["vec"]) @ q.T >= threshold) & (part["id"].to_numpy()[:, None] != ids)
                    total[g] = total.get(g, 0) + near.T @ part["copies"].to_numpy(np.int64)
        for g, truth in total.items():
            yield pd.DataFrame({"node": held.value[g][0], "truth": truth})

    counted = nodes.select("id", "grp", "vec", "copies").mapInPandas(run, "node long, truth long").groupBy("node").agg(F.sum("truth").alias("truth")).where("truth > 0")
    truth = {r.node: r.truth for r in counted.collect()}
    met: dict[str, dict[int, list[float]]] = {"": {}}
    for r in asked:
        if r.node in truth:
            for g in ("", r.q_grp):
                met.setdefault(g, {}).setdefault(int(truth[r.node]).bit_length(), []).append(min(1.0, r.found / truth[r.node]))
    return {g: float(np.mean([np.mean(x) for x in classes.values()])) if classes else None for g, classes in met.items()}


def near_duplicates(df: DataFrame, *, threshold: float = THRESHOLD, k: int = K, tables: int = TABLES, rounds: int = 2, audit_queries: int = AUDIT, least_recall: float = 0.98, most_passes: int = 3, missed: float = MISSED, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept, recall)``, one per input row; ``recall`` is what the audit found."""
    usable = written(vectors(df, id_col, vec_col, label_col))
    nodes = usable.groupBy("grp", "vec").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    # numbered once, as they are written: an id may stand on several vectors
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()))
    largest = nodes.groupBy("grp").count().agg(F.max("count")).first()[0] or 1
    tables = max(tables, tables_for(largest, threshold, NEAR, missed))
    edges, links, done = None, None, []
    for turn in range(most_passes):
        over = [written(starts(nodes, tables * (turn + 1), 7 + turn, NEAR))]
        edges = written(nearest(over[0] if edges is None else edges.unionByName(over[0]), k))
        for _ in range(rounds):
            over.append(written(descend(edges, nodes, threshold, k)))
            old, edges = edges, written(nearest(edges.unionByName(over[-1]), k))
            drop_written(old)
        # the lists are cut for the search alone: no link that was measured is lost with them
        new = reduce(DataFrame.unionByName, over).where(F.col("sim") >= threshold).select("a", "b")
        links = written((new if links is None else links.unionByName(new)).distinct())
        drop_written(*over)
        label, degree = _degrees(links, nodes, threshold, k)
        recall = audit(nodes, degree, threshold, audit_queries)
        short = [g for g, r in recall.items() if g and r is not None and r < least_recall]
        done += [label, degree, links]
        if not short:
            break
    if short:
        members = nodes.where(F.col("grp").isin(short)).select(F.col("id").alias("node"), F.col("grp").alias("component"), F.lit(False).alias("core"))
        pieces = written(full_degrees(blocks_of(members), nodes, threshold))
        exact = pieces.groupBy("node").agg(F.sum("n_links").alias("n_links"))
        label = components(links.unionByName(pieces.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))))
        degree = written(degree.join(exact, "node", "left_anti").unionByName(exact))
        recall = audit(nodes, degree, threshold, audit_queries)
        done += [label, degree, pieces]
    lowest = label.join(nodes.select(F.col("id").alias("node"), "low"), "node").groupBy("component").agg(F.min("low").alias("lowest"))
    known = nodes.select("grp", "vec", F.col("id").alias("node"), "copies", "low").join(degree, "node", "left").join(label, "node", "left").join(lowest, "component", "left")
    known = known.select("grp", "vec", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("lowest", "low").alias("component_id"))
    linked = usable.join(known, ["grp", "vec"]).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    apart = df.where(~can_link(id_col, vec_col, label_col)).select(F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"))
    out = written(linked.unionByName(apart).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
    drop_written(usable, nodes, edges, *done)
    return out.withColumn("recall", F.lit(recall[""]).cast("double"))


def _degrees(linked: DataFrame, nodes: DataFrame, threshold: float, k: int) -> tuple[DataFrame, DataFrame]:
    """Components ``(node, component)`` and ``(node, n_links)``, the saturated lists enlarged."""
    label = components(linked)
    lists = linked.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(linked.select(F.col("b").alias("node"), F.col("a").alias("other")))
    weighed = lists.join(nodes.select(F.col("id").alias("other"), "copies"), "other")
    listed = written(weighed.groupBy("node").agg(F.sum("copies").alias("n_links"), F.count(F.lit(1)).alias("listed")))
    # the best linked node of a component with a full list is its centre
    centres = listed.join(label, "node").groupBy("component").agg(F.max(F.struct("listed", (-F.col("node")).alias("_n"))).alias("m")).where(F.col("m.listed") >= k)
    centres = centres.select("component", (-F.col("m._n")).alias("centre")).join(nodes.select(F.col("id").alias("centre"), F.col("vec").alias("at")), "centre").select("component", "at")
    held = label.join(centres, "component").join(nodes.select(F.col("id").alias("node"), "vec", "copies"), "node").select("node", "component", "copies", "vec", "at")
    half = math.cos(math.acos(min(1.0, threshold)) / 2) + 1e-9

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch[["node", "component", "copies"]].assign(core=(_unit(batch["vec"]) * _unit(batch["at"])).sum(1) >= half)

    members = written(held.mapInPandas(inside, "node long, component long, copies long, core boolean"))
    core = members.where("core").groupBy("component").agg(F.sum("copies").alias("_all"))
    sure = members.where("core").join(core, "component").select("node", (F.col("_all") - F.col("copies")).alias("n_links"))
    compared = full_degrees(blocks_of(members.drop("copies")), nodes, threshold).select("node", "n_links")
    enlarged = sure.unionByName(compared).groupBy("node").agg(F.sum("n_links").alias("all_links"))
    degree = written(listed.join(enlarged, "node", "left").select("node", F.coalesce("all_links", "n_links").alias("n_links")))
    drop_written(listed, members)
    return label, degree
