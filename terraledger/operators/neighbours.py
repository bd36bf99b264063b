"""Exact nearest neighbours in any number of dimensions, without all pairs.

Sources lie in cells around pivots that a hash draws from them, about the square
root of a group's sources and ``MOST_PIVOTS`` at most.  A query first visits the
nearest cells that hold ``k`` sources; the k-th distance found there bounds the
rest: a cell whose ring of distances around its pivot can't reach into that
bound is never visited (triangle inequality).  Cells are cut into blocks of
bounded size and their queries into parts, so a cell that holds a third of all
sources is shared among tasks, and nothing but counts is joined.

With many dimensions all distances are alike and rings rule out next to nothing:
a group whose queries would meet a quarter of all pairs or more compares all of
them, in blocks of bounded size, and moves each row once for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraledger.sources.lineage import written

#: Sources up to which a group is one cell.
SMALL = 2048
MOST_PIVOTS = 1024
#: Rows of a group that one task holds against the group's pivots.
STRETCH = 65_536
#: Sources and queries of one unit of a group whose cells rule out too little.
ALL_BLOCK, ALL_PART = 16_384, 32_768
#: The part of all pairs from which on a group compares all.
SHARE = 0.25
#: Numbers of a block of distances, and of differences.
NUMBERS = 1 << 21


def _streamed(side: DataFrame, rows: DataFrame, keys: list[str], work: Callable, schema: str, columns: list[str]) -> DataFrame:
    """``work(side, rows)`` for the rows of each key in batches, with the whole (bounded) side of the key at hand."""
    one = lambda df, n: df.select(*keys, F.lit(n).alias("_side"), *[c if c in df.columns else F.lit(None).alias(c) for c in columns])
    # as many tasks as asked for: rows are few beside the work on them
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = one(side, 0).unionByName(one(rows, 1)).repartition(tasks, *keys).sortWithinPartitions(*keys, "_side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, joined = None, [], None
        for batch in batches:
            for now, part in batch.groupby([*keys, "_side"], sort=False, dropna=False):
                if now[:-1] != key:
                    key, held, joined = now[:-1], [], None
                if now[-1] == 0:
                    held.append(part)
                    continue
                if joined is None:
                    joined = pd.concat(held) if held else part.iloc[:0]
                yield from work(joined, part)

    return laid.mapInPandas(run, schema)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances by differences: exact for equal vectors, in steps of bounded size."""
    step = max(1, NUMBERS // max(1, y.size))
    return np.concatenate([np.sqrt(((x[k : k + step, None, :] - y[None]) ** 2).sum(2)) for k in range(0, len(x), step)])


def _slices(rows: pd.DataFrame, beside: int) -> Iterator[pd.DataFrame]:
    """``rows`` in slices whose blocks against ``beside`` others stay small."""
    step = max(1, NUMBERS // 2 // max(1, beside))
    return (rows.iloc[k : k + step] for k in range(0, len(rows), step))


def _nearest(x: np.ndarray, own: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray) -> pd.DataFrame:
    """``(q, s, d2)``: the ``k`` of ``y`` nearest to each row of ``x`` and no further than ``bound``, but for the own id.

    A product of matrices tells with a known error which may be among them; these
    alone are measured by differences, so distances and ties are exact.
    """
    middle = y.mean(0)
    xc, yc = x - middle, y - middle
    xx, yy = (xc * xc).sum(1), (yc * yc).sum(1)
    near = xx[:, None] + yy[None] - 2 * (xc @ yc.T)
    near[own[:, None] == ids[None]] = np.inf
    slack = 1e-12 * (xx + yy.max() + (middle * middle).sum()) * (x.shape[1] + 8) / 8
    # the k-th least of the least of each strip is reached by k members
    strip = 64 if near.shape[1] >= 128 * k else 1
    strips = near[:, : near.shape[1] // strip * strip].reshape(len(x), -1, strip).min(2) if strip > 1 else near
    most = np.partition(strips, k - 1, 1)[:, k - 1] if strips.shape[1] > k else np.full(len(x), np.inf)
    most = np.minimum(most, bound * (1 + 1e-9)) + 2 * slack
    r, c = np.nonzero((near <= most[:, None]) & (near < np.inf))
    step = max(1, NUMBERS // x.shape[1])
    d2 = np.concatenate([np.zeros(0), *[((x[r[a : a + step]] - y[c[a : a + step]]) ** 2).sum(1) for a in range(0, len(r), step)]])
    order = np.lexsort((ids[c], d2, r))
    r, c, d2 = r[order], c[order], d2[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    kept = (place < k) & np.isfinite(d2) & (d2 <= bound[r] * (1 + 1e-9))
    return pd.DataFrame({"q": own[r[kept]], "s": ids[c[kept]], "d2": d2[kept]})


def _spread(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows with ``_stretch``: a group's rows dealt to as many stretches as its size asks for."""
    return df.join(sizes, "g").withColumn("_stretch", F.pmod(F.xxhash64("id"), F.col("_stretches")).cast("int")).drop("_stretches")


def _in_cells(sources: DataFrame, pivots: DataFrame, stretches: DataFrame) -> DataFrame:
    """``(g, id, vec, cell, reach)``: each source with its nearest pivot; ``cell`` is null in groups without pivots."""
    side = pivots.join(stretches, "g").withColumn("_stretch", F.explode(F.sequence(F.lit(0), F.col("_stretches") - 1)))

    def work(p: pd.DataFrame, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(p):
            yield rows[["g", "id", "vec"]].assign(cell=pd.array([None] * len(rows), dtype="Int64"), reach=0.0)
            return
        at, names = _matrix(p["vec"]), p["cell"].to_numpy(np.int64)
        for part in _slices(rows, len(p)):
            d = _distances(_matrix(part["vec"]), at)
            best = d.argmin(1)
            yield part[["g", "id", "vec"]].assign(cell=pd.array(names[best], dtype="Int64"), reach=d[np.arange(len(d)), best])

    return _streamed(side, _spread(sources, stretches), ["g", "_stretch"], work, "g long, id long, vec array<double>, cell long, reach double", ["id", "vec", "cell"])


def _visits(queries: DataFrame, rings: DataFrame, stretches: DataFrame, k: int, first: bool, counted: bool = False) -> DataFrame:
    """``(g, id, vec, cell, bound)``: the cells that each query looks into, in the first or the second round.

    The second round takes ``bound`` (the k-th squared distance found, null where
    there were fewer) and leaves out the cells of the first.  ``counted`` gives
    ``(g, pairs)`` instead, the queries times the sources they would meet.
    """
    side = rings.join(stretches, "g").withColumn("_stretch", F.explode(F.sequence(F.lit(0), F.col("_stretches") - 1)))

    def looks(p: pd.DataFrame, at: np.ndarray | None, rows: pd.DataFrame) -> np.ndarray:
        if at is None:  # one cell without a pivot: all of it, at once
            return np.full((len(rows), len(p)), first)
        n, d = p["n"].to_numpy(np.int64), _distances(_matrix(rows["vec"]), at)
        order = np.argsort(d, 1, kind="stable")
        before = np.cumsum(n[order], 1) - n[order]
        near = np.empty(d.shape, bool)
        np.put_along_axis(near, order, before < k + 1, 1)  # one more: the query itself may lie among them
        if first:
            return near
        bound = np.sqrt(rows["bound"].to_numpy(np.float64))
        bound = np.where(np.isnan(bound), np.inf, bound)[:, None]
        gap = np.maximum(d - p["outer"].to_numpy(), p["inner"].to_numpy() - d)
        return ~near & (gap <= bound * (1 + 1e-9) + 1e-9)

    def work(p: pd.DataFrame, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(p):
            return  # no source in this group
        at = None if p["cell"].isna().any() else _matrix(p["vec"])
        for part in _slices(rows, len(p)):
            near = looks(p, at, part)
            if counted:
                yield pd.DataFrame({"g": part["g"].iloc[:1], "pairs": float((near @ p["n"].to_numpy(np.float64)).sum())})
                continue
            q, c = np.nonzero(near)
            step = max(1, NUMBERS // len(part["vec"].iat[0]) // 4)
            for a in range(0, len(q), step):
                yield part[["g", "id", "vec", "bound"]].iloc[q[a : a + step]].assign(cell=pd.array(p["cell"].iloc[c[a : a + step]].to_numpy(), dtype="Int64"))

    schema = "g long, pairs double" if counted else "g long, id long, vec array<double>, cell long, bound double"
    return _streamed(side, _spread(queries, stretches), ["g", "_stretch"], work, schema, ["id", "vec", "cell", "n", "inner", "outer", "bound"])


def _measured(visits: DataFrame, cells: DataFrame, k: int, block: int, part: int | None = None) -> DataFrame:
    """``(g, q, s, d2)``: of each block of a cell the ``k`` sources nearest to each query that visits the cell, none beyond its ``bound``."""
    where = ["g", "cell"]
    cells, visits = cells.withColumn("cell", F.coalesce("cell", F.lit(0))), visits.withColumn("cell", F.coalesce("cell", F.lit(0)))
    count = lambda df, name, rows: df.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    parts = count(cells, "_blocks", block).join(count(visits, "_parts", part or 8 * block), where)
    deal = lambda name: F.pmod(F.xxhash64("id", "vec"), F.col(name)).cast("int")
    all_of = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    held = cells.join(parts, where).withColumn("_block", deal("_blocks")).withColumn("_part", all_of("_parts"))
    asked = visits.join(parts, where).withColumn("_part", deal("_parts")).withColumn("_block", all_of("_blocks"))

    def work(s: pd.DataFrame, q: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(s):
            return
        y, ids = _matrix(s["vec"]), s["id"].to_numpy(np.int64)
        for few in _slices(q, len(y)):
            bound = few["bound"].to_numpy(np.float64)
            found = _nearest(_matrix(few["vec"]), few["id"].to_numpy(np.int64), y, ids, k, np.where(np.isnan(bound), np.inf, bound))
            yield found.assign(g=q["g"].iat[0])

    return _streamed(held, asked, [*where, "_block", "_part"], work, "g long, q long, s long, d2 double", ["id", "vec", "bound"])


def located(df: DataFrame) -> DataFrame:
    """The rows whose ``vec`` is known and finite; one other among them would leave no distance in its block to compare."""
    return df.where(F.forall(F.col("vec").cast("array<double>"), lambda x: F.abs(x) < float("inf")))


def _rows(df: DataFrame, group: str | None) -> DataFrame:
    """``(g, id, vec)`` of located rows in fixed types; a group is told by its hash, a null one is a group of its own."""
    g = F.xxhash64(F.lit(1), F.col(group)) if group else F.lit(0).cast("long")
    return located(df).select(g.alias("g"), F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))


def knn(queries: DataFrame, sources: DataFrame, k: int, *, group: str | None = None, block: int = 2048, small: int = SMALL, visited: list | None = None) -> DataFrame:
    """``(q, s, d2, place)``: the ``k`` sources nearest to each query ``(id, vec)``, exactly (ties: smaller id); equal ids are skipped.

    With ``group`` only equal groups meet; a query finds fewer than ``k`` where its
    group holds no more.  Rows whose vector is missing or not finite, whole or in part,
    find nothing and are not found.  Ids of queries are taken to be unique within a group.  A
    list ``visited`` is given both tables of visits, for audits.
    """
    held = written(_rows(sources, group))
    asked = _rows(queries, group)
    sizes = held.groupBy("g").agg(F.count(F.lit(1)).alias("_n"))
    stretches = lambda df: df.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / STRETCH).cast("int").alias("_stretches"))
    # a cell is told by 52 bits of its pivot's hash, which pandas keeps whole beside missing ones
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(7), "id", "vec"), 11) / float(1 << 53) < F.least(F.sqrt("_n"), F.lit(float(MOST_PIVOTS))) / F.col("_n")
    pivots = held.join(sizes.where(F.col("_n") > small), "g").where(drawn).groupBy("g", F.shiftrightunsigned(F.xxhash64("vec"), 12).alias("cell")).agg(F.first("vec").alias("vec"))
    pivots = written(pivots)
    cells = _in_cells(held, pivots, stretches(held))
    nearest = Window.partitionBy("g", "q").orderBy("d2", "s")
    ranked = lambda near: near.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k).select("q", "s", "d2", "place")
    if not pivots.limit(1).count():  # every group is one cell
        one = asked.join(sizes.select("g"), "g", "left_semi").withColumn("cell", F.lit(None).cast("long"))
        if visited is not None:
            visited.append(one)
        return ranked(_measured(one, held.withColumn("cell", F.lit(None).cast("long")), k, block))
    cells, asked = written(cells), written(asked)
    rings = cells.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("reach").alias("inner"), F.max("reach").alias("outer"))
    rings = written(rings.join(pivots, ["g", "cell"], "left"))
    spread = stretches(asked)
    one = written(_visits(asked, rings, spread, k, True))
    found = written(_measured(one, cells, k, block))
    bounds = found.withColumn("_p", F.row_number().over(nearest)).where(F.col("_p") == k).select("g", F.col("q").alias("id"), F.col("d2").alias("bound"))
    asked = written(asked.join(bounds, ["g", "id"], "left"))
    met = _visits(asked, rings, spread, k, False, True).groupBy("g").agg(F.sum("pairs").alias("_pairs"))
    many = asked.groupBy("g").agg(F.count(F.lit(1)).alias("_q")).join(met, "g").join(sizes, "g").where(F.col("_pairs") > F.col("_q") * F.col("_n") * SHARE)
    many = written(many.select("g"))
    few = lambda df: df.join(many, "g", "left_anti")
    two = written(_visits(few(asked), rings, spread, k, False))
    if visited is not None:
        visited += [one, two]
    found = few(found).unionByName(_measured(two, cells, k, block))
    if many.limit(1).count():
        whole = lambda df: df.join(many, "g", "left_semi").withColumn("cell", F.lit(0).cast("long"))
        found = found.unionByName(_measured(whole(asked), whole(held), k, ALL_BLOCK, ALL_PART))
    return ranked(found)
