"""Weighted aggregation of cells to entities, and what is derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraledger.functions.expr import guarded

#: Keys of two sets that one task compares.
KEYS_A_PART = 1_000_000


def overlap_mean(overlap: DataFrame, cells: DataFrame, entity: str, cell: str, weight: str, value: str) -> DataFrame:
    """``(entity, mean_value, coverage, cells)``: the sparse matrix product as a join and one aggregation.

    Weights of one (entity, cell) are summed before the join, so a pair that
    repeats is shuffled once.
    """
    edges = overlap.groupBy(entity, cell).agg(F.sum(weight).alias("_w"), F.count(F.lit(1)).alias("_n"))
    known = F.when(F.col(value).isNotNull(), F.col("_w"))
    out = edges.join(cells.select(cell, value), cell).groupBy(entity).agg(
        F.sum(F.col("_w") * F.col(value)).alias("_s"), F.sum(known).alias("_k"), F.sum("_w").alias("_t"), F.sum("_n").alias("cells")
    )
    return out.select(entity, guarded(F.col("_s"), F.col("_k")).alias("mean_value"), guarded(F.coalesce("_k", F.lit(0.0)), F.col("_t"), 0.0).alias("coverage"), "cells")


def class_shares(rows: DataFrame, entity: str, label: str, weight: str) -> DataFrame:
    """``(entity, label, share)``."""
    sums = rows.groupBy(entity, label).agg(F.sum(weight).alias("_w"))
    return sums.select(entity, label, (F.col("_w") / F.sum("_w").over(Window.partitionBy(entity))).alias("share"))


def winner(shares: DataFrame, entity: str, label: str) -> DataFrame:
    """The label of the largest share, the first by name among equals."""
    top = shares.groupBy(entity).agg(F.max("share").alias("dominance"), F.collect_list(F.struct("share", label)).alias("_l"))
    return top.select(entity, F.array_min(F.transform(F.filter("_l", lambda x: x["share"] == F.col("dominance")), lambda x: x[label])).alias(label), "dominance", F.size("_l").cast("long").alias("classes"))


def order_statistics(rows: DataFrame, value: Column, at: Sequence[float]) -> list[float | None]:
    """Exact quantiles of all known values, by linear interpolation between order statistics.

    An approximate sketch brackets each quantile; one pass counts what lies below the
    bracket, and only the distinct values inside it, a few ten-thousandths of the rows,
    are put in order.  Null where nothing is known; NaN is unknown.
    """
    v = value.cast("double")
    known = rows.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n = known.count()
    if not n or not at:
        return [None] * len(at)
    slack = 2e-4
    while True:
        edges = [q for x in at for q in (max(0.0, x - slack), min(1.0, x + slack))]
        got = known.agg(F.percentile_approx("v", edges, 10_000).alias("e"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
        spans = [(got["lo"] if x - slack <= 0 else got["e"][2 * k], got["hi"] if x + slack >= 1 else got["e"][2 * k + 1]) for k, x in enumerate(at)]
        inside = F.array_compact(F.array(*[F.when((F.col("v") >= lo) & (F.col("v") <= hi), k) for k, (lo, hi) in enumerate(spans)]))
        below = known.agg(*[F.count_if(F.col("v") < lo).alias(f"b{k}") for k, (lo, _) in enumerate(spans)]).first()
        counts = known.select(F.explode(inside).alias("k"), "v").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("k").orderBy("v"))
        wanted = {(k, side): min(n - 1, int(x * (n - 1)) + side) for k, x in enumerate(at) for side in (0, 1)}
        places = F.array(*[F.array(*[F.lit(wanted[k, side] - below[k]) for side in (0, 1)]) for k in range(len(at))])
        ranked = counts.select("k", "v", "n", upto.alias("to")).withColumn("p", F.explode(F.get(places, F.col("k"))))
        found = {(r["k"], r["p"]): r["v"] for r in ranked.where((F.col("p") < F.col("to")) & (F.col("p") >= F.col("to") - F.col("n"))).collect()}  # two rows a quantile
        sides = [[found.get((k, wanted[k, side] - below[k])) for side in (0, 1)] for k in range(len(at))]
        if all(x is not None for pair in sides for x in pair):
            break
        slack *= 8
    out = []
    for (low, high), x in zip(sides, at, strict=True):
        part = x * (n - 1) - int(x * (n - 1))
        out.append(low if part == 0 else (1 - part) * low + part * high)
    return out


def quantile_bounds(rows: DataFrame, value: str, at: Sequence[float]) -> DataFrame:
    """One row with the array ``bounds``, by linear interpolation between exact order statistics."""
    return rows.sparkSession.createDataFrame([(order_statistics(rows, F.col(value), at),)], "bounds array<double>")


def average_rank(value: Column, *partition: str) -> Column:
    """Mean rank among equals."""
    order = Window.partitionBy(*partition).orderBy(value)
    same = Window.partitionBy(*partition, value)
    return F.rank().over(order) + (F.count(F.lit(1)).over(same) - 1) / 2


def median_impute(rows: DataFrame, value: str, group: str) -> DataFrame:
    """``filled`` and ``source``: the value, else its group's median, else the median of all."""
    per = rows.groupBy(group).agg(F.percentile(value, 0.5).alias("_g"))
    out = rows.join(per, group, "left").withColumn("_a", F.lit(order_statistics(rows, F.col(value), [0.5])[0]).cast("double"))
    source = F.when(F.col(value).isNotNull(), "own").when(F.col("_g").isNotNull(), "group").otherwise("all")
    return out.select(*rows.columns, F.coalesce(value, "_g", "_a").alias("filled"), source.alias("fill_source"))


def fit_metrics(rows: DataFrame, observed: str, predicted: str) -> DataFrame:
    """R2, MAE, RMSE, relative errors and bias in one pass, and quantiles of the errors."""
    y, p = F.col(observed), F.col(predicted)
    rel = F.abs(p - y) / F.greatest(y, F.lit(1e-12))
    known = rows.where(y.isNotNull() & p.isNotNull())
    middle, high = order_statistics(known, rel, [0.5, 0.9])
    return known.agg(
        F.count(F.lit(1)).alias("n"), (1 - F.sum((y - p) * (y - p)) / (F.var_pop(y) * F.count(F.lit(1)))).alias("r2"), F.avg(F.abs(p - y)).alias("mae"),
        F.sqrt(F.avg((p - y) * (p - y))).alias("rmse"), F.lit(middle).cast("double").alias("medape"), F.lit(high).cast("double").alias("p90"),
        F.avg((rel <= 0.2).cast("double")).alias("within20"), F.avg((rel <= 0.5).cast("double")).alias("within50"), F.avg(p - y).alias("bias"),
    )


def one_sided(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(id, side)``: rows of ``left(id)`` that ``right(id)`` lacks (``missing``, as often as they stand there), and ids of ``right`` that ``left`` lacks (``extra``, once); null matches nothing.

    Both sides meet in one aggregation dealt over as many parts as their rows ask
    for, so a task holds the same few keys however large the tables are, and no
    side is broadcast.
    """
    rows = left.select("id", F.lit(1).alias("_l")).unionByName(right.select("id", F.lit(0).alias("_l")))
    dealt = rows.repartition(-(-rows.count() // KEYS_A_PART) or 1, "id")
    apart = F.when(F.col("id").isNull(), F.col("_l"))  # a null of one side is not that of the other
    counted = dealt.groupBy("id", apart.alias("_apart")).agg(F.sum("_l").cast("int").alias("_left"), F.min("_l").alias("_least"))
    missing = counted.where("_least = 1").select("id", F.explode(F.array_repeat(F.lit("missing"), F.col("_left"))).alias("side"))
    return missing.unionByName(counted.where("_left = 0").select("id", F.lit("extra").alias("side")))
