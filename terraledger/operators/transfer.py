"""Estimates carried from places where values are known to others, by way and by climate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraledger.functions.expr import EARTH_KM, sphere
from terraledger.operators.neighbours import knn


def _finite(values: Column) -> Column:
    return F.forall(values, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))


def _place() -> Column:
    return F.array(*[c * EARTH_KM for c in sphere(F.col("lon"), F.col("lat"))])


def _complete(df: DataFrame, *arrays: str) -> DataFrame:
    """Rows with a known place and no unknown or non-finite member in the arrays."""
    known = _finite(F.array("lon", "lat"))
    for a in arrays:
        known = known & F.coalesce(_finite(F.col(a)), F.lit(False))
    return df.where(known)


def _spreads(sources: DataFrame, features: int, group: Sequence[str] = ()) -> DataFrame:
    """``(*group, scales)``: of each feature the spread over all sources, 0.1 at least; one row a group."""
    sums = [F.greatest(F.stddev_pop(F.get("climate", F.lit(j)).cast("double")), F.lit(0.1)) for j in range(features)]
    return sources.groupBy(*group).agg(F.array(*sums).alias("scales"))


def _unlike(features: int) -> Column:
    """The mean squared difference of two climates in spreads."""
    parts = [F.pow((F.get("_c", F.lit(j)) - F.get("climate", F.lit(j))) / F.get("scales", F.lit(j)), 2) for j in range(features)]
    return sum(parts, F.lit(0.0)) / features


def conditioned_kernel(targets: DataFrame, sources: DataFrame, *, features: int, values: int, strength: float, k: int = 12, radius_km: float = 600.0, width_km: float = 200.0) -> DataFrame:
    """``(id, estimate, donors)``: a weighted mean of the ``k`` nearest sources' ``values`` for each target.

    Sources are rows ``(id, lon, lat, climate, values)``, targets ``(id, lon, lat, climate)``;
    ids of the two are unlike, or an equal id is the same place and skipped.  A weight
    falls with the square of the way (straight through the globe, in ``width_km``) and
    with how unlike the climates are; beyond ``radius_km`` it is 0.  Zeros take part,
    sources with an unknown member don't.  A target with an unknown climate, or none of
    whose donors has weight, has no row.
    """
    held = _complete(sources, "climate", "values").select("id", "lon", "lat", "climate", "values")
    asked = _complete(targets, "climate")
    near = knn(asked.select("id", _place().alias("vec")), held.select("id", _place().alias("vec")), k)
    met = near.join(held.select(F.col("id").alias("s"), F.col("climate").alias("_c"), F.col("values").alias("_v")), "s").join(asked.select(F.col("id").alias("q"), "climate"), "q")
    met = met.join(F.broadcast(_spreads(held, features)))  # one row
    w = F.when(F.sqrt("d2") <= radius_km, F.exp(-strength * _unlike(features) - F.col("d2") / (2 * width_km * width_km))).otherwise(0.0)
    mean = F.array(*[F.sum(F.col("_w") * F.get("_v", F.lit(j))) / F.sum("_w") for j in range(values)])
    out = met.withColumn("_w", w).groupBy(F.col("q").alias("id")).agg(F.when(F.sum("_w") > 0, mean).alias("estimate"), F.count_if(F.col("_w") > 0).alias("donors"))
    return out.where("estimate is not null")


def strength_errors(sources: DataFrame, fold: Column, folds: int, *, features: int, values: int, strengths: Sequence[float], k: int = 12, radius_km: float = 600.0, width_km: float = 200.0) -> DataFrame:
    """``(strength, error, evaluated)``: how well each strength tells the values of one fold from the others.

    ``error`` is the root of the mean squared difference of ``log1p(value / median)``.
    All folds are searched at once: a source is a donor in each fold but its own.
    """
    held = _complete(sources, "climate", "values").withColumn("_fold", fold.cast("int")).withColumn("vec", _place())
    trained = held.withColumn("g", F.explode(F.array(*[F.lit(f) for f in range(folds)]))).where("g <> _fold")
    near = knn(held.select("id", "vec", F.col("_fold").alias("g")), trained.select("id", "vec", "g"), k, group="g")
    own = held.select(F.col("id").alias("q"), "climate", F.col("values").alias("_own"), F.col("_fold").alias("g"))
    met = near.join(held.select(F.col("id").alias("s"), F.col("climate").alias("_c"), F.col("values").alias("_v")), "s").join(own, "q")
    met = met.join(F.broadcast(_spreads(trained, features, ["g"])), "g")  # one row a fold
    medians = held.agg(*[F.greatest(F.percentile(F.get("values", F.lit(j)).cast("double"), 0.5), F.lit(1e-8)).alias(f"_m{j}") for j in range(values)])
    met = met.withColumn("_unlike", _unlike(features)).join(F.broadcast(medians)).withColumn("strength", F.explode(F.array(*[F.lit(float(s)) for s in strengths])))
    w = F.when(F.sqrt("d2") <= radius_km, F.exp(-F.col("strength") * F.col("_unlike") - F.col("d2") / (2 * width_km * width_km))).otherwise(0.0)
    mean = [F.sum(F.col("_w") * F.get("_v", F.lit(j))) / F.sum("_w") for j in range(values)]
    off = [F.pow(F.log1p(m / F.first(f"_m{j}")) - F.log1p(F.first(F.get("_own", F.lit(j))) / F.first(f"_m{j}")), 2) for j, m in enumerate(mean)]
    each = met.withColumn("_w", w).groupBy("q", "strength").agg(F.when(F.sum("_w") > 0, sum(off, F.lit(0.0)) / values).alias("_e"))
    return each.groupBy("strength").agg(F.sqrt(F.avg("_e")).alias("error"), F.count("_e").alias("evaluated"))


def group_median(points: DataFrame, k: int, *, group: str, value: str) -> DataFrame:
    """``(id, smoothed, used)``: the median of known values among a point and its ``k - 1`` nearest, as far as these lie in its group.

    Points are ``(id, x, y, group, value)``; the nearest are sought among all, so a
    point beside another group's has fewer of its own.  A missing group is a group
    of no other point; without a known value the result is missing.
    """
    where = points.select("id", F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("vec"))
    held = points.select(F.col("id").alias("s"), F.col(group).alias("_gs"), F.col(value).cast("double").alias("_v"))
    own = points.select(F.col("id").alias("q"), F.col(group).alias("_gq"))
    near = knn(where, where, k - 1).select("q", "s") if k > 1 else where.select(F.col("id").cast("long").alias("q"), F.col("id").cast("long").alias("s")).where("false")
    met = near.join(held, "s").join(own, "q").where("_gs = _gq").select(F.col("q").alias("id"), "_v")
    all_ = met.unionByName(points.select(F.col("id").cast("long").alias("id"), F.col(value).cast("double").alias("_v")))
    return all_.groupBy("id").agg(F.percentile("_v", 0.5).alias("smoothed"), F.count("_v").alias("used"))
