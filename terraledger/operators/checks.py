"""Contract checks.  Each gives its violations as rows (none: the contract holds); ``refuse`` turns rows into an error."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def refuse(violations: DataFrame, what: str) -> None:
    """Raise with the first few rows where there is any."""
    rows = violations.limit(5).collect()
    if rows:
        raise ValueError(f"{what}: {[r.asDict() for r in rows]}")


def issues(frame: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """``(key, issue)``: a row for each rule that a row breaks; a rule that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    return frame.select(key, F.explode(broken).alias("issue"))


def finite(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < F.lit(float("inf"))) for c in columns])


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``(key, issue)``: keys that repeat on a side, or that one side lacks; null keys match nothing."""
    sides = [df.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
    both = sides[0].join(sides[1], key, "full_outer")
    return issues(both, key, {"left_missing": F.col("_l").isNotNull(), "left_repeats": F.coalesce("_l", F.lit(1)) == 1, "right_missing": F.col("_r").isNotNull(), "right_repeats": F.coalesce("_r", F.lit(1)) == 1})


def joined_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The inner join, after both sides have been found to hold the same keys once each."""
    refuse(one_to_one(left, right, key), f"{key} does not match one to one")
    return left.join(right, key)


def entity_contract(frame: DataFrame, key: str, expected: DataFrame, values: Sequence[str], identities: dict[str, Column]) -> DataFrame:
    """``(key, issue)``: a table must hold each expected key once, with finite values that satisfy the identities."""
    match = one_to_one(frame.select(key), expected.select(key), key).where("issue <> 'right_repeats'")
    names = F.when(F.col("issue") == "left_missing", "missing").when(F.col("issue") == "right_missing", "unknown").otherwise("repeated")
    rules = {f"not_finite:{v}": finite(v) for v in values} | identities
    return match.select(key, names.alias("issue")).unionByName(issues(frame, key, rules))


def close(a: Column, b: Column, relative: float = 1e-9, absolute: float = 1e-6) -> Column:
    return F.abs(a - b) <= absolute + relative * F.abs(b)


def target_order(natural: str, start: str, most: str, owned: Column) -> dict[str, Column]:
    """Rules of ordered targets: ``0 <= natural <= start <= most`` within a tolerance, and room where owned."""
    n, s, m = F.col(natural), F.col(start), F.col(most)
    slack = 1e-6 * F.greatest(F.abs(n), F.abs(s), F.abs(m), F.lit(1.0))
    return {"negative": n >= -slack, "start_below_natural": s >= n - slack, "most_below_start": m >= s - slack, "owned_without_room": ~owned | (m > 0)}


def ledger_rules(kinds: Sequence[str], totals: dict[str, Column]) -> dict[str, Column]:
    """Rules of typed ledgers with columns ``<stage>_<kind>``: not negative, summing to each stage's total, no kind falling from ``start`` to ``most``."""
    rules = {}
    for stage, total in totals.items():
        own = [F.col(f"{stage}_{k}") for k in kinds]
        rules[f"{stage}_negative"] = reduce(lambda a, b: a & b, [c >= -1e-9 for c in own])
        rules[f"{stage}_sum"] = F.abs(sum(own, F.lit(0.0)) - total) <= 1e-6 * F.greatest(F.abs(total), F.lit(1.0))
    falls = [F.col(f"most_{k}") >= F.col(f"start_{k}") - 1e-6 * F.greatest(F.abs(F.col(f"start_{k}")), F.lit(1.0)) for k in kinds]
    return rules | {"kind_falls": reduce(lambda a, b: a & b, falls)}


def assigned(cells: DataFrame, rules: DataFrame, cell: str, rule: str) -> tuple[DataFrame, DataFrame]:
    """``cells`` with the one rule that covers each, and the cells that several rules cover ``(cell, rules)``."""
    per = rules.groupBy(cell).agg(F.min(rule).alias(rule), F.count_distinct(rule).alias("_n"))
    return cells.join(per.where("_n = 1").drop("_n"), cell, "left"), per.where("_n > 1").select(cell, F.col("_n").alias("rules"))


def within_range(value: Column, low: Column, high: Column) -> Column:
    """Where a value lies against its benchmark: unresolved, below, inside or above."""
    return F.when(value.isNull() | low.isNull() | high.isNull(), "unresolved").when(value < low, "below").when(value > high, "above").otherwise("inside")


def reattributed(frame: DataFrame, total: Column, shares: dict[str, Column]) -> DataFrame:
    """``frame`` with each kind's part of ``total``, by non-negative shares; without any share the first kind takes all."""
    known = {k: F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)) for k, c in shares.items()}
    whole, first = sum(known.values(), F.lit(0.0)), next(iter(known))
    return frame.withColumns({k: F.when(whole > 0, total * c / whole).otherwise(total if k == first else F.lit(0.0)) for k, c in known.items()})
