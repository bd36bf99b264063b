"""Fits under rules: optimality, bounds on every combination, pruning, levels, and checks of written rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraledger.operators import ruled_fits as rf


def sample(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["warm", "cold", "mild"]), rng.choice(["low", "moderate", "high"]), rng.choice("abcd"), rng.gauss(0, 3)) for _ in range(n)]
    rows = [(c, f, x, 100 - 40 * (c == "cold") + 5 * (c == "mild") - 20 * (f == "low") + 30 * (f == "high") + e) for c, f, x, e in rows]
    return rows, spark.createDataFrame([*rows, (None, "low", "a", 1.0), ("warm", "low", "a", None), ("warm", "low", "a", float("nan"))], "climate string, fertility string, soil string, y double")


def matrix(rows, design):
    x = np.zeros((len(rows), len(design.names)))
    x[:, 0] = 1
    for i, r in enumerate(rows):
        for a, v in zip(design.attributes, r, strict=False):
            if (a, v) in design.index:
                x[i, design.index[a, v]] = 1
    return x, np.array([r[3] for r in rows])


def test_gram_is_that_of_the_rows(spark):
    rows, df = sample(spark)
    design = rf.one_hot(df, ["climate", "fertility", "soil"], F.col("y"), {"climate": "warm", "fertility": "moderate"})
    x, y = matrix(rows, design)
    a, b, yy = rf.gram(design)
    assert a == pytest.approx(x.T @ x) and b == pytest.approx(x.T @ y) and yy == pytest.approx(y @ y)
    effects = rf.fit(design, a, b, penalty=0.0)
    assert effects == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0], abs=1e-6)
    said = {(r.climate, r.fertility, r.soil): r.p for r in df.select("climate", "fertility", "soil", design.predicted(effects).alias("p")).distinct().collect()}
    assert said[None, "low", "a"] is None and all(said[r[:3]] == pytest.approx(v) for r, v in zip(rows, x @ effects, strict=True))
    with pytest.raises(ValueError, match="too many"):
        rf.one_hot(spark.range(500), ["id"], F.col("id"))
    empty = rf.one_hot(df.limit(0), ["climate"], F.col("y"))
    assert empty.names == [("", "")] and rf.fit(empty, *rf.gram(empty)[:2])[0] == 0


@pytest.mark.parametrize("seed", range(6))
def test_solutions_are_optimal(seed):
    rng = np.random.RandomState(seed)
    x = rng.randn(60, 6)
    a, b = x.T @ x, x.T @ rng.randn(60) * 3
    rows, limits = rng.randn(9, 6), rng.rand(9) * 0.3
    rows, limits = np.vstack([rows, rows[0]]), np.r_[limits, limits[0]]  # a rule that stands twice
    got, m = rf.solve(a, b, rows, limits)
    slack = limits - rows @ got
    assert slack.min() > -1e-6 and m.min() >= 0 and np.abs(m * slack).max() < 1e-5 * (1 + m.max())
    assert a @ got - b + rows.T @ m == pytest.approx(np.zeros(6), abs=1e-5)


def test_rules_bind_where_they_should(spark):
    rows, df = sample(spark)
    design = rf.one_hot(df, ["climate", "fertility", "soil"], F.col("y"), {"climate": "warm", "fertility": "moderate", "soil": "a"})
    a, b, _ = rf.gram(design)
    rules = rf.Rules(design)
    rules.span("climate", -10, 10)
    rules.order("fertility", ["low", "moderate", "absent", "high"], gap=35.0)
    rules.intercept(20, 300)
    x = rf.fit(design, a, b, rules)
    at = lambda n, v: x[design.index[n, v]]
    assert at("climate", "cold") == pytest.approx(-10, abs=1e-6) and at("fertility", "low") <= -35 + 1e-6 and at("fertility", "high") >= 35 - 1e-6
    held = rf.fit(design, a, b, floor=60.0, ceiling=120.0)
    sums = [held[0] + sum(held[k] for k in choice if k is not None) for choice in itertools.product(*[[None, *g] for g in design.groups()])]
    assert min(sums) >= 60 - 1e-5 and max(sums) <= 120 + 1e-5
    # no better effects lie near: the bounds hold for each step and the loss doesn't fall
    loss = lambda v: v @ a @ v / 2 - b @ v
    rng = np.random.RandomState(0)
    for _ in range(300):
        step = held + rng.randn(len(held)) * 0.05
        s = [step[0] + sum(step[k] for k in choice if k is not None) for choice in itertools.product(*[[None, *g] for g in design.groups()])]
        assert min(s) < 60 - 1e-9 or max(s) > 120 + 1e-9 or loss(step) >= loss(held) - 1e-4


def test_pruning_and_levels(spark):
    rows, df = sample(spark)
    rare = df.unionByName(spark.createDataFrame([("warm", "low", "zz", 80.0)], df.schema))
    design = rf.one_hot(rare, ["climate", "fertility", "soil"], F.col("y"), {"climate": "warm", "fertility": "moderate", "soil": "a"})
    a, b, _ = rf.gram(design)
    x, dropped = rf.pruned(design, a, b, least_rows=3, least_effect=2.0)
    assert ("soil", "zz") in dropped and {n for n, _ in dropped} == {"soil"} and len(dropped) == 4
    kept = rf.one_hot(rare.where("soil <> 'zz'"), ["climate", "fertility"], F.col("y"), {"climate": "warm", "fertility": "moderate"})
    assert [x[design.index[n]] for n in kept.names[1:]] == pytest.approx(rf.fit(kept, *rf.gram(kept)[:2])[1:], abs=1.0)
    low = x.copy()
    low[0] -= 17
    assert a[0] @ rf.levelled(low, a, b) == pytest.approx(b[0]) and rf.levelled(low, a, b, high=50.0)[0] == 50.0
    # a fold's sums are the whole's less its own
    part = rf.one_hot(df.withColumn("fold", F.length("climate") % 2), ["climate", "fertility"], F.col("y"), by=["fold"])
    whole, one = rf.gram(part), rf.gram(part, F.col("fold") == 1)
    assert whole[0] - one[0] == pytest.approx(rf.gram(part, F.col("fold") == 0)[0])


def test_written_rows_are_checked(spark):
    rows = spark.createDataFrame([("g", "soil", "x", -0.5), ("g", "soil", "y", 0.5), ("g", "soil", "z", -0.001), ("g", "class", "a", 0.1), ("g", "class", "b", 0.1), ("g", "class", "c", -0.1), ("h", "class", "a", 0.5), ("h", "water", "w", 0.3), ("h", "water", "v", None)], "good string, feature string, value string, coef double")
    signs = spark.createDataFrame([("soil", None, "+"), ("water", None, "0")], "feature string, value string, sign string")
    classes = spark.createDataFrame([("g", "class", "a", "core"), ("g", "class", "b", "core"), ("g", "class", "c", "unfit"), ("h", "class", "a", "core"), ("h", "class", "a", "core")], "good string, feature string, value string, class string")
    got = sorted(tuple(r) for r in rf.row_violations(rows, signs, classes, gaps=[("core", "unfit", 0.3)], highest={"unfit": -0.2}).collect())
    assert got == [("g", "class", "a", "core not 0.3 over unfit c"), ("g", "class", "c", "unfit over -0.2"), ("g", "soil", "x", "negative"), ("h", "water", "w", "no row expected")]
    assert rf.row_violations(rows.limit(0), signs, classes, gaps=[("core", "unfit", 0.3)]).count() == 0
