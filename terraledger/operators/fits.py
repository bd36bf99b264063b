"""Fits on sufficient statistics: Spark sums, a small solver on what has a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_equations(rows: DataFrame, features: Sequence[Column], target: Column, weight: Column | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``X'WX`` and ``X'Wy`` with an intercept first, in one aggregation."""
    w = F.lit(1.0) if weight is None else weight
    x = [F.lit(1.0), *features]
    sums = [F.sum(w * x[i] * x[j]).alias(f"a{i}_{j}") for i in range(len(x)) for j in range(i + 1)] + [F.sum(w * v * target).alias(f"b{i}") for i, v in enumerate(x)]
    row = rows.agg(*sums).first()
    a = np.zeros((len(x), len(x)))
    for i in range(len(x)):
        for j in range(i + 1):
            a[i, j] = a[j, i] = row[f"a{i}_{j}"] or 0.0
    return a, np.array([row[f"b{i}"] or 0.0 for i in range(len(x))])


def ridge(rows: DataFrame, features: Sequence[Column], target: Column, penalty: float = 0.0, weight: Column | None = None) -> np.ndarray:
    a, b = normal_equations(rows, features, target, weight)
    return np.linalg.solve(a + penalty * np.diag([0.0] + [1.0] * len(features)) + 1e-12 * np.eye(len(b)), b)


def box_ridge(rows: DataFrame, features: Sequence[Column], target: Column, lower: Sequence[float], upper: Sequence[float], penalty: float = 1e-6, rounds: int = 2000) -> np.ndarray:
    """Bounded least squares by coordinate descent on the normal equations; the intercept is free."""
    a, b = normal_equations(rows, features, target)
    a = a + penalty * np.diag([0.0] + [1.0] * len(features))
    lo, hi = np.r_[-np.inf, lower], np.r_[np.inf, upper]
    x = np.clip(np.zeros(len(b)), lo, hi)
    for _ in range(rounds):
        moved = 0.0
        for k in range(len(b)):
            if a[k, k] > 0:
                new = min(max(x[k] + (b[k] - a[k] @ x) / a[k, k], lo[k]), hi[k])
                moved, x[k] = max(moved, abs(new - x[k])), new
        if moved < 1e-12:
            break
    return x


def balanced_folds(sizes: dict[str, int], folds: int) -> dict[str, int]:
    """Each group, largest first, to the fold that is least loaded (ties: smaller name, smaller fold)."""
    load, out = [0] * folds, {}
    for name, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        k = min(range(folds), key=lambda f: (load[f], f))
        out[name], load[k] = k, load[k] + n
    return out


def held_out(rows: DataFrame, fold: str, features: Sequence[Column], target: Column, penalty: float = 0.0) -> dict[int, np.ndarray]:
    """Coefficients (intercept first) for each fold, fitted on all others: sums of each fold in one pass, then differences."""
    x = [F.lit(1.0), *features]
    names = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    sums = [F.sum(x[i] * x[j]).alias(f"a{i}_{j}") for i, j in names] + [F.sum(v * target).alias(f"b{i}") for i, v in enumerate(x)]
    parts = {}
    for r in rows.groupBy(fold).agg(*sums).collect():  # a row a fold
        a = np.zeros((len(x), len(x)))
        for i, j in names:
            a[i, j] = a[j, i] = r[f"a{i}_{j}"] or 0.0
        parts[r[fold]] = a, np.array([r[f"b{i}"] or 0.0 for i in range(len(x))])
    whole = [sum(p[k] for p in parts.values()) for k in (0, 1)]
    ridge_ = penalty * np.diag([0.0] + [1.0] * len(features)) + 1e-12 * np.eye(len(x))
    return {f: np.linalg.solve(whole[0] - a + ridge_, whole[1] - b) for f, (a, b) in parts.items()}


def rounded_values(beta: Sequence[float], groups: Sequence[Sequence[int]], step: float) -> np.ndarray:
    """Coefficients rounded to ``step``; the intercept (first) then rises until no choice of one member a group is negative."""
    b = np.round(np.asarray(beta, float) / step) * step
    low = sum(min([0.0, *(b[i] for i in g)]) for g in groups)
    b[0] += step * max(0.0, np.ceil(-(b[0] + low) / step - 1e-9))
    return b


def sensible(beta: dict[str, float], *, at_most: dict[str, float] | None = None, falling: Sequence[Sequence[str]] = (), signs: dict[str, int] | None = None) -> list[str]:
    """What breaks the rules of a fit: values beyond a bound, chains that rise, signs that are wrong."""
    out = [f"bound:{k}" for k, v in sorted((at_most or {}).items()) if abs(beta.get(k, 0.0)) > v]
    out += [f"order:{a}>{b}" for chain in falling for a, b in zip(chain, chain[1:], strict=False) if beta.get(b, 0.0) > beta.get(a, 0.0) + 1e-9]
    return out + [f"sign:{k}" for k, v in sorted((signs or {}).items()) if beta.get(k, 0.0) * v < 0]
