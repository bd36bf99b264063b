"""Additive fits of attributes under rules: signs, spans, orders, gaps, and bounds on every combination.

Spark collapses the rows to profiles (one a combination of attributes that
occurs, with counts and sums) and these to the Gram matrix, whose size is the
attributes' values and not the data's.  The rules are linear in the effects, so
what is left is a small convex program: its dual is climbed coordinate by
coordinate, then the rules that bind are solved as equations.  Bounds on all
combinations are added one broken combination at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of an attribute beyond which it is no class.
MOST_VALUES = 200


@dataclass
class Design:
    """Effects of attribute values against a reference value each; the first effect is the intercept."""

    attributes: list[str]
    references: dict[str, str]
    names: list[tuple[str, str]]
    profiles: DataFrame
    index: dict[tuple[str, str], int] = field(init=False)

    def __post_init__(self) -> None:
        self.index = {n: k for k, n in enumerate(self.names)}

    def groups(self) -> list[list[int]]:
        return [[k for k, (a, _) in enumerate(self.names) if a == attribute] for attribute in self.attributes]

    def active(self) -> Column:
        """The places of the effects that a row has."""
        at = [F.create_map(*[x for (a, v), k in self.index.items() if a == attribute for x in (F.lit(v), F.lit(k))]) if any(a == attribute for a, _ in self.names) else None for attribute in self.attributes]
        found = [F.try_element_at(m, F.col(a).cast("string")) for m, a in zip(at, self.attributes, strict=True) if m is not None]
        return F.array_compact(F.array(F.lit(0), *found))

    def predicted(self, effects: Sequence[float]) -> Column:
        """The sum of a row's effects; missing where an attribute is."""
        held = F.array(*[F.lit(float(x)) for x in effects])
        total = F.aggregate(self.active(), F.lit(0.0), lambda a, k: a + F.get(held, k))
        known = F.lit(True)
        for a in self.attributes:
            known = known & F.col(a).isNotNull()
        return F.when(known, total)


def one_hot(rows: DataFrame, attributes: Sequence[str], target: Column, references: dict[str, str] | None = None, by: Sequence[str] = ()) -> Design:
    """The design of the rows' attributes; a reference that isn't given is the most frequent value (ties: the smallest).

    Rows with a missing attribute or target are left out.  ``by`` (a fold) parts the
    profiles further.  More than ``MOST_VALUES`` values of an attribute raise.
    """
    known = target.isNotNull() & ~F.isnan(target.cast("double"))
    for a in attributes:
        known = known & F.col(a).isNotNull()
    text = [F.col(a).cast("string").alias(a) for a in attributes]
    profiles = rows.where(known).select(*by, *text, target.cast("double").alias("_y")).groupBy(*by, *attributes).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y"), F.sum(F.col("_y") * F.col("_y")).alias("yy"))
    names, refs = [("", "")], {}
    for a in attributes:
        values = sorted((-r["n"], r[a]) for r in profiles.groupBy(a).agg(F.sum("n").alias("n")).limit(MOST_VALUES + 1).collect())
        if len(values) > MOST_VALUES:
            raise ValueError(f"{a} has too many values for a class")
        refs[a] = (references or {}).get(a, values[0][1] if values else "")
        names += [(a, v) for v in sorted(v for _, v in values) if v != refs[a]]
    return Design(list(attributes), refs, names, profiles)


def gram(design: Design, where: Column | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """``X'X``, ``X'y`` and ``y'y`` of the rows behind the profiles: at most as many sums as pairs of effects reach the driver."""
    rows = design.profiles if where is None else design.profiles.where(where)
    rows = rows.select(design.active().alias("i"), "n", "y", "yy")
    p = len(design.names)
    a, b = np.zeros((p, p)), np.zeros(p)
    pairs = rows.select(F.explode("i").alias("i"), F.col("i").alias("j"), "n", "y")
    for r in pairs.select("i", F.explode("j").alias("j"), "n").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        a[r["i"], r["j"]] = r["n"]
    for r in pairs.groupBy("i").agg(F.sum("y").alias("y")).collect():
        b[r["i"]] = r["y"]
    return a, b, float(rows.agg(F.sum("yy")).first()[0] or 0.0)


class Rules:
    """Rows ``a . effects <= h``, with names."""

    def __init__(self, design: Design):
        self.design, self.rows, self.limits, self.names = design, [], [], []

    def add(self, name: str, parts: dict[tuple[str, str], float], limit: float) -> None:
        row = np.zeros(len(self.design.names))
        for n, w in parts.items():
            if n in self.design.index:  # a reference has the effect 0
                row[self.design.index[n]] += w
        if np.any(row):
            self.rows.append(row)
            self.limits.append(float(limit))
            self.names.append(name)

    def span(self, attribute: str, low: float, high: float, value: str | None = None) -> None:
        for a, v in list(self.design.index):
            if a == attribute and value in (None, v):
                self.add(f"low:{a}:{v}", {(a, v): -1.0}, -low)
                self.add(f"high:{a}:{v}", {(a, v): 1.0}, high)

    def intercept(self, low: float, high: float) -> None:
        self.add("low:intercept", {("", ""): -1.0}, -low)
        self.add("high:intercept", {("", ""): 1.0}, high)

    def order(self, attribute: str, values: Sequence[str], gap: float = 0.0) -> None:
        """Each value at least ``gap`` over the one before; values that don't occur are passed over."""
        there = [v for v in values if (attribute, v) in self.design.index or v == self.design.references.get(attribute)]
        for lower, upper in zip(there, there[1:], strict=False):
            self.add(f"order:{attribute}:{lower}:{upper}", {(attribute, lower): 1.0, (attribute, upper): -1.0}, -gap)


def solve(a: np.ndarray, b: np.ndarray, rows: np.ndarray, limits: np.ndarray, *, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """The minimum of ``x'ax / 2 - b'x`` under ``rows x <= limits``, and the rules' multipliers."""
    free = np.linalg.solve(a, b)
    if not len(rows):
        return free, np.zeros(0)
    back = np.linalg.solve(a, rows.T)
    q, d = rows @ back, rows @ free - limits
    m, diagonal = np.zeros(len(rows)), np.maximum(np.diag(q), 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for k in range(len(rows)):
            new = max(0.0, m[k] + (d[k] - q[k] @ m) / diagonal[k])
            moved, m[k] = max(moved, abs(new - m[k]) * diagonal[k]), new
        if moved <= 1e-13 * (1 + np.abs(d).max()):
            break
    # the rules that bind, as equations: sharpens the last digits, and is kept only where nothing else breaks
    bind = np.flatnonzero(m > 1e-9 * (1 + m.max()))
    if len(bind):
        sharp = np.zeros(len(rows))
        sharp[bind] = np.linalg.lstsq(q[np.ix_(bind, bind)], d[bind], rcond=None)[0]
        x = free - back @ sharp
        if sharp.min() >= 0 and (rows @ x - limits).max() <= 1e-7 * (1 + np.abs(limits).max()):
            m = sharp
    return free - back @ m, m


def _extreme(effects: np.ndarray, groups: list[list[int]], sign: float) -> tuple[float, np.ndarray]:
    """The greatest (or least) sum that one value of each attribute can give, and which effects it has."""
    row = np.zeros(len(effects))
    row[0] = 1.0
    for g in groups:
        best = max(g, key=lambda k: sign * effects[k], default=None)
        if best is not None and sign * effects[best] > 0:
            row[best] = 1.0
    return float(row @ effects), row


def fit(design: Design, a: np.ndarray, b: np.ndarray, rules: Rules | None = None, *, penalty: float = 1e-9, floor: float | None = None, ceiling: float | None = None, fixed: Sequence[int] = ()) -> np.ndarray:
    """Effects of least squares under the rules, with every combination of values, seen or not, between ``floor`` and ``ceiling``.

    Effects in ``fixed`` are 0; the penalty is on all but the intercept.
    """
    keep = [k for k in range(len(b)) if k not in set(fixed)]
    rows = [r for r in (rules.rows if rules else [])]
    limits = list(rules.limits if rules else [])
    shrunk = a + penalty * max(1.0, a[0, 0]) * np.diag([0.0] + [1.0] * (len(b) - 1)) + 1e-12 * max(1.0, a[0, 0]) * np.eye(len(b))
    groups = design.groups()
    scale = 1.0 + abs(b[0]) / max(1.0, a[0, 0])
    while True:
        x = np.zeros(len(b))
        own = np.array(rows).reshape(len(rows), len(b))[:, keep]
        some = np.flatnonzero(np.any(own != 0, axis=1))
        x[keep], _ = solve(shrunk[np.ix_(keep, keep)], b[keep], own[some], np.array(limits)[some])
        added = False
        for limit, sign in ((floor, -1.0), (ceiling, 1.0)):
            if limit is None:
                continue
            worst, row = _extreme(x, groups, sign)
            if sign * (worst - limit) > 1e-9 * scale and not any(np.array_equal(sign * row, r) for r in rows):
                rows.append(sign * row)
                limits.append(sign * limit)
                added = True
        if not added:
            return x


def pruned(design: Design, a: np.ndarray, b: np.ndarray, rules: Rules | None = None, *, least_rows: float = 0, least_effect: float = 0.0, **how) -> tuple[np.ndarray, list[tuple[str, str]]]:
    """A fit without effects of too few rows or too small a size, and the names of those dropped.

    The smallest effect goes first and the rest is fitted anew, until all that stay
    are large enough.
    """
    fixed = [k for k in range(1, len(b)) if a[k, k] < least_rows]
    while True:
        x = fit(design, a, b, rules, fixed=fixed, **how)
        small = [k for k in range(1, len(b)) if k not in fixed and abs(x[k]) < least_effect]
        if not small:
            return x, [design.names[k] for k in sorted(fixed)]
        fixed.append(min(small, key=lambda k: (abs(x[k]), k)))


def levelled(x: np.ndarray, a: np.ndarray, b: np.ndarray, low: float = -np.inf, high: float = np.inf) -> np.ndarray:
    """Effects whose mean prediction is the mean of the target, as far as the intercept's bounds allow."""
    out = x.copy()
    if a[0, 0]:
        out[0] = min(max(x[0] + (b[0] - a[0] @ x) / a[0, 0], low), high)
    return out


def row_violations(rows: DataFrame, signs: DataFrame, classes: DataFrame, *, gaps: Sequence[tuple[str, str, float]], highest: dict[str, float] | None = None, slack: float = 0.011, least: float = 0.005) -> DataFrame:
    """``(good, feature, value, problem)``: written coefficients ``(good, feature, value, coef)`` that break a rule.

    ``signs(feature, value, sign)`` says ``+``, ``-`` or ``0`` (no row at all) of a value, or
    of a feature's other values where ``value`` is null; ``classes(good, feature, value, class)`` sorts
    the values of a feature, which then has no sign; a class must lie ``gap`` over another
    (``gaps``: upper, lower, gap), and under a limit (``highest``).  Of classes that lie
    wrongly the values that lie farthest wrong are named.
    """
    sorted_ = classes.select("good", "feature", "value", "class").distinct()
    held = rows.join(sorted_, ["good", "feature", "value"], "left")
    own = signs.where("value is not null").select("feature", "value", F.col("sign").alias("_own"))
    rest = signs.where("value is null").select("feature", F.col("sign").alias("_rest"))
    told = held.where("class is null").join(own, ["feature", "value"], "left").join(rest, "feature", "left").withColumn("_sign", F.coalesce("_own", "_rest")).where(F.abs("coef") >= least)
    wrong = F.when(F.col("_sign") == "0", "no row expected").when((F.col("_sign") == "+") & (F.col("coef") < 0), "negative").when((F.col("_sign") == "-") & (F.col("coef") > 0), "positive")
    out = told.select("good", "feature", "value", wrong.alias("problem")).where("problem is not null")
    ends = held.where("class is not null").groupBy("good", "feature", "class").agg(F.min(F.struct("coef", "value")).alias("lo"), F.max(F.struct("coef", "value")).alias("hi"))
    for name, limit in (highest or {}).items():
        over = ends.where((F.col("class") == name) & (F.col("hi.coef") > limit + 1e-9))
        out = out.unionByName(over.select("good", "feature", F.col("hi.value").alias("value"), F.lit(f"{name} over {limit}").alias("problem")))
    for upper, lower, gap in gaps:
        top = ends.where(F.col("class") == upper).select("good", "feature", "lo")
        low = ends.where(F.col("class") == lower).select("good", "feature", F.col("hi").alias("under"))
        near = top.join(low, ["good", "feature"]).where(F.col("lo.coef") - F.col("under.coef") < gap - slack)
        out = out.unionByName(near.select("good", "feature", F.col("lo.value").alias("value"), F.concat(F.lit(f"{upper} not {gap} over {lower} "), F.col("under.value")).alias("problem")))
    return out
