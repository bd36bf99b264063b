"""Every rule with each of its inputs missing in turn: the result is missing too, or what the rule says of it."""

import pytest
from pyspark.sql import functions as F

from terraledger.functions import expr, rules

V = F.lit


def nothing():
    return F.lit(None).cast("double")


def args(*values):
    return [float(v) for v in values]


#: A rule, sound inputs, and the inputs (by place) that it can do without.
CASES = {
    "gain": (lambda *x: rules.gain(*x), args(5, 2, 3), ()),
    "food_energy": (lambda m: rules.food_energy(m, 3.0, 0.9, 0.9), args(5), ()),
    "labour_days": (lambda a, b: rules.labour_days(30, a, b, 2), args(0.5, 0.4), ()),
    "rotation_fraction": (rules.rotation_fraction, args(1, 2), ()),
    "bands": (lambda x: rules.bands(x, 0.1)[0], args(4), ()),
    "effective_score": (rules.effective_score, args(1, 2, 0.5), (0,)),  # without a dry score the watered one
    "care_now": (lambda *x: rules.maintained_base(*x)["care_now"], args(0.5, 0.4, 0.1, 0.2, 1, 3, 5, 1), (2, 3, 6, 7)),
    "water_most": (lambda *x: rules.maintained_base(*x)["water_most"], args(0.5, 0.4, 0.1, 0.2, 1, 3, 5, 1), (1, 2)),
    "start_clearing": (lambda *x: rules.attribution(*x)["start_clearing"], args(0.1, 0.4, 0.6, 0.1, 0.2, 3, 5, 1, 2), (2, 3, 4, 5, 6)),
    "rest_water": (lambda *x: rules.attribution(*x)["rest_water"], args(0.1, 0.4, 0.6, 0.1, 0.2, 3, 5, 1, 2), (0, 1, 2, 8)),
    "upper": (lambda *x: rules.cell_support(*x)["upper"], args(0.1, 0.4, 0.6, 0.1, 0.2, 2, 3, 5, 1, 0.1, 0.05), (1, 3)),
    "units": (lambda *x: rules.support_values(*x, 0.5, 2.0)["units"], args(1, 2, 3, 1), ()),
    "inherited": (lambda *x: rules.inherited(*x, 0.5), args(0.6, 0.3, 0.4, 0.1), ()),
    "inherited without a gap": (lambda *x: rules.inherited(*x, 0.5), args(0.6, 0.3, 0, 0), ()),
    "tapered": (lambda a, c, e: rules.tapered(a, c, e, V(True), 0.2, 0.6), args(0.6, 0.3, 0.4), ()),
    "tapered elsewhere": (lambda a, c, e: rules.tapered(a, c, e, V(False), 0.2, 0.6), args(0.6, 0.3, 0.4), ()),
    "command_fraction": (lambda f, k: rules.command_fraction(f, k, 30.0, V(True)), args(0.5, 3), ()),
    "command_fraction elsewhere": (lambda f, k: rules.command_fraction(f, k, 30.0, V(False)), args(0.5, 3), ()),
    "seasonal_response": (lambda *x: rules.seasonal_response(*x, 0.3), args(1, 2, 0.5), ()),
    "seasonal_response at rest": (lambda *x: rules.seasonal_response(*x, 0.3), args(1, 0, 0.5), ()),
    "added": (lambda *x: rules.dry_fields(*x, 0.5)[0], args(0.5, 0.1, 0.3, 1, 3, 1, 2), (2, 4)),
    "displaced": (lambda *x: rules.dry_fields(*x, 0.5)[1], args(0.5, 0.1, 0.3, 1, 3, 1, 2), ()),
    "inferred_water": (lambda *x: rules.inferred_water(*x, 0.5), args(0.5, 0.1, 0.3, 0, 3, 0), ()),
    "mixed_mean": (lambda own, a, b: rules.mixed_mean(own, [a, b], 0.5)[0], args(1, 2, 3), (1, 2)),  # missing alternatives are none
    "transfers": (lambda c, m, s, w: rules.transfers(c, m, {"x": s}, {"x": (0.2, 0.3)}, w)["x"], args(1, 2, 0.5, 1), ()),
    "base_requests": (lambda b, c, a, u, s: rules.base_requests(b, c, a, u, {"x": s}, {"x": 0.5})["x"], args(1, 0.5, 3, 2, 0.4), ()),
    "base_requests without land": (lambda b, c, a, u, s: rules.base_requests(b, c, a, u, {"x": s}, {"x": 0.5})["x"], args(1, 0.5, 0, 2, 0.4), ()),
    "protected_transfer": (lambda b, r, f: rules.protected_transfer(b, {"x": r}, f)[0]["x"], args(3, 1, 1), ()),
    "digitized": (lambda x: rules.digitized(x, [1.0], [0.0, 1.0]), args(2), ()),
    "limited_score": (lambda a, r, m: rules.limited_score(a, r, 0.5, [(m, 2.0, 1.0)]), args(3, 4, 1), ()),
    "limited_score at its cap": (lambda a, r, m: rules.limited_score(a, r, 0.5, [(m, 2.0, 1.0)]), args(3, 4, 5), ()),
    "later_wins": (lambda a: rules.later_wins(V("base"), [(a > 5, "much")]), args(3), ()),
    "argmax_label": (lambda a, b: rules.argmax_label({"a": a, "b": b}), args(1, 2), (0, 1)),  # the largest of those known
    "allowance": (lambda p, c: rules.allowance(p, 10.0, c, V(True)), args(300, 4), ()),
    "decayed_access": (lambda b, k, t: rules.decayed_access(V(True), b, 0.1, 0.6, k, 20.0, t), args(0.9, 3, 1), (1,)),  # no way: no river
    "raised_reference": (lambda r, d: rules.raised_reference(r, V(True), d), args(3, 4), (1,)),  # an unknown density lifts nothing
    "crop": (lambda c, p, w: rules.exclusive(c, p, {"x": w})["rest"], args(0.3, 0.3, 0.1), ()),
    "pasture": (lambda c, p, w: rules.exclusive(c, p, {"x": w})["pasture"], args(0.3, 0.3, 0.1), (2,)),
    "ratio": (expr.ratio, args(1, 2), ()),
    "ratio to nothing": (expr.ratio, args(1, 0), ()),
    "guarded": (lambda a, b: expr.guarded(a, b, 1.0), args(1, 0), ()),
    "scale_yield": (lambda y: expr.scale_yield(y, 1.1, 0.9, 3.0), args(2), ()),
    "position": (expr.position, args(2, 1, 3), ()),
    "activation": (lambda m, h: expr.activation(m, h, 0.2), args(0.5, 0.4), ()),
    "best": (expr.best, args(1, 2), ()),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_missing_inputs_give_missing_results(spark, name):
    rule, values, spared = CASES[name]
    values = list(map(F.lit, values))
    columns = [rule(*values)] + [rule(*[nothing() if k == j else v for k, v in enumerate(values)]) for j in range(len(values))]
    whole, *lacking = spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    assert whole is not None
    assert [k for k, v in enumerate(lacking) if v is not None] == list(spared)


def test_unknown_conditions_decide_nothing(spark):
    no, N = F.lit(None).cast("boolean"), nothing()
    cells = [
        rules.scenario_factor(no, V(1.0), V(2.0)), rules.tapered(V(0.6), V(0.3), V(0.4), no, 0.2, 0.6), rules.command_fraction(V(0.5), V(1.0), 9.0, no), rules.allowance(V(90.0), 3.0, V(1.0), no),
        rules.decayed_access(no, V(0.5), 0.1, 0.5, V(1.0), 9.0, V(1.0)), rules.raised_reference(V(1.0), no, V(2.0)), rules.later_wins(V("a"), [(V(True), "b"), (no, "c")]), rules.argmax_label({"a": N, "b": N}),
    ]
    assert set(spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(cells)]).first()) == {None}
    # what a later rule decides needs no earlier one; what doesn't apply needs no numbers
    assert tuple(spark.range(1).select(rules.later_wins(V("a"), [(no, "b"), (V(True), "c")]), rules.allowance(N, 3.0, N, V(False))).first()) == ("c", 0.0)


def test_seasons_with_unknown_months(spark):
    N = nothing()
    months = lambda *x: F.array(*[F.lit(v) if v is not None else F.lit(None).cast("boolean") for v in x])
    numbers = lambda *x: F.array(*[F.lit(v) if v is not None else N for v in x])
    need = lambda a, d, extra=V(1.0): rules.seasonal_demand(a, d, 10.0, extra)
    got = spark.range(1).select(
        need(months(True, False, True), numbers(3.0, 9.0, 7.0)).alias("a"), need(months(True, None, True), numbers(3.0, 9.0, 7.0)).alias("b"),
        need(months(True, False, True), numbers(None, None, 7.0)).alias("c"), need(months(True, False), numbers(3.0, 9.0), N).alias("d"),
        expr.clamp_fold(numbers(60.0, None, 5.0), V(0.0), 0.0, 100.0).alias("e"), expr.cycle_start(numbers(1.0, None), 0.0, 9.0).alias("f"), expr.snow_start(numbers(1.0, None)).alias("g"),
    ).first()
    assert got.a == [6.0, 0.0, 8.0] and got.b == [None] * 3 and got.c == [None, None, 8.0] and got.d == [None] * 2
    assert got.e == [60.0, None, None] and got.f is None and got.g is None


def test_refused_inputs_have_names(spark):
    got = spark.range(1).select(
        rules.activation_faults(V(1.2), nothing(), 0.0).alias("a"), rules.activation_faults(V(0.2), V(1.0), 0.5).alias("b"), rules.inherited_faults(V(0.5), V(0.5), V(-0.1), V(0.0), 0.5).alias("c"),
        rules.demand_faults(F.array(V(False), V(False)), F.array(V(1.0)), 5.0, V(-1.0)).alias("d"), rules.demand_faults(F.array(V(True), V(False)), F.array(V(1.0), V(2.0)), 5.0, V(0.0)).alias("e"),
        rules.transfer_faults(V(1.0), V(2.0), {"x": V(0.8), "y": V(0.7)}, {"x": (1.0, 0.1), "y": (1.0, 0.1)}, V(1.0)).alias("f"), rules.dry_field_faults(V(0.5), V(0.6), V(0.2), 0.5).alias("g"),
    ).first()
    assert got.a == ["half", "maximum", "extent"] and got.b == [] and got.c == ["crop_gap"] and got.d == ["length", "extra", "season"] and got.e == [] and got.f == ["clearing"] and got.g == ["served", "full"]
