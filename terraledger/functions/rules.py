"""Rules of fields, water and classes as Column expressions.  A missing input gives a missing result unless a rule says otherwise."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraledger.functions.expr import all_known, best, clip, guarded, least_known


def gain(better: Column, *others: Column) -> Column:
    """What ``better`` yields beyond the best of ``others``, never negative."""
    other = others[0] if len(others) == 1 else F.greatest(*others)
    return F.when(all_known(better, *others), F.greatest(better - other, F.lit(0.0)))


def positive(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def food_energy(mass: Column, kcal: float, recovery: float, retention: float, harvests: float = 1.0, fraction: float = 1.0) -> Column:
    if not all(0 <= x <= 1 for x in (recovery, retention, fraction)) or kcal <= 0 or harvests <= 0:
        raise ValueError("fractions lie in 0 to 1, energy and harvests are positive")
    return mass * (kcal * recovery * retention * harvests * fraction)


def labour_days(days: float, frequency: Column, fraction: Column, upkeep: float) -> Column:
    if days <= 0 or upkeep < 0:
        raise ValueError("days are positive and upkeep is not negative")
    return days * frequency * fraction + upkeep


def scenario_factor(low_input: Column, low: Column, high: Column, cultivar: float = 1.0, management: float = 1.0) -> Column:
    return F.when(low_input, low).when(~low_input, high) * (cultivar * management)


def rotation_fraction(crop: Column, fallow: Column) -> Column:
    return F.when((crop > 0) & (fallow >= 0), crop / (crop + fallow))


def bands(x: Column, *uncertain: float) -> tuple[Column, Column]:
    """Low and high: each uncertainty narrows or widens in turn."""
    return reduce(lambda v, u: v * (1 - u), uncertain, x), reduce(lambda v, u: v * (1 + u), uncertain, x)


def effective_score(rain: Column, watered: Column, weight: Column) -> Column:
    """Lifted from the dry score towards the watered one; without a dry score the watered one."""
    return F.when(rain.isNull(), watered).otherwise(rain + weight * (watered - rain))


def maintained_base(base: Column, historical: Column, served: Column, full: Column, base_dry: Column, dry: Column, wet: Column, wild: Column) -> dict[str, Column]:
    """Management of land that was in use before, and what its irrigation is corrected by."""
    care = gain(dry, base_dry)
    excess = gain(wet, dry, base_dry, wild) - gain(wet, dry, wild)
    return {"care_now": least_known(base, historical) * care, "care_most": base * care, "water_now": least_known(served, base) * excess, "water_most": least_known(full, base) * excess}


def attribution(base: Column, start: Column, most: Column, served: Column, full: Column, dry: Column, wet: Column, wild: Column, low: Column) -> dict[str, Column]:
    """Gains in order: land cleared at low input, then management (signed), then water."""
    opened = positive(start - base)
    extra = positive(most - base) - opened
    cleared, managed, watered = gain(low, wild), gain(dry, wild) - gain(low, wild), gain(wet, dry, wild)
    return {"start_clearing": opened * cleared, "start_management": opened * managed, "start_water": served * watered, "rest_clearing": extra * cleared, "rest_management": extra * managed, "rest_water": (full - served) * watered}


def cell_support(base_share: Column, start: Column, most: Column, served: Column, full: Column, base_dry: Column, dry: Column, wet: Column, wild: Column, added: Column, displaced: Column) -> dict[str, Column]:
    """Support of a cell in three states; ``added`` by alternative fields, of which water displaces some."""
    kept = maintained_base(base_share, start, served, full, base_dry, dry, wet, wild)
    bottom = base_share * base_dry + (1 - base_share) * wild
    land, water = gain(dry, wild), gain(wet, dry, wild)
    now = bottom + positive(start - base_share) * land + served * water + kept["care_now"] + kept["water_now"] + added
    top = bottom + positive(most - base_share) * land + full * water + kept["care_most"] + kept["water_most"] + added - displaced
    return {"base": bottom, "current": now, "upper": top}


def support_values(base: Column, start: Column, most: Column, reference: Column, floor: float, ceiling: float) -> dict[str, Column]:
    """Four primary values over a bounded multiplier; missing where the order ``0 <= base <= start <= most`` is broken."""
    if not 0 < floor <= ceiling:
        raise ValueError("the multiplier's bounds are positive and in order")
    m = clip(reference, floor, ceiling)
    sound = (base >= 0) & (start >= base - 1e-8) & (most >= start - 1e-8)
    return {k: F.when(sound & m.isNotNull(), v) for k, v in {"units": base / m, "multiplier": m, "start_units": positive(start - base) / m, "most_units": positive(most - base) / m}.items()}


def inherited(active: Column, extent: Column, crop_gap: Column, water_gap: Column, ratio: float) -> Column:
    """The active share, held to a multiple of the evidenced extent."""
    gap = best(crop_gap, water_gap)
    return F.when(extent.isNotNull(), least_known(active, F.when(gap > 0, ratio * extent / gap).when(gap <= 0, 1.0)))


def tapered(active: Column, capped: Column, extent: Column, applies: Column, full_below: float, none_above: float) -> Column:
    """The cap in full on sparse land, fading out towards dense land."""
    fade = clip((none_above - extent) / (none_above - full_below), 0.0, 1.0)
    return active - F.when(applies, fade).when(~applies & extent.isNotNull(), 0.0) * (active - capped)


def command_fraction(fine: Column, km: Column, reach: float, same_basin: Column) -> Column:
    near = clip(fine, 0.0, 1.0) * clip(1 - km / reach, 0.0, 1.0)
    return F.when(same_basin, near).when(~same_basin & near.isNotNull(), 0.0)


def seasonal_response(supply: Column, demand: Column, worst: Column, critical: float) -> Column:
    return clip((1 - critical) * F.when(demand > 0, supply / demand).when((demand <= 0) & supply.isNotNull(), 1.0) + critical * worst, 0.0, 1.0)


def seasonal_demand(active: Column, deficit: Column, floor_mm: float, extra_mm: Column) -> Column:
    """Of each month of two arrays: the deficit, at least an even share of the season's floor, and the crop's extra.

    Where it isn't known of a month whether it is active, the share and so all months are missing.
    """
    months = F.when(F.forall(active, lambda a: a.isNotNull()), F.size(F.filter(active, lambda a: a)))
    need = F.zip_with(active, deficit, lambda a, d: F.when(a, best(d, floor_mm / months) + extra_mm).when(~a & months.isNotNull() & (d + extra_mm).isNotNull(), 0.0))
    return need


def dry_fields(cultivated: Column, served: Column, full: Column, dry: Column, wet: Column, wild: Column, other: Column, share: float) -> tuple[Column, Column]:
    """What another use adds on fields without water, and how much of that more water displaces."""
    field = positive(cultivated - served) * share
    more = gain(other, dry, wild)
    return field * more, least_known(positive(full - served), field) * least_known(more, gain(wet, dry, wild))


def inferred_water(cultivated: Column, recorded: Column, command: Column, dry: Column, wet: Column, other: Column, share: float) -> Column:
    needs = (dry <= 1e-6) & (wet > 1e-6) & (other <= 1e-6)
    room = positive(least_known(cultivated, command) - recorded) * share
    return recorded + F.when(needs, room).when(~needs & room.isNotNull(), 0.0)


def mixed_mean(own: Column, others: Sequence[Column], share: float) -> tuple[Column, Column]:
    """A share given to the mean of the feasible alternatives where that is better, and how many these are."""
    good = F.filter(F.array(*others), lambda x: x.isNotNull() & (x > 0) & (x < F.lit(float("inf"))))
    n = F.size(good)
    mean = F.aggregate(good, F.lit(0.0), lambda a, x: a + x) / n
    return F.when((n > 0) & ((1 - share) * own + share * mean > own), (1 - share) * own + share * mean).otherwise(own), n


def transfers(clearing: Column, management: Column, scores: dict[str, Column], rates: dict[str, tuple[float, float]], weight: Column, strength: float = 1.0) -> dict[str, Column]:
    """What each setting takes over of two gains, each rate being one at most."""
    c, m = positive(clearing), positive(management)
    return {k: c * scores[k] * weight * min(1.0, a * strength) + m * scores[k] * weight * min(1.0, b * strength) for k, (a, b) in rates.items()}


def base_requests(base: Column, crop_share: Column, base_area: Column, used_area: Column, scores: dict[str, Column], dependency: dict[str, float]) -> dict[str, Column]:
    cover = least_known(guarded(used_area, base_area, 0.0), F.lit(1.0))
    eligible = base * clip(crop_share, 0.0, 1.0) * clip(cover, 0.0, 1.0)
    return {k: eligible * scores[k] * d for k, d in dependency.items()}


def protected_transfer(base: Column, requests: dict[str, Column], floor: Column) -> tuple[dict[str, Column], Column]:
    """What each request gets of a base and what stays: all shrink by one factor so that ``floor`` (at most the base) is left; missing where a request is negative or they ask for over the base."""
    asked = sum(requests.values(), F.lit(0.0))
    room = positive(base - F.least(base, floor))
    sound = all_known(base, floor, *requests.values()) & (F.least(F.lit(0.0), *requests.values()) >= 0) & (asked <= base + 1e-5)
    factor = F.when(sound, F.least(F.when(asked > 0, room / asked).otherwise(0.0), F.lit(1.0)))
    given = {k: v * factor for k, v in requests.items()}
    return given, base - asked * factor


def digitized(x: Column, breaks: Sequence[float], values: Sequence[float]) -> Column:
    """The value of the class that ``x`` falls into; a class begins at its break."""
    if len(values) != len(breaks) + 1 or list(breaks) != sorted(set(breaks)):
        raise ValueError("breaks ascend and part the values")
    return F.when(x.isNotNull(), reduce(lambda out, k: F.when(x < breaks[k], values[k]).otherwise(out), reversed(range(len(breaks))), F.lit(values[-1])))


def limited_score(availability: Column, retention: Column, weight: float, caps: Sequence[tuple[Column, float, float]]) -> Column:
    """A blend of the lesser and the mean, held down by each ``(measure, threshold, cap)`` that is reached."""
    out = weight * least_known(availability, retention) + (1 - weight) * (availability + retention) / 2
    for measure, threshold, cap in caps:
        out = F.when(measure >= threshold, least_known(out, F.lit(cap))).when(measure < threshold, out)
    return out


def later_wins(start: Column, rules: Sequence[tuple[Column, object]]) -> Column:
    """Rules in rising precedence: the last that holds decides; missing where a later rule is unknown."""
    return reduce(lambda out, rule: F.when(rule[0], F.lit(rule[1])).when(~rule[0], out), rules, start)


def argmax_label(shares: dict[str, Column]) -> Column:
    """The name of the largest known share, the first among equals; missing where none is known."""
    rows = [F.when(v.isNotNull(), F.struct(v.cast("double").alias("v"), F.lit(-k).alias("k"), F.lit(n).alias("n"))) for k, (n, v) in enumerate(shares.items())]
    return F.array_max(F.array(*rows))["n"]


def allowance(population: Column, limit: float, capacity: Column, applies: Column) -> Column:
    """What people ask for beyond the capacity; 0 where the rule doesn't apply, whatever is known there."""
    return F.when(applies, positive(population / limit - capacity)).when(~applies, 0.0)


def decayed_access(eligible: Column, base: Column, upland: float, river: float, km: Column, decay: float, terrain: Column) -> Column:
    """Access that fades with the way to a river; ``km`` is null where there is none."""
    share = upland + (river - upland) * F.when(km.isNull(), 0.0).otherwise(F.exp(-positive(km) / decay))
    return F.when(eligible, least_known(base, share * terrain)).when(~eligible, base)


def raised_reference(reference: Column, eligible: Column, density: Column) -> Column:
    """A reference lifted to a density that is known to be greater; an unknown density lifts nothing."""
    lifted = F.coalesce(eligible & (density > 0) & (density > reference), F.lit(False))
    return F.when(eligible.isNotNull() & reference.isNotNull(), F.when(lifted, density).otherwise(reference))


def noted(parts: Sequence[tuple[Column, str]], start: str = "") -> Column:
    """A trail of the rules that applied, in order."""
    return F.concat(F.lit(start), *[F.when(c, F.lit(f";{t}")).otherwise("") for c, t in parts])


def exclusive(crop: Column, pasture: Column, wet: dict[str, Column]) -> dict[str, Column]:
    """Shares that add to at most one: crops, then pasture, then wet kinds scaled into what is left; ``rest`` is the remainder."""
    c = clip(crop, 0.0, 1.0)
    p = least_known(clip(pasture, 0.0, 1.0), 1 - c)
    room, total = 1 - c - p, sum(wet.values(), F.lit(0.0))
    factor = least_known(F.lit(1.0), F.when(total > 0, room / total).when((total <= 0) & room.isNotNull(), 1.0))
    return {"crop": c, "pasture": p, **{k: v * factor for k, v in wet.items()}, "rest": positive(room - total * factor)}


def refused(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that don't hold, an unknown one included, in order."""
    return F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), k) for k, c in conditions.items()]), lambda n: n.isNotNull())


def _share(x: Column) -> Column:
    return (x >= 0) & (x <= 1)


def activation_faults(extent: Column, maximum: Column, half: float) -> Column:
    """What ``expr.activation`` should not be asked for."""
    return refused({"half": F.lit(half > 0), "maximum": _share(maximum), "extent": _share(extent)})


def inherited_faults(active: Column, extent: Column, crop_gap: Column, water_gap: Column, ratio: float) -> Column:
    return refused({"ratio": F.lit(ratio >= 0), "active": _share(active), "extent": _share(extent), "crop_gap": crop_gap >= 0, "water_gap": water_gap >= 0})


def demand_faults(active: Column, deficit: Column, floor_mm: float, extra_mm: Column) -> Column:
    """Faults of a season's arrays: unequal lengths, unknown months, negative deficits, floors or extras, a floor without active months."""
    known = F.forall(active, lambda a: a.isNotNull()) & F.forall(deficit, lambda d: d.isNotNull())
    some = F.exists(active, lambda a: a) | F.lit(floor_mm == 0)
    return refused({"length": F.size(active) == F.size(deficit), "unknown": known, "deficit": F.forall(deficit, lambda d: d >= 0), "floor": F.lit(floor_mm >= 0), "extra": extra_mm >= 0, "season": some})


def transfer_faults(clearing: Column, management: Column, scores: dict[str, Column], rates: dict[str, tuple[float, float]], weight: Column, strength: float = 1.0) -> Column:
    """Settings outside 0 to 1, and parts that add to more than the gains they are taken from."""
    taken = [sum((scores[k] * weight * min(1.0, r[side] * strength) for k, r in rates.items()), F.lit(0.0)) for side in (0, 1)]
    within = [positive(source) * part <= positive(source) + 1e-7 for source, part in zip((clearing, management), taken, strict=True)]
    return refused({**{k: _share(v) for k, v in scores.items()}, "clearing": within[0], "management": within[1]})


def dry_field_faults(cultivated: Column, served: Column, full: Column, share: float) -> Column:
    return refused({"share": F.lit(0 <= share <= 1), "cultivated": _share(cultivated), "served": (served >= 0) & (served <= cultivated + 1e-9), "full": full >= served - 1e-9})
