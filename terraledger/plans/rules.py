"""Queries of field, water and class rules on synthetic shares and yields of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.functions import expr, rules
from terraledger.plans.registry import query
from terraledger.sources.tables import table

#: Shares and yields of a part, by its key and size.
FIELDS = {
    "b": ("p_partkey % 7 / 10.0", lambda k, s: k % 7 / 10.0), "st": ("p_partkey % 11 / 11.0", lambda k, s: k % 11 / 11.0), "mx": ("p_partkey % 13 / 13.0", lambda k, s: k % 13 / 13.0),
    "sv": ("p_partkey % 5 / 10.0", lambda k, s: k % 5 / 10.0), "fl": ("p_partkey % 5 / 10.0 + p_partkey % 3 / 10.0", lambda k, s: k % 5 / 10.0 + k % 3 / 10.0),
    "b0": ("p_size * 1.5", lambda k, s: s * 1.5), "rf": ("p_size % 17 * 4.0", lambda k, s: s % 17 * 4.0), "ir": ("p_size % 19 * 5.0", lambda k, s: s % 19 * 5.0), "lv": ("p_size % 5 * 6.0", lambda k, s: s % 5 * 6.0),
    "al": ("p_size % 23 * 3.0", lambda k, s: s % 23 * 3.0),
}
#: Each field is missing in one part of this many, each in parts of its own.
MISSING = 37
SQL = "f AS (SELECT p_partkey, p_size, p_retailprice, " + ", ".join(f"CASE WHEN p_partkey % {MISSING} <> {j} THEN CAST({q} AS DOUBLE) END AS {n}" for j, (n, (q, _)) in enumerate(FIELDS.items())) + " FROM part)"


def fields(spark: SparkSession, sf: str) -> tuple[DataFrame, list[Column]]:
    k, s = F.col("p_partkey"), F.col("p_size")
    known = [F.when(k % MISSING != j, f(k, s).cast("double")).alias(n) for j, (n, (_, f)) in enumerate(FIELDS.items())]
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", *known), [F.col(n) for n in FIELDS]


def lo(a: str, b: str) -> str:
    """SQL of the lesser of two that is missing if either is."""
    return f"CASE WHEN {a} < {b} THEN {a} WHEN {b} <= {a} THEN {b} END"


def hi(a: str, *others: str) -> str:
    for b in others:
        a = f"(CASE WHEN {a} > {b} THEN {a} WHEN {b} >= {a} THEN {b} END)"
    return a


def pos(a: str) -> str:
    return hi(f"({a})", "0")


def held(a: str) -> str:
    """SQL of a number held to 0 to 1."""
    return f"CASE WHEN {a} < 0 THEN 0 WHEN {a} > 1 THEN 1 WHEN {a} BETWEEN 0 AND 1 THEN {a} END"


def rounded(rows: DataFrame, columns: dict[str, Column], digits: int = 6) -> DataFrame:
    return rows.select("p_partkey", *[F.round(c, digits).alias(k) for k, c in columns.items()])


@query(f"""WITH {SQL} SELECT p_partkey, round(rf * 3.4 * 0.9 * 0.85 * 2 * 0.5, 6) AS energy, round(40 * b * st + 3, 6) AS labour, round(CASE WHEN p_size % 2 = 0 THEN rf ELSE ir END * (1.1 * 0.9), 6) AS scenario,
       round(CASE WHEN p_size % 4 > 0 THEN p_size % 4 / CAST(p_size % 4 + p_size % 3 AS DOUBLE) END, 6) AS rotation, round(rf * (1 - 0.2) * (1 - 0.1), 6) AS low, round(rf * (1 + 0.2) * (1 + 0.1), 6) AS high,
       round(CASE WHEN p_size % 6 = 0 OR rf IS NULL THEN ir ELSE rf + sv * (ir - rf) END, 6) AS score FROM f""")
def crop_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, _, sv, _, _, rf, ir, _, _) = fields(spark, sf)
    s = F.col("p_size")
    low, high = rules.bands(rf, 0.2, 0.1)
    return rounded(rows, {
        "energy": rules.food_energy(rf, 3.4, 0.9, 0.85, 2, 0.5), "labour": rules.labour_days(40, b, st, 3), "scenario": rules.scenario_factor(s % 2 == 0, rf, ir, 1.1, 0.9),
        "rotation": rules.rotation_fraction(s % 4, s % 3), "low": low, "high": high, "score": rules.effective_score(F.when(s % 6 != 0, rf), ir, sv),
    })


GAINS = f"""g0 AS (SELECT *, {pos("st - b")} AS opened, {pos("mx - b")} - {pos("st - b")} AS extra, {pos("p_size * 1.0 - lv")} AS lg, {pos("rf - lv")} AS dg, {pos(f"ir - {hi('rf', 'lv')}")} AS wg,
    {pos("rf - b0")} AS mg, {pos(f"ir - {hi('rf', 'b0', 'lv')}")} - {pos(f"ir - {hi('rf', 'lv')}")} AS wc, {pos("st - sv")} * 0.5 AS fd, {pos(f"al - {hi('rf', 'lv')}")} AS ag, {pos("fl - sv")} AS more FROM f),
g AS (SELECT *, ({lo("more", "fd")}) * ({lo("ag", "wg")}) AS shifted FROM g0)"""


@query(f"""WITH {SQL}, {GAINS} SELECT p_partkey, round(opened * lg, 6) AS start_clearing, round(opened * (dg - lg), 6) AS start_management, round(sv * wg, 6) AS start_water, round(extra * lg, 6) AS rest_clearing,
       round(extra * (dg - lg), 6) AS rest_management, round((fl - sv) * wg, 6) AS rest_water FROM g""")
def improvement_attribution(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, fl, _, rf, ir, lv, _) = fields(spark, sf)
    return rounded(rows, rules.attribution(b, st, mx, sv, fl, rf, ir, lv, F.col("p_size") * 1.0))


@query(f"""WITH {SQL}, {GAINS} SELECT p_partkey, round(({lo('b', 'st')}) * mg, 6) AS care_now, round(b * mg, 6) AS care_most, round(({lo('sv', 'b')}) * wc, 6) AS water_now, round(({lo('fl', 'b')}) * wc, 6) AS water_most,
       round(fd * ag, 6) AS added, round(shifted, 6) AS displaced,
       round(CASE WHEN rf <= 1e-6 AND ir > 1e-6 AND al <= 1e-6 THEN sv + {pos(f"({lo('st', 'mx')}) - sv")} * 0.5 WHEN NOT (rf <= 1e-6 AND ir > 1e-6 AND al <= 1e-6) AND st + mx IS NOT NULL THEN sv END, 6) AS water,
       round(({lo('sv', 'b')}) * ({pos(f"b0 - {hi('rf', 'lv')}")} - wg), 6) AS corrected FROM g""")
def field_gains(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, fl, b0, rf, ir, lv, al) = fields(spark, sf)
    added, displaced = rules.dry_fields(st, sv, fl, rf, ir, lv, al, 0.5)
    corrected = expr.least_known(sv, b) * (rules.gain(b0, rf, lv) - rules.gain(ir, rf, lv))
    return rounded(rows, {**rules.maintained_base(b, st, sv, fl, b0, rf, ir, lv), "added": added, "displaced": displaced, "water": rules.inferred_water(st, sv, mx, rf, ir, al, 0.5), "corrected": corrected})


@query(f"""WITH {SQL}, {GAINS}, s AS (SELECT *, b * b0 + (1 - b) * lv AS base, b * b0 + (1 - b) * lv + opened * dg + sv * wg + ({lo('b', 'st')}) * mg + ({lo('sv', 'b')}) * wc + fd * ag AS cur,
       b * b0 + (1 - b) * lv + {pos('mx - b')} * dg + fl * wg + b * mg + ({lo('fl', 'b')}) * wc + fd * ag - shifted AS up FROM g),
k AS (SELECT *, least(greatest(p_size / 10.0, 0.25), 4) AS m, cur >= base - 1e-8 AND up >= cur - 1e-8 AS sound FROM s)
SELECT p_partkey, round(base, 6) AS base, round(cur, 6) AS current, round(up, 6) AS upper, round(CASE WHEN sound THEN base / m END, 6) AS units, round(CASE WHEN sound THEN m END, 6) AS multiplier,
       round(CASE WHEN sound THEN {pos('cur - base')} / m END, 6) AS start_units, round(CASE WHEN sound THEN {pos('up - base')} / m END, 6) AS most_units FROM k""")
def cell_support(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, fl, b0, rf, ir, lv, al) = fields(spark, sf)
    added, displaced = rules.dry_fields(st, sv, fl, rf, ir, lv, al, 0.5)
    rows = rows.select("p_partkey", "p_size", *[c.alias(k) for k, c in rules.cell_support(b, st, mx, sv, fl, b0, rf, ir, lv, added, displaced).items()])
    three = {k: F.col(k) for k in ("base", "current", "upper")}
    return rounded(rows, {**three, **rules.support_values(*three.values(), F.col("p_size") / 10.0, 0.25, 4.0)})


GUARD = "CASE WHEN b > 0 AND b >= sv THEN 0.5 * mx / b WHEN sv > 0 AND sv > b THEN 0.5 * mx / sv WHEN b <= 0 AND sv <= 0 AND mx IS NOT NULL THEN 1 END"


@query(f"""WITH {SQL}, w AS (SELECT *, {GUARD} AS guard FROM f), c AS (SELECT *, {lo("st", "guard")} AS capped FROM w)
SELECT p_partkey, round(capped, 6) AS capped, round(CASE WHEN p_size % 3 > 0 THEN st - ({held("((0.6 - mx) / (0.6 - 0.2))")}) * (st - capped) WHEN mx + capped IS NOT NULL THEN st END, 6) AS reviewed FROM c""")
def inheritance_guard(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, *_) = fields(spark, sf)
    capped = rules.inherited(st, mx, b, sv, 0.5)
    return rounded(rows, {"capped": capped, "reviewed": rules.tapered(st, capped, mx, F.col("p_size") % 3 > 0, 0.2, 0.6)})


@query(f"""WITH {SQL} SELECT p_partkey, round((rf * b * 0.65 * least(1, 0.25 * 1.5) + ir * b * 0.65 * least(1, 0.7 * 1.5)), 6) AS paddy, round((rf * st * 0.65 * least(1, 0.75 * 1.5) + ir * st * 0.65 * least(1, 0.6 * 1.5)), 6) AS polders,
       round(b0 * mx * cover * b * 0.65, 6) AS ask_paddy, round(b0 * mx * cover * st * 0.8, 6) AS ask_polders
FROM (SELECT *, CASE WHEN fl > 0 AND sv < fl THEN sv / fl WHEN fl > 0 AND sv >= fl THEN 1 WHEN fl <= 0 AND sv IS NOT NULL THEN 0 END AS cover FROM f)""")
def water_requests(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, fl, b0, rf, ir, *_) = fields(spark, sf)
    scores = {"paddy": b, "polders": st}
    moved = rules.transfers(rf, ir, scores, {"paddy": (0.25, 0.7), "polders": (0.75, 0.6)}, F.lit(0.65), 1.5)
    asked = rules.base_requests(b0, mx, fl, sv, scores, {"paddy": 0.65, "polders": 0.8})
    return rounded(rows, {**moved, **{f"ask_{k}": c for k, c in asked.items()}})


@query(f"""WITH {SQL}, m AS (SELECT p_partkey, p_size, sv, fl, b, m, (m + p_size) % 12 < 5 AS active, (p_size * m % 31) * 1.0 AS deficit FROM f, range(12) r(m)),
d AS (SELECT p_partkey, sv, fl, b, CASE WHEN active THEN greatest(deficit, 100.0 / 5) + CASE WHEN p_size % 8 = 7 THEN 60 ELSE 0 END ELSE 0 END AS need FROM m)
SELECT p_partkey, round(sum(need), 4) AS need, round(max(need), 4) AS peak, round(max({held('(0.75 * CASE WHEN fl > 0 THEN sv / fl WHEN sv + fl IS NOT NULL THEN 1 END + 0.25 * b)')}), 6) AS response FROM d GROUP BY 1""")
def season_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, _, _, sv, fl, *_) = fields(spark, sf)
    months, s = F.sequence(F.lit(0), F.lit(11)), F.col("p_size")
    need = rules.seasonal_demand(F.transform(months, lambda m: (m + s) % 12 < 5), F.transform(months, lambda m: (s * m % 31) * 1.0), 100.0, F.when(s % 8 == 7, 60.0).otherwise(0.0))
    rows = rows.withColumn("need", need)
    return rows.select("p_partkey", F.round(F.aggregate("need", F.lit(0.0), lambda a, x: a + x), 4).alias("need"), F.round(F.array_max("need"), 4).alias("peak"), F.round(rules.seasonal_response(sv, fl, b, 0.25), 6).alias("response"))


CAPPED = f"CASE WHEN al >= 60 THEN {lo('s0', '1.0')} WHEN al >= 40 THEN {lo('s0', '2.0')} WHEN al < 40 THEN s0 END"


@query(f"""WITH {SQL}, c AS (SELECT *, CASE WHEN rf < 10 THEN 1 WHEN rf < 25 THEN 3 WHEN rf < 50 THEN 5 WHEN rf >= 50 THEN 2 END AS ph, CASE WHEN ir < 20 THEN 1 WHEN ir < 60 THEN 3 WHEN ir >= 60 THEN 5 END AS ret FROM f),
l AS (SELECT *, 0.5 * ({lo("ph", "ret")}) + 0.5 * (ph + ret) / 2.0 AS s0 FROM c), s AS (SELECT *, {CAPPED} AS s FROM l)
SELECT p_partkey, CAST(CASE WHEN s IS NOT NULL THEN least(greatest(floor(s + 0.5), 1), 5) END AS INTEGER) AS grade,
       CASE WHEN p_size % 10 = 9 THEN 'none' WHEN p_size % 4 = 3 THEN 'peat' WHEN al >= 35 THEN 'stony' WHEN al IS NULL THEN NULL WHEN p_size % 2 = 0 THEN 'loam' ELSE 'clay' END AS soil,
       CASE WHEN b > 0.5 THEN 'deltas' WHEN b IS NULL THEN NULL WHEN p_size % 7 = 6 THEN 'wetlands' WHEN st >= 0.35 THEN 'floodplains' WHEN st IS NULL THEN NULL
            WHEN mx >= 0.5 AND sv >= 0.2 THEN 'rolling' WHEN mx < 0.5 OR sv < 0.2 THEN 'flatland' END AS landform,
       CASE WHEN st >= 0.6 THEN 'farmland' WHEN b + sv >= 0.5 THEN CASE WHEN b >= sv THEN 'marsh' ELSE 'swamp' END
            WHEN coalesce(b, -1) >= coalesce(sv, -1) AND coalesce(b, -1) >= coalesce(st, -1) AND coalesce(b, -1) >= coalesce(mx, -1) THEN 'marsh' WHEN coalesce(sv, -1) >= coalesce(st, -1) AND coalesce(sv, -1) >= coalesce(mx, -1) THEN 'swamp'
            WHEN coalesce(st, -1) >= coalesce(mx, -1) THEN 'farmland' ELSE 'forest' END AS cover,
       'base' || CASE WHEN b > 0.3 THEN ';water' ELSE '' END || CASE WHEN st > 0.3 THEN ';alternative' ELSE '' END AS trail,
       round(CASE WHEN p_size * 1.0 < 2 THEN 1 WHEN p_size < 8 THEN 0.85 WHEN p_size < 30 THEN 0.25 ELSE 0 END::DOUBLE, 6) AS slope FROM s""")
def class_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, _, _, rf, ir, _, al) = fields(spark, sf)
    s = F.col("p_size")
    available, kept = rules.digitized(rf, [10, 25, 50], [1, 3, 5, 2]), rules.digitized(ir, [20, 60], [1, 3, 5])
    score = rules.limited_score(available, kept, 0.5, [(al, 40, 2.0), (al, 60, 1.0)])
    soil = rules.later_wins(F.lit("clay"), [(s % 2 == 0, "loam"), (al >= 35, "stony"), (s % 4 == 3, "peat"), (s % 10 == 9, "none")])
    native = F.when(s % 7 == 6, "wetlands").otherwise("flatland")
    free = native == "flatland"
    landform = rules.later_wins(native, [(free & (mx >= 0.5) & (sv >= 0.2), "rolling"), (free & (st >= 0.35), "floodplains"), (b > 0.5, "deltas")])
    wet = {"marsh": b, "swamp": sv}
    cover = F.when(st >= 0.6, "farmland").when(b + sv >= 0.5, rules.argmax_label(wet)).otherwise(rules.argmax_label({**wet, "farmland": st, "forest": mx}))
    trail = rules.noted([(b > 0.3, "water"), (st > 0.3, "alternative")], "base")
    slope = rules.digitized(s * 1.0, [2, 8, 30], [1.0, 0.85, 0.25, 0.0])
    return rows.select("p_partkey", expr.half_up(score, 1, 5).alias("grade"), soil.alias("soil"), landform.alias("landform"), cover.alias("cover"), trail.alias("trail"), F.round(slope, 6).alias("slope"))


@query(f"""WITH {SQL}, a AS (SELECT *, CASE WHEN p_size % 3 = 0 THEN 'city' WHEN p_size % 3 = 1 THEN 'rural' END AS rank, CASE WHEN p_size % 4 > 0 THEN p_size * 2.0 END AS km FROM f)
SELECT p_partkey, round(CASE WHEN st IS NOT NULL THEN CASE WHEN p_size % 2 = 0 THEN least(greatest(st * 1.2, 0), 1) * least(greatest(1 - p_size / 30.0, 0), 1) ELSE 0 END END, 6) AS command, round(b0 + CASE p_size % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.02 ELSE 0.05 END * rf, 6) AS used,
       round(CASE WHEN p_size % 5 > 0 THEN {lo("b", "reached")} ELSE b END, 6) AS access, round(CASE WHEN p_size % 2 = 1 AND ir > 0 AND ir > rf THEN ir ELSE rf END, 6) AS reference,
       CASE WHEN p_brand LIKE '%1' THEN 'barrier' ELSE 'improvable' END AS obstacle, coalesce(CASE rank WHEN 'city' THEN 'urban' ELSE rank END, 'unknown') AS context,
       round(CASE WHEN rank = 'rural' THEN {pos('p_retailprice / 20 - rf')} ELSE 0 END, 6) AS allowance, p_retailprice / 20 > rf + {hi('1e-7', 'abs(rf) * 1e-12')} AS above
FROM (SELECT *, (0.1 + (0.6 - 0.1) * CASE WHEN km IS NULL THEN 0 ELSE exp(-km / 20) END) * mx AS reached FROM a) JOIN (SELECT p_partkey, p_brand FROM part) USING (p_partkey)""")
def access_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, _, _, b0, rf, ir, *_) = fields(spark, sf)
    s, population = F.col("p_size"), F.col("p_retailprice") / 20
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    rows = rows.join(brands, "p_partkey").withColumn("rank", F.when(s % 3 == 0, "city").when(s % 3 == 1, "rural"))
    weight = F.create_map(F.lit(0), F.lit(0.1), F.lit(1), F.lit(0.02))  # by class, with a default
    context = F.coalesce(F.when(F.col("rank").isin("city", "town"), "urban").when(F.col("rank").isin("rural"), "rural"), F.lit("unknown"))
    six = {
        "command": rules.command_fraction(st * 1.2, s * 1.0, 30.0, s % 2 == 0), "used": b0 + F.coalesce(F.try_element_at(weight, s % 3), F.lit(0.05)) * rf,
        "access": rules.decayed_access(s % 5 > 0, b, 0.1, 0.6, F.when(s % 4 > 0, s * 2.0), 20.0, mx), "reference": rules.raised_reference(rf, s % 2 == 1, ir),
        "allowance": rules.allowance(F.col("p_retailprice"), 20.0, rf, context == "rural"),
    }
    return rows.select("p_partkey", *[F.round(c, 6).alias(k) for k, c in six.items()], F.when(F.lower("p_brand").endswith("1"), "barrier").otherwise("improvable").alias("obstacle"), context.alias("context"), expr.above_tolerance(population, rf).alias("above"))


@query(f"""WITH {SQL}, l AS (SELECT p_partkey, rf, list_filter([CASE WHEN p_size % 3 > 0 THEN ir END, lv, al], lambda x: x IS NOT NULL AND x > 0) AS good FROM f),
x AS (SELECT p_partkey, rf, len(good) AS n, 0.6 * rf + 0.4 * list_sum(good) / len(good) AS c FROM l),
d AS (SELECT p_partkey, b, sv, fl, {lo("st", "(1 - b)")} AS pasture, sv + fl AS total FROM f), e AS (SELECT *, 1 - b - pasture AS room FROM d),
t AS (SELECT *, CASE WHEN total > room AND total > 0 THEN room / total WHEN total <= room OR total <= 0 AND room IS NOT NULL THEN 1 END AS factor FROM e)
SELECT p_partkey, round(CASE WHEN n > 0 AND c > rf THEN c ELSE rf END, 6) AS mixed, CAST(n AS INTEGER) AS alternatives, round(b, 6) AS crop, round(pasture, 6) AS pasture,
       round(sv * factor, 6) AS marsh, round(fl * factor, 6) AS swamp, round({pos("room - total * factor")}, 6) AS rest FROM x JOIN t USING (p_partkey)""")
def mixed_and_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, _, sv, fl, _, rf, ir, lv, al) = fields(spark, sf)
    mixed, n = rules.mixed_mean(rf, [F.when(F.col("p_size") % 3 > 0, ir), lv, al], 0.4)
    parts = rules.exclusive(b, st, {"marsh": sv, "swamp": fl})
    return rows.select("p_partkey", F.round(mixed, 6).alias("mixed"), n.alias("alternatives"), *[F.round(c, 6).alias(k) for k, c in parts.items()])


@query(f"""WITH {SQL}, v AS (SELECT *, rf / 20 - 1 AS a, b * 1.2 AS w FROM f)
SELECT p_partkey, concat_ws(',', CASE WHEN (mx BETWEEN 0 AND 1) IS NOT TRUE THEN 'maximum' END, CASE WHEN (a BETWEEN 0 AND 1) IS NOT TRUE THEN 'extent' END) AS activation,
       concat_ws(',', CASE WHEN (st BETWEEN 0 AND 1) IS NOT TRUE THEN 'active' END, CASE WHEN (a BETWEEN 0 AND 1) IS NOT TRUE THEN 'extent' END, CASE WHEN (b >= 0) IS NOT TRUE THEN 'crop_gap' END, CASE WHEN (a >= 0) IS NOT TRUE THEN 'water_gap' END) AS inherited,
       concat_ws(',', CASE WHEN (st BETWEEN 0 AND 1) IS NOT TRUE THEN 'cultivated' END, CASE WHEN (sv >= 0 AND sv <= st + 1e-9) IS NOT TRUE THEN 'served' END, CASE WHEN (fl >= sv - 1e-9) IS NOT TRUE THEN 'full' END) AS dry_fields,
       concat_ws(',', CASE WHEN (w BETWEEN 0 AND 1) IS NOT TRUE THEN 'paddy' END, CASE WHEN (st BETWEEN 0 AND 1) IS NOT TRUE THEN 'polders' END, CASE WHEN (rf * (w * 0.6 + st * 0.9) <= rf + 1e-7) IS NOT TRUE THEN 'clearing' END, CASE WHEN (ir * (w * 0.2 + st * 0.3) <= ir + 1e-7) IS NOT TRUE THEN 'management' END) AS transfers
FROM v""")
def rule_refusals(spark: SparkSession, sf: str) -> DataFrame:
    """Inputs that the rules must not be given, by name: beyond their range or unknown."""
    rows, (b, st, mx, sv, fl, _, rf, ir, _, _) = fields(spark, sf)
    out_of, wide = rf / 20 - 1, b * 1.2
    found = {
        "activation": rules.activation_faults(out_of, mx, 0.3), "inherited": rules.inherited_faults(st, out_of, b, out_of, 0.5), "dry_fields": rules.dry_field_faults(st, sv, fl, 0.5),
        "transfers": rules.transfer_faults(rf, ir, {"paddy": wide, "polders": st}, {"paddy": (0.6, 0.2), "polders": (0.9, 0.3)}, F.lit(1.0)),
    }
    return rows.select("p_partkey", *[F.array_join(c, ",").alias(k) for k, c in found.items()])


@query(f"""WITH {SQL} SELECT p_partkey, round(CASE WHEN rf - 8 >= 0 THEN 30.0 * 1.2 * pow((rf - 8) / 30.0, 0.8) END, 6) AS scaled, round(CASE WHEN ir > rf THEN (al - rf) / (ir - rf) END, 6) AS position, round(mx * st / (st + 0.35), 6) AS active FROM f""")
def yield_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Yields scaled by a power, negative ones missing; a place between two yields, never clipped; saturating activation."""
    rows, (_, st, mx, _, _, _, rf, ir, _, al) = fields(spark, sf)
    return rounded(rows, {"scaled": expr.scale_yield(rf - 8, 1.2, 0.8, 30.0), "position": expr.position(al, rf, ir), "active": expr.activation(mx, st, 0.35)})
