"""Queries of whole account stages on the synthetic shares and yields of parts, with their gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.operators import capacity
from terraledger.plans.registry import query
from terraledger.plans.rules import SQL, fields, hi, lo, pos, rounded
from terraledger.sources.tables import table

KINDS = ("clearing", "management", "water")


def _named(rows: DataFrame, columns: dict[str, Column], *more: str) -> DataFrame:
    return rows.select("p_partkey", *more, *[c.alias(k) for k, c in columns.items()])


@query(f"""WITH {SQL}, n AS (SELECT p_partkey, coalesce(b0, 0) AS base, CASE WHEN p_partkey % 9 = 4 THEN 0 ELSE coalesce(b0 + rf, 0) END AS starting, coalesce(b0 + rf + ir, 0) AS maximum,
    coalesce(rf * b, 0) AS sc, coalesce(rf * st, 0) AS sm, coalesce(rf * mx, 0) AS sw, coalesce(ir * b, 0) AS mc, coalesce(ir * st, 0) AS mm, coalesce(ir * mx, 0) AS mw FROM f)
SELECT p_partkey, round(base, 6) AS "natural", round(starting, 6) AS starting, round(maximum, 6) AS maximum, round(starting - base, 6) AS starting_gain, round(maximum - starting, 6) AS remaining,
       round(sc + sm + sw, 6) AS starting_total, round(mc + mm + mw, 6) AS maximum_total, round(starting - base - (sc + sm + sw), 6) AS starting_residual, round(maximum - base - (mc + mm + mw), 6) AS maximum_residual FROM n""")
def capacity_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Targets and ledger of the whole inventory; a capacity that is text without a number is none."""
    rows, (b, st, mx, _, _, b0, rf, ir, _, _) = fields(spark, sf)
    k = F.col("p_partkey")
    parts = {f"{s}_{n}": v * w for s, v in (("starting", rf), ("maximum", ir)) for n, w in zip(KINDS, (b, st, mx), strict=True)}
    frame = _named(rows, {"natural": b0, "starting": F.when(k % 9 == 4, "").otherwise((b0 + rf).cast("string")), "maximum": b0 + rf + ir, **parts})
    targets, ledger = capacity.capacity_targets(frame, ["p_partkey"], KINDS, refuse=["population"])
    joined = targets.join(ledger.select("p_partkey", *[f"{s}_{n}" for s in capacity.STAGES for n in ("total", "residual")]), "p_partkey")
    return rounded(joined, {c: F.col(c) for c in joined.columns if c != "p_partkey"})


@query(f"""WITH {SQL}, g AS (SELECT *, p_size % 5 = 1 OR p_size % 5 = 2 AND p_size % 2 = 0 AS dry, p_size % 3 = 0 AS herds,
    CASE WHEN ir > 0 THEN least(greatest(coalesce(lv, 0) / ir, 0), 1) ELSE 0 END AS share FROM f)
SELECT p_partkey, round(CASE WHEN dry THEN 0 ELSE sv END, 6) AS starting_water_supply, round(CASE WHEN dry THEN sv ELSE 0 END, 6) AS starting_oasis_irrigation, round(CASE WHEN dry THEN 0 ELSE fl END, 6) AS maximum_water_supply,
       round(CASE WHEN dry THEN fl ELSE 0 END, 6) AS maximum_oasis_irrigation, round(CASE WHEN herds THEN b0 * least(share * 1.2, 1) ELSE 0 END, 6) AS starting_pastoral, round(CASE WHEN herds THEN b0 * least(share * 1.2, 1) ELSE 0 END * 1.5, 6) AS maximum_pastoral FROM g""")
def ledger_extensions(spark: SparkSession, sf: str) -> DataFrame:
    """Water supply that becomes oasis irrigation, and the grazed part of the natural capacity."""
    rows, (_, _, _, sv, fl, b0, _, ir, lv, _) = fields(spark, sf)
    s = F.col("p_size")
    frame = _named(rows, {"starting_water_supply": sv, "maximum_water_supply": fl, "natural": b0, "grazing": lv, "area": ir, "climate": (s % 5).cast("string"), "even": (s % 2 == 0).cast("string"), "third": (s % 3).cast("string")})
    out = capacity.extended_ledger(frame, oasis=[{"climate": ["1"]}, {"climate": ["2"], "even": ["true"]}], pastoral=[{"third": ["0"]}], multiplier=1.2, most=1.5)
    return rounded(out, {f"{s_}_{k}": F.col(f"{s_}_{k}") for s_ in capacity.STAGES for k in ("water_supply", "oasis_irrigation", "pastoral")})


def water_frame(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, st, mx, sv, fl, b0, rf, ir, lv, al) = fields(spark, sf)
    k = F.col("p_partkey")
    out = {}
    for p, x in (("starting", 1.0), ("remaining", 0.5)):
        take_c, take_m = rf * b * 0.3 * x, ir * st * 0.2 * x
        rest = take_c + take_m
        out |= {f"{p}_clearing": rf * x, f"{p}_management": ir * x, f"{p}_irrigation": lv * x, f"{p}_raw_clearing": rf * x, f"{p}_raw_management": ir * x, f"{p}_raw_irrigation": lv * x}
        # every 17th place takes more than its kinds share, every 23rd more than there is
        out |= {f"{p}_take_clearing": F.when(k % 23 == 7, rf * 1.5 * x).otherwise(take_c), f"{p}_take_management": take_m}
        out |= {f"{p}_paddy_control": F.when(k % 17 == 5, rest * 0.2).otherwise(rest * 0.4), f"{p}_polders": rest * 0.3, f"{p}_flood_bunds": rest * 0.2, f"{p}_field_drainage": rest * 0.1}
    return _named(rows, out)


def _water_sql() -> str:
    parts = []
    for p, x in (("starting", "1.0"), ("remaining", "0.5")):
        tc, tm = f"(CASE WHEN p_partkey % 23 = 7 THEN rf * 1.5 * {x} ELSE rf * b * 0.3 * {x} END)", f"(ir * st * 0.2 * {x})"
        rest, budget = f"(rf * b * 0.3 * {x} + ir * st * 0.2 * {x})", f"(rf * {x} + ir * {x} + lv * {x})"
        paddy = f"(CASE WHEN p_partkey % 17 = 5 THEN {rest} * 0.2 ELSE {rest} * 0.4 END)"
        parts.append(f"{tc} AS {p}_tc, {tm} AS {p}_tm, {paddy} AS {p}_k1, {rest} * 0.3 AS {p}_k2, {rest} * 0.2 AS {p}_k3, {rest} * 0.1 AS {p}_k4, {budget} AS {p}_budget, rf * {x} AS {p}_c, ir * {x} AS {p}_m, lv * {x} AS {p}_i")
    held = ", ".join(f"({lo(f'{p}_tc', f'{p}_c')}) + ({lo(f'{p}_tm', f'{p}_m')}) AS {p}_given, {p}_k1 + {p}_k2 + {p}_k3 + {p}_k4 AS {p}_asked, {pos(f'{p}_c - {p}_tc')} AS {p}_lc, {pos(f'{p}_m - {p}_tm')} AS {p}_lm" for p in ("starting", "remaining"))
    return f"{SQL}, w0 AS (SELECT *, {', '.join(parts)} FROM f), w1 AS (SELECT *, {held} FROM w0)"


def _kind(p: str, j: int) -> str:
    # the native sums are the budgets, so the factor is 1 wherever there is any
    return f"CASE WHEN {p}_budget > 0 AND {p}_asked > 0 THEN {p}_k{j} * {p}_given / {p}_asked WHEN {p}_budget <= 0 OR {p}_budget > 0 AND {p}_asked <= 0 THEN 0 * {p}_k{j} * {p}_given END"


@query(f"""WITH {_water_sql()} SELECT p_partkey, round(starting_i, 6) AS starting_out_water_supply, round({_kind("starting", 1)}, 6) AS starting_out_paddy_control, round({_kind("remaining", 2)}, 6) AS remaining_out_polders,
       round(CASE WHEN starting_budget > 0 THEN starting_lc WHEN starting_budget <= 0 THEN starting_c END, 6) AS starting_out_clearing, round(({_kind("starting", 3)}) + ({_kind("remaining", 3)}), 6) AS maximum_out_flood_bunds FROM w1""")
def water_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Budgets sorted into kinds of water works."""
    out = capacity.water_accounts(water_frame(spark, sf))
    return rounded(out, {c: F.col(c) for c in ("starting_out_water_supply", "starting_out_paddy_control", "remaining_out_polders", "starting_out_clearing", "maximum_out_flood_bunds")})


def _water_faults() -> str:
    rows = []
    for p in ("starting", "remaining"):
        known = f"{p}_budget + {p}_asked + {p}_given IS NOT NULL"
        over = f"{pos(f'{p}_tc - {p}_c')} + {pos(f'{p}_tm - {p}_m')}"
        apart = f"abs({p}_asked - {p}_tc - {p}_tm)"
        sums = f"{p}_i + CASE WHEN {p}_asked > 0 THEN {p}_given ELSE 0 END + {p}_lc + {p}_lm"
        rows += [
            f"SELECT p_partkey, '{p}_negative' AS fault FROM w1 WHERE NOT ({known})",
            f"SELECT p_partkey, '{p}_over' FROM w1 WHERE ({known} AND {over} <= 2e-6 * {hi(f'{p}_budget', '1')}) IS NOT TRUE",
            f"SELECT p_partkey, '{p}_apart' FROM w1 WHERE ({known} AND {apart} <= 1e-5 + 2e-6 * abs({p}_budget)) IS NOT TRUE",
            f"SELECT p_partkey, '{p}_sum' FROM w1 WHERE ({known} AND abs({sums} - {p}_budget) <= 1e-5 + 1e-10 * abs({p}_budget)) IS NOT TRUE",
        ]
    both = " + ".join(f"{p}_i + CASE WHEN {p}_asked > 0 THEN {p}_given ELSE 0 END + {p}_lc + {p}_lm - {p}_budget" for p in ("starting", "remaining"))
    rows.append(f"SELECT p_partkey, 'maximum_sum' FROM w1 WHERE (starting_budget + starting_asked + starting_given IS NOT NULL AND abs({both}) <= 1e-5 + 1e-10 * abs(starting_budget * 1.5)) IS NOT TRUE")
    return " UNION ALL ".join(rows)


@query(f"WITH {_water_sql()} {_water_faults()}")
def water_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Places whose takings go over their budget, aren't shared by the kinds, or are unknown."""
    return capacity.water_faults(capacity.water_accounts(water_frame(spark, sf)), "p_partkey")


@query(f"""WITH {SQL}, a AS (SELECT *, CASE WHEN p_partkey % 31 = 3 THEN NULL ELSE p_retailprice END AS pop, p_size % 3 = 1 AS rural, 2.0 AS m FROM f),
w AS (SELECT *, CASE WHEN rural THEN {pos("coalesce(pop, 0) / 20 - rf")} ELSE 0 END AS want FROM a), g AS (SELECT *, want + CASE WHEN p_partkey % 19 = 2 THEN 1 ELSE 0 END AS added FROM w)
SELECT p_partkey, 'gain' AS fault FROM g WHERE (abs(added - want) <= 1e-7 + 1e-12 * abs(want)) IS NOT TRUE
UNION ALL SELECT p_partkey, 'units' FROM g WHERE ((added + CASE WHEN p_partkey % 29 = 1 THEN 2 ELSE 0 END - added) = 0) IS NOT TRUE
UNION ALL SELECT p_partkey, 'natural_gain' FROM g WHERE b0 + added IS NULL
UNION ALL SELECT p_partkey, 'starting_gain' FROM g WHERE rf + added IS NULL
UNION ALL SELECT p_partkey, 'maximum_gain' FROM g WHERE (CASE WHEN p_partkey % 11 = 6 THEN 3 ELSE 0 END + ir * 0 + rf * 0 + added * 0 = 0) IS NOT TRUE
UNION ALL SELECT p_partkey, 'room' FROM g WHERE (CASE WHEN p_partkey % 11 = 6 THEN 3 ELSE 0 END + ir * 0 + rf * 0 + added * 0 = 0) IS NOT TRUE
UNION ALL SELECT p_partkey, 'pressure' FROM g WHERE rural AND (coalesce(pop, 0) <= 20 * (rf + added) + 1e-6) IS NOT TRUE""")
def allowance_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Allowances that aren't exactly what people ask for, some of them wrong on purpose."""
    rows, (_, _, _, _, _, b0, rf, ir, _, _) = fields(spark, sf)
    k = F.col("p_partkey")
    rows = rows.select("p_partkey", (F.col("p_size") % 3 == 1).alias("rural"), F.when(k % 31 != 3, F.col("p_retailprice")).alias("population"), b0.alias("before_natural"), rf.alias("before_starting"), (rf + ir).alias("before_maximum"))
    people = F.coalesce("population", F.lit(0.0))
    want = F.when(F.col("rural"), F.when(F.col("before_starting").isNotNull(), F.greatest(people / 20 - F.col("before_starting"), F.lit(0.0)))).otherwise(0.0)
    rows = rows.withColumn("added", want + F.when(k % 19 == 2, 1.0).otherwise(0.0)).withColumn("multiplier", F.lit(2.0)).withColumn("units", (F.col("added") + F.when(k % 29 == 1, 2.0).otherwise(0.0)) / 2)
    new = {c: F.col(f"before_{c}") + F.col("added") for c in ("natural", "starting", "maximum")}
    new["maximum"] = new["maximum"] + F.when(k % 11 == 6, 3.0).otherwise(0.0)
    return capacity.allowance_faults(rows.withColumns(new), "p_partkey", 20.0)


@query(f"""WITH {SQL}, u AS (SELECT *, {pos("rf")} + CASE p_size % 4 WHEN 0 THEN 0.3 WHEN 1 THEN 0.1 ELSE 0.05 END * {pos("lv")} AS used FROM f),
i AS (SELECT *, CASE WHEN used > 0 THEN {pos("(sv + fl) / used")} WHEN used <= 0 AND sv + fl IS NOT NULL THEN 0 END AS intensity FROM u),
r AS (SELECT quantile_cont(intensity, 0.9) AS ref FROM i WHERE intensity > 0)
SELECT p_partkey, round(used, 6) AS used_land, round(1 - exp(-CASE WHEN ir + 10 > 0 THEN {pos("used / (ir + 10)")} END / 0.5), 6) AS land_use,
       round(1 - exp(-1.7 * CASE WHEN b0 > 0 THEN {pos("used / b0")} WHEN used + b0 IS NOT NULL THEN 0 END), 6) AS feasible_use,
       round(CASE WHEN al + b0 > 0 THEN least({pos("al / (al + b0)")}, 1) WHEN al + b0 IS NOT NULL THEN 0 END, 6) AS improved, round(1 - exp(-intensity / ref), 6) AS intensity FROM i, r""")
def development_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Four parts of development; the last saturates at the exact ninth decile of all positive intensities."""
    rows, (_, _, _, sv, fl, b0, rf, ir, lv, al) = fields(spark, sf)
    frame = _named(rows, {"crop": rf, "grazing": lv, "climate": F.col("p_size") % 4, "area": ir + 10, "most_crop": b0, "natural": b0, "gain": al, "w1": sv, "w2": fl})
    out = capacity.development_parts(frame, ["w1", "w2"], grazing_weight={0: 0.3, 1: 0.1}, default_weight=0.05, land_reference=0.5, use_rate=1.7)
    return rounded(out, {c: F.col(c) for c in ("used_land", "land_use", "feasible_use", "improved", "intensity")})


@query(f"""WITH {SQL} SELECT p_partkey, round(greatest(0, CASE WHEN p_size % 6 = 0 THEN 0.9 WHEN p_size % 6 = 1 THEN 0.35 ELSE 0 END, CASE WHEN p_size % 7 >= 5 THEN 0.8 WHEN p_size % 7 >= 2 THEN 0.2 ELSE 0 END,
    CASE WHEN p_partkey % 5 = 0 THEN 0.5 ELSE 0 END, CASE WHEN b > 0 THEN least(b / 0.3, 1) ELSE 0 END), 6) AS weight FROM f""")
def surface_water(spark: SparkSession, sf: str) -> DataFrame:
    rows, (b, *_) = fields(spark, sf)
    s = F.col("p_size")
    land = F.when(s % 6 == 0, "wetlands").when(s % 6 == 1, "flatland")
    return rounded(rows, {"weight": capacity.surface_water(land, {"wetlands": 0.9, "flatland": 0.35}, s % 7, {2: 0.2, 5: 0.8}, F.col("p_partkey") % 5 == 0, 0.5, b, 0.3)})


@query("""WITH p AS (SELECT p_partkey, p_size % 9 > 2 AS has_river FROM part), l AS (SELECT p_partkey, p_size % 9 - 2 AS level FROM part WHERE p_partkey % 41 > 0 UNION ALL SELECT p_partkey, 1 FROM part WHERE p_partkey % 53 = 9),
n AS (SELECT p_partkey, count(*) AS n, greatest(min(level), -1) AS level FROM l GROUP BY 1)
SELECT p_partkey, CASE WHEN n.n IS NULL THEN 'no level' WHEN n.n > 1 THEN 'several levels' WHEN level < 0 OR level > 5 THEN 'invalid level' ELSE 'presence differs' END AS fault
FROM p LEFT JOIN n USING (p_partkey) WHERE n.n IS NULL OR n.n > 1 OR level NOT BETWEEN 0 AND 5 OR (level > 0) <> has_river""")
def river_level_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Places whose level is missing, doubled, no level, or at odds with their river."""
    k, s = F.col("p_partkey"), F.col("p_size")
    part = table(spark, sf, "part")
    levels = part.where(k % 41 > 0).select("p_partkey", (s % 9 - 2).alias("level")).unionByName(part.where(k % 53 == 9).select("p_partkey", F.lit(1).alias("level")))
    return capacity.with_levels(part.select("p_partkey", (s % 9 > 2).alias("has_river")), levels, "p_partkey")[1]
