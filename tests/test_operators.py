import math
import os

import pytest
from pyspark.sql import functions as F

from terraledger.functions import expr
from terraledger.operators import aggregates as ag
from terraledger.operators import distance, fits, graph, grid, tiles
from terraledger.plans import registry
from terraledger.sources.tables import cell_of

DATA = "/root/testdata/sf0.001"


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_missing_is_not_zero(spark):
    r = one(spark, a=expr.best(F.lit(1.0), F.lit(None).cast("double")), b=expr.guarded(F.lit(1.0), F.lit(0.0)), c=expr.scale_yield(F.lit(-1.0), 2.0, 0.5, 4.0), d=expr.grade(F.lit(None).cast("double"), F.array(F.lit(1.0))))
    assert (r.a, r.b, r.c, r.d) == (None, None, None, 0)


def test_grades_are_lower_inclusive(spark):
    bounds = F.array(*[F.lit(x) for x in (1.5, 3.0, 4.5, 6.0)])
    rows = spark.createDataFrame([(0.0,), (1.5,), (1.49,), (3.0,), (9.0,), (None,)], "v double")
    assert [r.g for r in rows.select(expr.grade(F.col("v"), bounds).alias("g")).collect()] == [1, 2, 1, 3, 5, 0]
    q = ag.quantile_bounds(spark.range(0, 16).select(F.col("id").cast("double").alias("v")), "v", (0.2, 0.4, 0.6, 0.8)).first().bounds
    assert q == pytest.approx([3.0, 6.0, 9.0, 12.0])


def test_overlap_mean_and_coverage(spark):
    cells = spark.createDataFrame([(0, 6.0), (1, None), (2, 1.0), (3, 11.0), (4, 2.0), (5, None)], "cell int, v double")
    overlap = spark.createDataFrame([(0, c, 1.0) for c in range(6)] + [(1, 1, 2.0), (1, 5, 3.0)], "entity int, cell int, w double")
    got = {r.entity: r for r in ag.overlap_mean(overlap, cells, "entity", "cell", "w", "v").collect()}
    assert got[0].mean_value == pytest.approx(5.0) and got[0].coverage == pytest.approx(4 / 6)
    assert got[1].mean_value is None and got[1].coverage == 0


def test_conversion_keeps_sums(spark):
    r = one(spark, g=expr.convert(F.lit(0.125), 1.0, 1 / 3), big=expr.convert(F.lit(8.0), 1.0, 1 / 3))
    assert r.g == pytest.approx(0.5) and r.big == pytest.approx(8.0)


def test_clamp_fold(spark):
    r = one(spark, p=expr.clamp_fold(F.array(F.lit(60.0), F.lit(80.0), F.lit(-150.0)), F.lit(0.0), 0.0, 100.0))
    assert r.p == [60.0, 100.0, 0.0]


def test_et0_is_positive_in_summer(spark):
    args = [F.lit(x) for x in (45.0, 200.0, 14.0, 28.0, 1.5, 2.0, 24000.0)]
    r = one(spark, july=expr.reference_et0(F.lit(6), *args), january=expr.reference_et0(F.lit(0), F.lit(45.0), F.lit(200.0), F.lit(-5.0), F.lit(2.0), F.lit(0.5), F.lit(2.0), F.lit(4000.0)))
    assert 150 < r.july < 220 and 0 <= r.january < 30


def test_band_area_adds_up(spark):
    r = one(spark, a=expr.band_area_km2(F.lit(-90.0), F.lit(90.0), F.lit(360.0)))
    assert r.a == pytest.approx(4 * math.pi * expr.EARTH_KM**2)


def test_point_sampling(spark):
    r = one(spark, a=cell_of(F.lit(-180.0), F.lit(90.0), 180, 360), b=cell_of(F.lit(179.9), F.lit(-90.0), 180, 360))
    assert (r.a, r.b) == (0, 180 * 360 - 1)


def test_nearest_valid_breaks_ties_by_row(spark):
    cells = spark.createDataFrame([(0, 1, 5.0), (1, 1, None), (2, 1, 7.0), (9, 9, None)], "row long, col long, value double")
    got = {(r.row, r.col): r.filled for r in tiles.nearest_valid(cells, "value", 2).collect()}
    assert got[(1, 1)] == 5.0 and got[(9, 9)] is None


def test_nearest_donor_matches_brute_force(spark):
    pts = [(i, (i * 7919 % 36000) / 100 - 180, (i * 104729 % 18000) / 100 - 90) for i in range(60)]
    df = spark.createDataFrame(pts, "k long, lon double, lat double")

    def km(a, b):
        p, q = map(math.radians, (a[2], b[2]))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * expr.EARTH_KM * math.asin(math.sqrt(min(1, h)))

    got = {r.k: r for r in grid.nearest_donor(df.where("k % 3 = 0"), df.where("k % 3 <> 0"), "k").collect()}
    for t in pts[::3]:
        assert got[t[0]].km == pytest.approx(min(km(t, d) for d in pts if d[0] % 3), rel=1e-6)


def test_knn_in_blocks(spark):
    rows = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)], "id long, vec array<double>")
    got = {(r.q, r.place): r.s for r in grid.knn(rows, rows, 2, block=3).collect()}
    assert got[(0, 1)] == 1 and got[(5, 1)] == 4 and got[(5, 2)] == 6


def test_forest(spark):
    nodes = spark.createDataFrame([(11, 3, 1.0), (3, 7, 2.0), (7, None, 3.0), (21, None, 4.0)], "id long, down_id long, v double")
    assert {r.id: r.total for r in graph.accumulate(nodes, "v").collect()} == {11: 1.0, 3: 3.0, 7: 6.0, 21: 4.0}
    assert {r.id for r in graph.downstream_closure(nodes, nodes.where("id = 11")).collect()} == {11, 3, 7}
    assert graph.dangling(nodes).count() == 0
    assert {r.id: r.level for r in graph.heights(nodes).collect()} == {11: 0, 3: 1, 7: 2, 21: 0}
    assert {(r.id, r.head, r.place) for r in graph.stem_heads(nodes, "v").collect()} == {(7, 7, 0), (3, 7, 1), (11, 7, 2), (21, 21, 0)}
    for bad in ([(1, 2), (2, 1), (3, 1)], [(1, 9)], [(1, None), (1, None)]):  # a cycle, a link to nowhere, a repeated id
        with pytest.raises(ValueError):
            graph.heights(spark.createDataFrame(bad, "id long, down_id long"))
    assert graph.accumulate(nodes.limit(0), "v").count() == 0


def test_a_long_chain_needs_few_rounds(spark):
    n = 2000
    nodes = spark.range(n).select("id", F.when(F.col("id") < n - 1, F.col("id") + 1).alias("down_id"), F.lit(1.0).alias("v"), F.lit(7).alias("_next"))
    got = {r.id: (r.total, r.upstream) for r in graph.accumulate(nodes, "v").collect()}
    assert got == {i: (i + 1.0, i + 1) for i in range(n)}
    assert {r.id for r in graph.downstream_closure(nodes, nodes.where("id = 1990")).collect()} == set(range(1990, n))


def test_route_serves_upstream_first(spark):
    schema = "id long, down_id long, runoff double, demand double, survival double"
    nodes = spark.createDataFrame([(0, 1, 100.0, 30.0, 1.0), (1, 2, 0.0, 100.0, 1.0), (2, None, 20.0, 100.0, 1.0)], schema)
    routed = graph.route(nodes, "runoff", "demand", 0.6)
    assert {r.id: r.allocated for r in routed.collect()} == pytest.approx({0: 30.0, 1: 10.0, 2: 8.0})
    assert graph.route_balance(routed, nodes).first().residual == pytest.approx(0)
    lossy = spark.createDataFrame([(0, 1, 100.0, 10.0, 1.0), (1, 2, 0.0, 0.0, 0.5), (2, None, 0.0, 15.0, 1.0)], schema)
    routed = graph.route(lossy, "runoff", "demand", 0.6, "survival")
    assert [v for r in routed.orderBy("id").collect() for v in (r.allocated, r.lost)] == pytest.approx([10.0, 0.0, 0.0, 15.0, 15.0, 0.0])
    months = spark.createDataFrame([(0, 1, 0, 10.0, 0.0), (0, 1, 1, 0.0, 0.0), (1, None, 0, 0.0, 0.0), (1, None, 1, 0.0, 20.0)], "id long, down_id long, month int, runoff double, demand double")
    assert {r.allocated for r in graph.route(months, "runoff", "demand", 0.0, by=["month"]).collect()} == {0.0}  # nothing is carried over
    with pytest.raises(ValueError):
        graph.route(nodes.withColumn("runoff", -F.col("runoff")), "runoff", "demand")
    assert graph.route(nodes.limit(0), "runoff", "demand").count() == 0


def test_bounded_fit_is_optimal(spark):
    rows = spark.createDataFrame([(float(i % 5), 3.0 - 2.0 * (i % 5) + 0.1 * (i % 3)) for i in range(60)], "x double, y double")
    free = fits.ridge(rows, [F.col("x")], F.col("y"))
    held = fits.box_ridge(rows, [F.col("x")], F.col("y"), [0.0], [9.0])
    assert free[1] == pytest.approx(-2, abs=0.05) and held[1] == 0.0


def test_folds_are_balanced():
    folds = fits.balanced_folds({"a": 5, "b": 4, "c": 3, "d": 2}, 2)
    assert sorted(sum(n for k, n in {"a": 5, "b": 4, "c": 3, "d": 2}.items() if folds[k] == f) for f in (0, 1)) == [7, 7]


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = registry.QUERIES[name](spark, DATA)
    got = con.execute(registry.ORACLE[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    norm = lambda v: float(f"{v + 0.0:.8g}") if isinstance(v, float) else v
    key = lambda r: [(v is None, str(v)) for v in r]
    want = sorted((tuple(norm(v) for v in r) for r in got.fetchall()), key=key)
    have = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=key)
    assert have == want


def test_walks_and_folds_raise_where_they_would_be_cut(spark, tmp_path):
    from terraledger.operators import graph
    from terraledger.plans import fits

    chain = spark.createDataFrame([(i, i + 1 if i < 5 else None) for i in range(6)], "id long, down_id long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(5)], "a long, b long")
    first = chain.where("id = 0").select("id")
    assert graph.downstream_closure(chain, first).count() == graph.distances(edges, first).count() == 6
    with pytest.raises(RuntimeError):
        graph.distances(edges, first, most=3)
    spark.range(10_001).selectExpr("cast(id as int) as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    with pytest.raises(ValueError):
        fits.region_folds(spark, str(tmp_path))


def test_contracts_are_written_and_checked(spark, tmp_path):
    from terraledger.sources import sinks

    a = spark.createDataFrame([(1, 0.1, "nan"), (2, None, ""), (3, float("nan"), None)], "id int, v double, tag string")
    sinks.write_contract({"a": a, "b": spark.range(3)}, str(tmp_path), "v1")
    assert sinks.broken(spark, str(tmp_path), "v1").count() == 0
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/v1/b")
    assert [tuple(r) for r in sinks.broken(spark, str(tmp_path), "v1").collect()] == [("b", "content")]
    # digests do not depend on the order of rows, but on every value and on repeats
    assert sinks.fingerprint(a) == sinks.fingerprint(a.orderBy(F.desc("id")).repartition(3))
    assert len({sinks.fingerprint(x) for x in (a, a.limit(2), a.unionByName(a), a.withColumn("v", F.lit(1.0)), a.limit(0))}) == 5
    assert sinks.stamp({"a": a}, {"k": 1}, "1") != sinks.stamp({"a": a}, {"k": 2}, "1")
    rows = [tuple(r) for r in sinks.fixed_digits(a, 3).orderBy("id").collect()]
    assert rows == [(1, "0.1", "nan"), (2, None, ""), (3, None, None)]


def test_checks_refuse(spark):
    from terraledger.operators import checks

    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(1, "A"), (3, "C")], "k int, y string")
    got = {(r.k, r.issue) for r in checks.one_to_one(left, right, "k").collect()}
    assert got == {(2, "left_repeats"), (2, "right_missing"), (3, "left_missing"), (None, "right_missing")}
    with pytest.raises(ValueError):
        checks.joined_one_to_one(left, right, "k")
    assert checks.joined_one_to_one(left.where("k = 1"), right.where("k = 1"), "k").count() == 1
    assert checks.entity_contract(left.limit(0), "k", right.limit(0), ["x"], {}).count() == 0


def test_fit_rules():
    assert fits.rounded_values([10.0, -120.0, 35.0], [[1], [2]], 50).tolist() == [100.0, -100.0, 50.0]
    assert fits.rounded_values([260.0, -120.0, 35.0], [[1], [2]], 50).tolist() == [250.0, -100.0, 50.0]
    assert fits.sensible({"a": 3.0, "b": 5.0, "c": -1.0}, at_most={"a": 2.0}, falling=[["a", "b", "c"]], signs={"c": 1}) == ["bound:a", "order:a>b", "sign:c"]


def test_nearest_fill_reaches_any_distance(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (500, 3, None), (500, 900, 2.0), (2000, 0, None)], "row long, col long, value double")
    got = {(r.row, r.col): (r.filled, r.distance) for r in distance.nearest_fill(cells, "value").collect()}
    assert got[(500, 3)] == (1.0, pytest.approx(math.hypot(500, 3))) and got[(2000, 0)][0] == 2.0 and got[(0, 0)] == (1.0, None)
    empty = distance.nearest_fill(cells.withColumn("value", F.lit(None).cast("double")), "value").collect()
    assert len(empty) == 4 and all(r.filled is None for r in empty)


def test_lattice_breaks_at_unknown_points_and_the_seam(spark):
    from terraledger.operators import lines

    rows = [(1, 0, 0.0, 0.0, "a"), (1, 1, 2.0, 1.0, "b"), (1, 2, None, 1.0, "c"), (1, 3, 9.0, 1.0, "d"), (1, 4, 0.0, 1.0, "e"), (2, 0, 3.0, 3.0, "f"), (3, 0, 1.0, -1.0, "g"), (3, 1, 1.0, 1.0, "h"), (4, 0, float("nan"), 0.0, "i"), (4, 1, 1.0, 1.0, "j")]
    points = spark.createDataFrame(rows, "line long, order int, x double, y double, step string")
    got = sorted(tuple(r) for r in lines.lattice_cells(points, "line", "order", 10, 10).collect())
    assert got == [(1, 1, 0, 0, 0, True), (1, 1, 1, 1, 0, False), (1, 1, 2, 1, 1, False), (1, 1, 3, 2, 1, False), (3, 1, 1, 1, 0, True), (3, 1, 2, 1, 1, False)]
    assert lines.lattice_cells(points.limit(0), "line", "order", 10, 10).count() == 0


def test_registration_goes_there_and_back(spark):
    from terraledger.operators import lines

    map_ = lines.Registration(5.0, 5.0, (0.0, 100.0), 5.0, 5.0, (0.0, -60.0, 2.0), 11)
    at = [(float(x), float(y), map_.longitude(float(x)), map_.latitude(float(y))) for x in (0, 3, 10) for y in (0, 4, 10)]
    points = spark.createDataFrame([*at, (0.0, None, -100.0, 89.0), (0.0, None, -100.0, None)], "x double, y double, lon double, lat double")
    got = map_.pixels(points, "lon", "lat").collect()
    assert len(got) == 11
    assert all(abs(r["px"] - r["x"]) < 1e-9 and (r["py"] is None if r["y"] is None else abs(r["py"] - r["y"]) < 1e-9) for r in got)
    with pytest.raises(ValueError, match="fall"):
        map_._replace(lat=(0.0, 60.0)).pixels(points, "lon", "lat")


def test_blocks_that_never_close_are_missing(spark):
    from terraledger.functions import text

    rows = spark.createDataFrame([(None,), ("",), ("a = { b = { } ",), ("xa = { }",), ("a={}",), ("b = { soil = p }\nc = { soil = q }\nb = { soil = r }\nd = { }",)], "t string")
    got = rows.select(text.block_span(F.col("t"), "a").alias("s"), text.block_values(F.col("t"), "soil").alias("v")).collect()
    assert [r["s"] and tuple(r["s"]) for r in got] == [None, None, None, None, (1, 4), None]
    assert got[0]["v"] is None and got[1]["v"] == {} and got[5]["v"] == {"c": "q", "b": "r"}


def test_routes_of_every_shape_match_a_walk(spark):
    import random

    rng = random.Random(1)

    def walked(rows, protected):
        above = {}
        for i, down, *_ in rows:
            above.setdefault(down, []).append(i)
        own, order, open_ = {r[0]: r for r in rows}, [], [r[0] for r in rows if r[1] is None]
        while open_:
            order.append(open_.pop())
            open_ += above.get(order[-1], [])
        inflow, out = {}, {}
        for x in reversed(order):
            _, down, runoff, demand, survival = own[x]
            flow = runoff * (1 - protected) + inflow.get(x, 0.0)
            given = min(flow * survival, demand)
            out[x] = (given, flow * (1 - survival), max(flow * survival - given, 0.0))
            inflow[down] = inflow.get(down, 0.0) + out[x][2]
        return out

    n = 600
    shapes = {
        "chain": [i + 1 if i < n - 1 else None for i in range(n)], "star": [0 if i else None for i in range(n)], "comb": [i + 2 if i % 2 == 0 and i + 2 < n else i - 1 if i % 2 else None for i in range(n)],
        "mixed": [rng.choice([i - 1, i - 1, i - 1, rng.randrange(max(0, i - 30), i)]) if i % 200 else None for i in range(n)], "alone": [None] * 20,
    }
    for down in shapes.values():
        rows = [(i, d, rng.uniform(0, 10), rng.choice([0.0, rng.uniform(0, 12)]), rng.uniform(0.8, 1)) for i, d in enumerate(down)]
        got = graph.route(spark.createDataFrame(rows, "id long, down_id long, runoff double, demand double, survival double"), "runoff", "demand", 0.5, "survival")
        assert {r.id: (r.allocated, r.lost, r.outflow) for r in got.collect()} == {k: pytest.approx(v, abs=1e-9) for k, v in walked(rows, 0.5).items()}
    cycle = [(0, 1), (1, 2), (2, 1), (3, None)], [(0, 5)], [(0, None), (0, None)], [(0, 1), (1, 0)]
    for bad in cycle:
        with pytest.raises(ValueError):
            graph.route(spark.createDataFrame([(*r, 1.0, 1.0) for r in bad], "id long, down_id long, runoff double, demand double"), "runoff", "demand")


def test_routes_of_few_levels_are_those_of_a_walk_to_the_last_bit(spark):
    n, inflow, want = 700, [0.0] * 700, {}
    rows = [(i, (i - 1) // 2 if i else None, float(1 + i * 7 % 50), float(i % 11), 1 - (i % 5) / 50.0) for i in range(n)]
    for i, down, runoff, demand, survival in reversed(rows):
        left = (runoff * 0.5 + inflow[i]) * survival
        want[i] = max(left - min(left, demand), 0.0)
        if down is not None:
            inflow[down] += want[i]
    got = graph.route(spark.createDataFrame(rows, "id long, down_id long, runoff double, demand double, survival double"), "runoff", "demand", 0.5, "survival")
    assert {r.id: r.outflow for r in got.collect()} == want


def test_rounding_goes_by_the_scaled_double(spark):
    duckdb = pytest.importorskip("duckdb")
    values = [127.89734999999999, 124.12684999999999, 202.76115, 242.02994999999999, -124.12684999999999, 0.00005, 1e308, math.inf, None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(expr.scaled_round(F.col("v"), 4).alias("r"), F.round("v", 4).alias("own")).collect()
    assert [r.r for r in got] == [duckdb.execute("SELECT round(CAST(? AS DOUBLE), 4)", [v]).fetchall()[0][0] for v in values]
    assert [r.r == r.own for r in got[:5]] == [False] * 5


def test_one_sided_ids_broadcast_nothing(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,), (None,)], "id long")
    right = spark.createDataFrame([(3,), (3,), (4,), (4,), (None,)], "id long")
    found = ag.one_sided(left, right)
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted([(1, "missing"), (2, "missing"), (2, "missing"), (None, "missing"), (None, "missing"), (4, "extra"), (None, "extra")], key=str)
    assert ag.one_sided(left.limit(0), right.limit(0)).count() == 0
    plan = registry.QUERIES["set_equality"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
