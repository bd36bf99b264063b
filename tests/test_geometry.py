"""Overlaps, polygons and distances against plain loops, with nulls, ties, repeats and empty tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraledger.functions.expr import EARTH_KM
from terraledger.operators import distance, overlap, polygons


# --- overlap -----------------------------------------------------------------
def test_overlap_keeps_the_area_of_the_whole_sphere(spark):
    lon = overlap.axis_edges(spark, 7, lambda i: -200.0 + i * (360 / 7))  # begins over the seam
    lat = overlap.axis_edges(spark, 5, lambda i: 90 - i * 36.0)
    pixels = spark.createDataFrame([(r, c, "a" if (r + c) % 2 else "b") for r in range(5) for c in range(7)], "row long, col long, entity string")
    columns, rows = overlap.axis_pieces(lon, -180.0, 24.0, 15, wrap=True), overlap.axis_pieces(lat, -90.0, 25.0, 8)
    w = overlap.overlap_weights(pixels, columns, rows, "entity")
    assert w.agg(F.sum("weight")).first()[0] == pytest.approx(4 * math.pi * EARTH_KM**2, rel=1e-12)
    areas = overlap.pixel_areas(pixels, lon, lat, "entity")
    assert [r.fault for r in overlap.area_check(w, areas, "entity").collect()] == [None, None]
    # a polar row of one cell row gets each column's width times the cap
    cap = w.where("cell_row = 7").agg(F.sum("weight")).first()[0]
    assert cap == pytest.approx(2 * math.pi * EARTH_KM**2 * (1 - math.sin(math.radians(85))), rel=1e-9)


def test_overlap_against_all_pairs(spark):
    rng = random.Random(1)
    xs = np.cumsum([0.0] + [rng.uniform(0.2, 3) for _ in range(12)]) - 5
    ys = 20 - np.cumsum([0.0] + [rng.uniform(0.2, 3) for _ in range(9)])
    side = lambda e: spark.createDataFrame([(i, float(min(a, b)), float(max(a, b))) for i, (a, b) in enumerate(zip(e[:-1], e[1:], strict=True))], "index long, lo double, hi double")
    cells = [(r, c, rng.choice(["x", "y", None])) for r in range(9) for c in range(12)]
    cells += [cells[0], cells[5]]  # repeated pixels count twice
    pixels = spark.createDataFrame(cells, "row long, col long, entity string")
    got = overlap.overlap_weights(pixels, overlap.axis_pieces(side(xs), -2.0, 1.5, 6), overlap.axis_pieces(side(ys), 5.0, 2.0, 5), "entity")
    want = {}
    for r, c, e in cells:
        for gr in range(5):
            for gc in range(6):
                dx = min(xs[c + 1], -2 + 1.5 * (gc + 1)) - max(xs[c], -2 + 1.5 * gc)
                lo, hi = max(ys[r + 1], 5 + 2.0 * gr), min(ys[r], 5 + 2.0 * (gr + 1))
                if e and dx > 0 and hi > lo:
                    want[e, gr, gc] = want.get((e, gr, gc), 0) + EARTH_KM**2 * math.radians(dx) * (math.sin(math.radians(hi)) - math.sin(math.radians(lo)))
    found = {(r.entity, r.cell_row, r.cell_col): r.weight for r in got.collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(v, rel=1e-9) for k, v in want.items())
    # the grid covers a part only: the check names those that lose area, miss pixels, or aren't listed
    listed = spark.createDataFrame([("x", 1), ("z", 2)], "entity string, pixel_count long")
    faults = {r.entity: r.fault for r in overlap.area_check(got, overlap.pixel_areas(pixels, side(xs), side(ys), "entity"), "entity", inventory=listed).collect()}
    assert faults == {"x": "pixel count", "y": "not listed", "z": "no pixels"}
    assert {r.fault for r in overlap.area_check(got, overlap.pixel_areas(pixels, side(xs), side(ys), "entity"), "entity").collect()} == {"area"}
    assert overlap.overlap_weights(pixels.limit(0), overlap.axis_pieces(side(xs), -2.0, 1.5, 6), overlap.axis_pieces(side(ys), 5.0, 2.0, 5), "entity").count() == 0


def test_axis_faults(spark):
    edges = spark.createDataFrame([(0, 0.0, 1.0), (1, 1.0, 1.0), (2, 1.5, 2.0), (3, 2.0, None)], "index long, lo double, hi double")
    found = lambda e: {r["index"]: r["fault"] for r in overlap.axis_faults(e).collect()}
    assert found(edges) == {1: "empty", 3: "unknown"}
    assert found(overlap.axis_edges(spark, 20, lambda i: 90 - 9.0 * i)) == {}
    assert found(overlap.axis_edges(spark, 6, lambda i: (i - 2) * (i - 2) * 1.0)) == {0: "turned", 1: "apart"}
    assert found(edges.where("index in (0, 2)").withColumn("index", F.col("index") / 2)) == {0: "apart"}


# --- polygons ----------------------------------------------------------------
SHAPE = "k long, rings array<array<struct<x:double,y:double>>>, z int, row int"


def inside(rings, x, y):
    """Even-odd rule, lower ends counting."""
    n = 0
    for ring in rings:
        if len(ring) < 3:
            continue
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            # a centre line is crossed from its upper edge: rows count downwards
            if min(-y1, -y2) <= -y < max(-y1, -y2) and x1 + (y - y1) / (y2 - y1) * (x2 - x1) <= x:
                n += 1
    return n % 2 == 1


def test_polygons_against_every_centre(spark):
    frame = polygons.Frame(-3.0, 8.0, 0.5, 0.5, 24, 30)
    rng = random.Random(3)
    star = lambda cx, cy, r, n: [(cx + r * rng.uniform(0.4, 1) * math.cos(2 * math.pi * i / n), cy + r * rng.uniform(0.4, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    shapes = [
        (1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]), (2, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)]]),
        (3, [[(0.25, 0.25), (4.25, 0.25), (4.25, 4.25), (0.25, 4.25)]]),  # corners and edges on centres
        (4, [star(2, 2, 3, 11), star(8, 3, 2, 7), star(2, 2, 0.8, 5)]), (5, [star(-4, 9, 5, 9)]), (6, [[(0.0, 0.0), (1.0, 1.0)]]), (7, []), (8, [[]]),
        (9, [[(2.0, 2.0), (2.0, 2.0), (2.0, 2.0)]]), (1, [[(9.0, 6.0), (10.0, 6.0), (10.0, 7.0), (9.0, 7.0)]]), (10, [star(30, 30, 3, 6)]),
    ]
    df = spark.createDataFrame([(k, [[{"x": x, "y": y} for x, y in ring] for ring in rings], 0, 1) for k, rings in shapes] + [(11, None, 0, 1)], SHAPE)
    got = sorted((r.k, r.row, r.col) for r in polygons.polygon_cells(df.select("k", "rings"), "k", frame).collect())
    by = {}
    for k, rings in shapes:
        by.setdefault(k, []).extend(rings)  # rows of one key are one shape
    want = sorted((k, r, c) for k, rings in by.items() for r in range(24) for c in range(30) if inside(rings, -3 + (c + 0.5) * 0.5, 8 - (r + 0.5) * 0.5))
    assert got == want and len(want) > 250
    assert polygons.polygon_cells(df.limit(0), "k", frame).count() == 0
    bad = spark.createDataFrame([(1, [[{"x": 0.0, "y": 0.0}, {"x": None, "y": 1.0}, {"x": 1.0, "y": 0.0}]], 0, 1)], SHAPE)
    with pytest.raises(Exception, match="unknown point"):
        polygons.polygon_cells(bad, "k", frame).count()


def test_burned_shapes_follow_the_order(spark):
    frame = polygons.Frame(0.0, 4.0, 1.0, 1.0, 4, 4)
    box = lambda a, b: [[{"x": a, "y": a}, {"x": b, "y": a}, {"x": b, "y": b}, {"x": a, "y": b}]]
    df = spark.createDataFrame([(1, box(0.0, 3.0), 5), (2, box(1.0, 4.0), 5), (3, box(2.0, 3.0), 1)], "k long, rings array<array<struct<x:double,y:double>>>, z int")
    got = {(r.row, r.col): r.k for r in polygons.burned(df, "k", "z", frame).collect()}
    assert got[2, 2] == 2 and got[3, 0] == 1 and got[0, 3] == 2 and got[1, 2] == 2 and len(got) == 14


def test_hulls(spark):
    rng = random.Random(8)
    points = {k: [(rng.randint(0, 9) * 1.0, rng.randint(0, 9) * 1.0) for _ in range(n)] for k, n in enumerate((3, 6, 12, 60))}
    points[4], points[5], points[6], points[7] = [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], [(1.0, 1.0)] * 4, [(0.0, 0.0), (0.0, 2.0), (2.0, 0.0), (2.0, 2.0), (1.0, 1.0)], [(0.0, 0.0), (0.0, 5.0)]
    df = spark.createDataFrame([(k, x, y) for k, ps in points.items() for x, y in ps] + [(8, None, 1.0)], "k long, x double, y double")
    got = {r.k: [(p.x, p.y) for p in r.rings[0]] for r in polygons.convex_hulls(df, "k").collect()}
    for k, ps in points.items():
        turn = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
        corners = {p for p in ps if any(p != q and all(turn(p, q, c) > 0 or (turn(p, q, c) == 0 and (c[0] - p[0]) * (q[0] - p[0]) + (c[1] - p[1]) * (q[1] - p[1]) >= 0 and abs(c[0] - p[0]) + abs(c[1] - p[1]) <= abs(q[0] - p[0]) + abs(q[1] - p[1])) for c in ps) for q in ps)}
        if len(corners) < 3:
            assert k not in got
            continue
        ring = got[k]
        assert set(ring) == corners and len(ring) == len(corners)
        assert all(turn(ring[i - 2], ring[i - 1], ring[i]) > 0 for i in range(len(ring)))


# --- distances ---------------------------------------------------------------
def test_nearest_cells_against_all_pairs(spark):
    rng = random.Random(6)
    for share in (0.02, 0.3):
        at = sorted({(rng.randint(-5, 40), rng.randint(3, 33)) for _ in range(500)})
        rows = [(r, c, True if rng.random() < share else rng.choice([False, None])) for r, c in at]
        df = spark.createDataFrame([*rows, rows[0]], "row long, col long, ok boolean")
        got = {(r.row, r.col): (r.from_row, r.from_col, r.distance) for r in distance.nearest_valid_cell(df, F.col("ok")).collect()}
        good = [(r, c) for r, c, ok in rows if ok]
        assert len(got) == len(rows)
        for r, c, _ in rows:
            d2, a, b = min(((r - x) ** 2 + (c - y) ** 2, x, y) for x, y in good)
            assert got[r, c] == (a, b, pytest.approx(math.sqrt(d2)))
        km = {(r.row, r.col): r.distance for r in distance.nearest_valid_cell(df, F.col("ok"), row_scale=9.0, col_scale=9.0 * F.cos(F.col("row") / 40.0)).collect()}
        for r, c, _ in rows:
            assert km[r, c] == pytest.approx(min(math.hypot((r - x) * 9.0, (c - y) * 9.0 * math.cos(r / 40)) for x, y in good))
    assert distance.nearest_valid_cell(df, F.lit(False)).count() == 0 and distance.nearest_valid_cell(df.limit(0), F.col("ok")).count() == 0


def test_ways_between_columns_that_shrink_to_nothing_and_turn(spark):
    rng = random.Random(8)
    at = sorted({(rng.randint(0, 300), rng.randint(0, 12)) for _ in range(700)})
    rows = [(r, c, rng.random() < 0.1) for r, c in at]
    # rows beyond the pole, and one at which all columns are one place
    wide = lambda r: 0.0 if r == 90 else 9.0 * math.cos(math.radians(r))
    scale = F.when(F.col("row") == 90, 0.0).otherwise(9.0 * F.cos(F.radians(F.col("row"))))
    found = distance.nearest_valid_cell(spark.createDataFrame(rows, "row long, col long, ok boolean"), F.col("ok"), row_scale=9.0, col_scale=scale).collect()
    good = [(r, c) for r, c, ok in rows if ok]
    assert len(found) == len(rows)
    for f in found:
        assert f.distance == pytest.approx(min(math.hypot((f.row - x) * 9.0, (f.col - y) * wide(f.row)) for x, y in good), abs=1e-9)


def test_running_nearest_rows_only_grow(spark):
    cells = spark.createDataFrame([(1, 1, 1.0)], "row long, col long, value double").withColumn("zone", F.lit(1))
    for df in (distance.nearest_fill(cells, "value"), distance.deepest_cells(cells, "zone")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # a frame from each row to the end of its column takes the square of the column's length
        assert "currentrow$(), unboundedfollowing" not in plan


def test_envelope_keeps_those_that_touch():
    rng = random.Random(9)
    for _ in range(300):
        at = sorted(rng.sample(range(30), rng.randint(1, 12)))
        up = np.array([rng.randint(0, 6) ** 2 for _ in at])
        source = np.array([rng.randint(0, 5) for _ in at])
        asked = np.arange(-3, 34)
        best, d2 = distance._nearest_in_row(np.array(at), up, source, asked)
        for x, k, d in zip(asked.tolist(), best.tolist(), d2.tolist(), strict=True):
            want = min(((x - a) ** 2 + u, s, a) for a, u, s in zip(at, up.tolist(), source.tolist(), strict=True))
            assert (d, source[k], at[k]) == want


def test_depths_against_all_pairs(spark):
    rng = random.Random(2)
    zone = {(r, c): rng.choice(["a", "a", "a", "b", None]) if rng.random() < 0.1 else ("a" if c < 11 else "b") for r in range(14) for c in range(19) if rng.random() < 0.97}
    df = spark.createDataFrame([(r, c, z) for (r, c), z in zone.items()], "row long, col long, z string")
    got = {(r.row, r.col): r.depth for r in distance.depth_in_zone(df, "z").collect()}
    around = [(r, c) for r in range(-1, 15) for c in range(-1, 20)]
    for (r, c), z in zone.items():
        if z is not None:
            assert got[r, c] == min(abs(r - x) + abs(c - y) for x, y in around if zone.get((x, y)) != z)
    deep = {r.zone: (r.depth, -r.row, -r.col) for r in distance.deepest_cells(df, "z").collect()}
    assert deep == {z: max((d, -r, -c) for (r, c), d in got.items() if zone[r, c] == z) for z in ("a", "b")}
    assert distance.deepest_cells(df.limit(0), "z").count() == 0
