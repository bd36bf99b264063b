"""Neighbours, transfers and tiles against plain loops, with nulls, ties, repeats and empty tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraledger.operators import grid, tiles, transfer
from terraledger.operators.neighbours import knn
from terraledger.plans import registry


def nearest(x, ids, k, groups=None):
    out = {}
    for i, v in enumerate(x):
        found = sorted((float(((v - w) ** 2).sum()), ids[j]) for j, w in enumerate(x) if ids[j] != ids[i] and (groups is None or groups[i] == groups[j]))
        out[ids[i]] = [s for _, s in found[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.q, r.place)):
        out.setdefault(r.q, []).append(r.s)
    return out


def test_neighbours_match_all_pairs(spark):
    rng = np.random.RandomState(0)
    centre = rng.randn(30, 3) * 5
    x = centre[rng.randint(0, 30, 900)] + rng.randn(900, 3) * 0.2
    x[:150] = x[0]  # a heap of equal places
    groups = [None if i % 50 == 0 else "big" if i % 3 else f"g{i % 9}" for i in range(900)]
    rows = spark.createDataFrame([(i, v.tolist(), groups[i]) for i, v in enumerate(x)], "id long, vec array<double>, g string")
    visited = []
    got = found(knn(rows, rows, 4, small=100, block=64, visited=visited))
    assert got == nearest(x, list(range(900)), 4)
    pairs = sum(v.count() for v in visited)
    assert pairs < 900 * 8  # cells that a query looks into, of about thirty
    assert found(knn(rows, rows, 4, group="g", small=100, block=64)) == {k: v for k, v in nearest(x, list(range(900)), 4, groups).items() if v}
    few = rows.where("id in (200, 201)")
    assert found(knn(few, few, 5)) == {200: [201], 201: [200]} and found(knn(few, rows.limit(0), 5)) == {} and found(knn(few.limit(0), few, 5)) == {}


def test_the_share_of_pairs_falls(spark):
    rng = np.random.RandomState(1)

    def share(n):
        x = (rng.randint(0, 40, (n, 2)) * 3.0) + rng.randn(n, 2) * 0.1
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
        seen = []
        knn(rows, rows, 3, small=200, visited=seen).count()
        cells = len({r.cell for v in seen for r in v.select("cell").distinct().collect()})
        return sum(v.count() for v in seen) / (n * cells)

    assert share(4000) < 0.6 * share(500)


def test_kernel_leaves_out_what_is_unknown(spark):
    schema = "id long, lon double, lat double, climate array<double>, values array<double>"
    rng = random.Random(3)
    rows = [(i, rng.uniform(0, 10), rng.uniform(0, 10), [rng.gauss(0, 2), rng.gauss(5, 3)], [rng.choice([0.0, rng.uniform(0, 9)])]) for i in range(60)]
    rows += [(100, 5.0, 5.0, [None, 1.0], [3.0]), (101, None, 5.0, [0.0, 1.0], [3.0]), (102, 5.0, 5.0, [0.0, 1.0], [float("nan")]), (103, 5.0, 5.0, None, [1.0])]
    asked = [(200, 4.0, 4.0, [0.0, 5.0], None), (201, 90.0, 80.0, [0.0, 5.0], None), (202, 4.0, 4.0, [None, 5.0], None), (203, 4.0, None, [0.0, 5.0], None)]
    got = {r.id: r.estimate[0] for r in transfer.conditioned_kernel(spark.createDataFrame(asked, schema), spark.createDataFrame(rows, schema), features=2, values=1, strength=1.0, k=8).collect()}
    at = lambda lon, lat: np.array([math.cos(math.radians(lat)) * math.cos(math.radians(lon)), math.cos(math.radians(lat)) * math.sin(math.radians(lon)), math.sin(math.radians(lat))]) * 6371.0088
    sound = rows[:60]
    spread = np.maximum(np.std([r[3] for r in sound], axis=0), 0.1)
    near = sorted((float(np.linalg.norm(at(*r[1:3]) - at(4.0, 4.0))), r) for r in sound)[:8]
    w = [math.exp(-np.mean(((np.array(r[3]) - [0.0, 5.0]) / spread) ** 2) - 0.5 * (d / 200) ** 2) * (d <= 600) for d, r in near]
    assert got == {200: pytest.approx(sum(a * r[4][0] for a, (_, r) in zip(w, near, strict=True)) / sum(w))}
    assert transfer.conditioned_kernel(spark.createDataFrame(asked, schema), spark.createDataFrame(rows, schema).limit(0), features=2, values=1, strength=1.0).count() == 0


def test_medians_stay_in_their_group(spark):
    rows = [(i, float(i), 0.0, "a" if i < 5 else "b", None if i == 2 else float(i * i)) for i in range(10)] + [(10, 4.4, 0.0, None, 7.0), (11, 50.0, 0.0, "a", None)]
    df = spark.createDataFrame(rows, "id long, x double, y double, g string, v double")
    got = {r.id: (r.smoothed, r.used) for r in transfer.group_median(df, 4, group="g", value="v").collect()}
    for i, x, _, g, v in rows:
        near = sorted(((x - r[1]) ** 2, r[0]) for r in rows if r[0] != i)[:3]
        own = [r[4] for r in rows if r[0] in {s for _, s in near} and r[3] == g and g is not None and r[4] is not None] + ([v] if v is not None else [])
        assert got[i] == (float(np.median(own)) if own else None, len(own))
    assert {r.smoothed for r in transfer.group_median(df, 1, group="g", value="v").where("id = 3").collect()} == {9.0}


def test_tiles_give_what_loops_give(spark):
    rng = random.Random(4)
    at = {(r, c): rng.choice([None, float(rng.randint(0, 20))]) for r in range(-7, 20) for c in range(3, 30) if rng.random() < 0.8}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in at.items()], "row long, col long, v double")
    extra = df.withColumn("filled", F.col("row") * 2)
    for size in (4, 9, 64):
        hi = {(r.row, r.col): r.moving_range for r in tiles.moving_extreme(df, "v", 2, size).collect()}
        steps = {(r.row, r.col): r.gradient for r in tiles.gradient(df, "v", size).collect()}
        near = {(r.row, r.col): (r["v"], r["filled"], r["distance"]) for r in tiles.nearest_valid(df, "v", 3, size).collect()}
        assert len(hi) == len(steps) == len(near) == len(at)
        for (r, c), v in at.items():
            around = [at[x, y] for x in range(r - 2, r + 3) for y in range(c - 2, c + 3) if at.get((x, y)) is not None]
            assert hi[r, c] == (max(around) - min(around) if around else None)
            beside = [abs(at[p] - v) for p in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)) if v is not None and at.get(p) is not None]
            assert steps[r, c] == max(beside, default=None)
            best = min((((x - r) ** 2 + (y - c) ** 2, x, y) for x in range(r - 3, r + 4) for y in range(c - 3, c + 4) if at.get((x, y)) is not None), default=None) if v is None else None
            assert near[r, c] == (v, v if v is not None else at[best[1:]] if best else None, math.sqrt(best[0]) if best else None)
    laid = tiles.with_border(df, 2, 9)
    assert laid.groupBy("row", "col").count().agg(F.max("count")).first()[0] <= 4
    assert tiles.with_border(spark.range(40000).selectExpr("id div 200 as row", "id % 200 as col"), 2, 64).count() < 40000 * 1.2
    assert set(tiles.moving_extreme(extra, "v", 1).columns) == {"row", "col", "v", "filled", "moving_range"}
    assert tiles.gradient(df.limit(0), "v").count() == 0
    with pytest.raises(Exception, match="several rows"):
        tiles.gradient(df.union(df), "v").collect()
    with pytest.raises(ValueError, match="border"):
        tiles.with_border(df, 9, 4)


def test_many_dimensions_move_each_row_once_a_block(spark):
    """Where rings rule out nothing all pairs are compared in blocks; copies tie by id, groups stay apart."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(560, 32)), np.repeat(rng.normal(size=(2, 32)), 20, 0)]) + 1000.0
    groups = [i % 3 if i % 41 else None for i in range(600)]
    rows = spark.createDataFrame([(i, v.tolist(), g) for i, (v, g) in enumerate(zip(x, groups, strict=True))], "id long, vec array<double>, g int")
    seen = []
    out = {}
    for r in knn(rows, rows, 4, group="g", small=50, block=64, visited=seen).collect():
        out.setdefault(r.q, {})[r.place] = (r.s, r.d2)
    assert sum(v.count() for v in seen) <= 3 * len(x)
    assert len(out) == 600
    for q in range(600):
        d = ((x - x[q]) ** 2).sum(1)
        best = sorted((d[s], s) for s in range(600) if s != q and groups[s] == groups[q])[:4]
        assert [out[q][p + 1][0] for p in range(4)] == [s for _, s in best]
        assert [out[q][p + 1][1] for p in range(4)] == pytest.approx([v for v, _ in best], abs=1e-9)


def test_nearest_donors_of_crowded_places(spark):
    """Places that many points share are compared once; the far targets of an empty half are found too."""
    rng = random.Random(13)
    spots = [(round(rng.uniform(-20, 20), 2), round(rng.uniform(-5, 5), 2)) for _ in range(60)] + [(-179.99, 80.0), (179.99, 80.0)]
    donors = [(i, *spots[i % 62]) for i in range(3000)]
    targets = [(10_000 + i, *spots[i % 62]) if i % 3 else (10_000 + i, rng.uniform(-180, 180), rng.uniform(-89, 89)) for i in range(400)]
    frames = [spark.createDataFrame(r, "k long, lon double, lat double") for r in (targets, donors)]
    out = grid.nearest_donor(*frames, "k")
    got = {r.k: r for r in out.collect()}
    assert len(got) == 400

    def km(a, b):
        lon1, lat1, lon2, lat2 = map(math.radians, (*a, *b))
        h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))

    for k, *at in targets:
        far, donor = min((km(at, spots[d]), d) for d in range(62))
        assert got[k].km == pytest.approx(far, abs=1e-6) and got[k].donor == donor


def test_donors_of_small_and_missing_labels_are_sought_among_all(spark, tmp_path):
    """A label of four rows offers each three others only; one of five is enough."""
    duckdb = pytest.importorskip("duckdb")
    rng = np.random.default_rng(14)
    labels = [1] * 20 + [2] * 5 + [3] * 4 + [4, None, None, None, None, None, None]
    x = rng.integers(0, 4, (len(labels), 3)).astype(float)  # many ties
    rows = [(i, v.tolist(), g) for i, (v, g) in enumerate(zip(x, labels, strict=True))]

    def both(some, name):
        spark.createDataFrame(some, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/{name}/embeddings.parquet/*.parquet'")
        return [sorted((r[0], r[1], r[2]) for r in found) for found in (registry.QUERIES["donor_quantile"](spark, f"{tmp_path}/{name}").collect(), con.execute(registry.ORACLE["donor_quantile"]).fetchall())]

    want = []
    for i, v, g in rows:
        own = [s for s, _, h in rows if s != i and h is not None and h == g]
        pool = own if len(own) >= 4 else [s for s, _, _ in rows if s != i]
        near = sorted((float(((x[i] - x[s]) ** 2).sum()), s) for s in pool)[:4]
        want.append((i, round(float(np.quantile([s for _, s in near], 0.25)), 6), 4))
    assert both(rows, "all") == [want, want]
    got, sql = both(rows[25:28], "few")  # no more than two others at all
    assert got == sql and [r[2] for r in got] == [2, 2, 2]


def test_an_unknown_vector_takes_nothing_from_others(spark):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(130, 3))
    rows = [(i, v.tolist(), 1 if i < 120 else 2) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [(900, [nan, 0.0, 0.0], 1), (901, [0.0, -inf, 0.0], 1), (902, [None, 0.0, 0.0], 1), (903, None, 1), (904, [0.0, 0.0, nan], 2)]
    schema = "id long, vec array<double>, g int"
    sound, df = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + odd, schema)
    assert found(knn(df, df, 4)) == nearest(x, list(range(130)), 4)
    assert found(knn(df, df, 4, group="g", small=50, block=64)) == nearest(x, list(range(130)), 4, [r[2] for r in rows])
    estimates = lambda some: {r.q: tuple(r) for r in grid.donor_quantile(some, some.withColumn("v", F.col("id")), 4, 0.25, group="g", value="v", least=11).collect()}
    assert estimates(df) == estimates(sound)  # ten known rows and one unknown are no eleven donors
