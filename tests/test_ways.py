"""Ways, links, covers and kept stages against plain loops, with nulls, ties, repeats and empty tables."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from terraledger.operators import paths, rivers
from terraledger.sources import sinks, stages


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def test_follow_numbers_every_way(spark):
    steps = [(i, i + 1) for i in range(100)] + [(200, 201), (201, None), (300, 50), (400, None)]
    df = spark.createDataFrame(steps, "node long, next long")
    starts = spark.createDataFrame([(0,), (97,), (100,), (200,), (300,), (400,), (999,), (97,), (None,)], "id long")
    got = {}
    for r in paths.follow(df, starts).collect():
        got.setdefault(r.start, {})[r.place] = r.node
    to = dict(steps)
    for s in (0, 97, 100, 200, 300, 400, 999):
        way = [s]
        while to.get(way[-1]) is not None:
            way.append(to[way[-1]])
        assert [got[s][k] for k in range(len(way))] == way and len(got[s]) == len(way)
    assert paths.follow(df.limit(0), starts).count() == 7 and paths.follow(df, starts.limit(0)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        paths.follow(spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "node long, next long"), starts)
    with pytest.raises(ValueError, match="several"):
        paths.follow(spark.createDataFrame([(0, 1), (0, 2)], "node long, next long"), starts)


def distances(adjacent, start):
    seen, queue = {start: 0}, deque([start])
    while queue:
        x = queue.popleft()
        for y in adjacent.get(x, ()):
            if y not in seen:
                seen[y] = seen[x] + 1
                queue.append(y)
    return seen


def random_graph(seed, n, m):
    rng = random.Random(seed)
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    adjacent = {}
    for a, b in pairs:
        if a != b:
            adjacent.setdefault(a, set()).add(b)
            adjacent.setdefault(b, set()).add(a)
    return pairs, adjacent


def test_shortest_ways_match_a_search(spark):
    pairs, adjacent = random_graph(1, 60, 75)
    asked = [(k, k, (k * 7 + 3) % 60) for k in range(0, 60, 4)] + [(100, 5, 5), (101, None, 3), (102, 700, 701)]
    df = spark.createDataFrame(asked, "pair long, a long, b long")
    lengths, ways = paths.shortest_ways(edges(spark, pairs + pairs[:3]), df, 6)
    got, way = {r.pair: r.length for r in lengths.collect()}, {}
    for r in sorted(ways.collect(), key=lambda r: r.place):
        way.setdefault(r.pair, []).append((r.place, r.node))
    want = {p: d for p, a, b in asked if a is not None and (d := distances(adjacent, a).get(b)) is not None and d <= 6}
    assert got == want and way.keys() == want.keys()
    for p, a, b in asked:
        if p in want:
            places, nodes = zip(*way[p], strict=True)
            assert list(places) == list(range(want[p] + 1)) and (nodes[0], nodes[-1]) == (a, b) and all(y in adjacent[x] for x, y in zip(nodes, nodes[1:], strict=False))
    assert paths.shortest_ways(edges(spark, pairs), df.limit(0), 3)[1].count() == 0


def test_claims_and_links(spark):
    pairs, adjacent = random_graph(3, 80, 110)
    group = {x: x % 2 if x % 9 else None for x in range(80)}
    inside = {a: {b for b in bs if group[a] is not None and group[a] == group[b]} for a, bs in adjacent.items()}
    sources = [1, 2, 12, 13, 34, 35, 44, 55, 56, 67, 68, 79]
    src = spark.createDataFrame([(s,) for s in [*sources, 1]] + [(None,)], "id long")
    groups = spark.createDataFrame(list(group.items()), "node long, group int")
    near = {s: distances(inside, s) for s in sources}
    got = {r.node: (r.distance, r.source) for r in paths.claimed(edges(spark, pairs), src, 3, groups=groups).collect()}
    want = {x: min((d[x], s) for s, d in near.items() if x in d) for x in range(80) if any(d.get(x, 9) <= 3 for d in near.values())}
    # of equally near sources the one that reaches a nearer node first by its smaller number
    assert {x: d for x, (d, _) in got.items()} == {x: d for x, (d, _) in want.items()} and all(near[s][x] == d for x, (d, s) in got.items())
    links, cells = paths.gap_links(edges(spark, pairs), src, 4, groups=groups)
    rows = links.collect()
    between = sorted((near[a][b], a, b) for a in sources for b in sources if a < b and near[a].get(b, 9) <= 4)
    part, weight = {s: s for s in sources}, []
    for d, a, b in between:
        if part[a] != part[b]:
            weight.append(d)
            old = part[b]
            part = {s: part[a] if p == old else p for s, p in part.items()}
    assert sorted(r.length for r in rows) == sorted(weight)
    held = {}
    for r in cells.collect():
        held.setdefault((r.one, r.two), set()).add(r.node)
    for r in rows:
        own = held[r.one, r.two]
        assert len(own) == r.length + 1 and {r.one, r.two} <= own and distances({x: inside[x] & own for x in own}, r.one).get(r.two) == r.length
    none, empty = paths.gap_links(edges(spark, pairs), src.limit(0), 4)
    assert none.count() == 0 and empty.count() == 0


def test_cover_is_the_one_by_one_choice(spark):
    rng = random.Random(5)
    reach = {p: {rng.randrange(60) for _ in range(rng.randint(1, 9))} for p in range(40)}
    df = spark.createDataFrame([(p, n) for p, ns in reach.items() for n in ns] + [(1, None), (None, 3)] + [(0, n) for n in reach[0]], "port long, node long")
    covered, want = set(), []
    while True:
        gain, port = max((len(ns - covered), -p) for p, ns in reach.items())
        if not gain:
            break
        want.append((-port, gain, len(want)))
        covered |= reach[-port]
    got = [tuple(r) for r in paths.greedy_cover(df).orderBy("place").collect()]
    assert got == want
    assert [tuple(r) for r in paths.greedy_cover(df, most=3).orderBy("place").collect()] == want[:3]
    assert [tuple(r) for r in paths.greedy_cover(df, least=4).orderBy("place").collect()] == [w for w in want if w[1] >= 4]
    assert paths.greedy_cover(df.limit(0)).count() == 0


def test_stages_are_made_once(spark, tmp_path):
    path, calls = f"file://{tmp_path}/built", []
    source = spark.createDataFrame([(1, 2.0), (2, None)], "k long, v double")

    def build():
        calls.append(1)
        return source.withColumn("w", F.col("v") * 2)

    def run(df=source, setting=1, code="a", **kw):
        return stages.stage(path, "s", {"x": df}, {"n": setting}, code, build, **kw)

    first, reused = run()
    assert not reused and first.count() == 2
    assert run()[1] and run(source.orderBy(F.desc("k")).repartition(3))[1] and len(calls) == 1  # the order of rows doesn't count
    assert not run(setting=2)[1] and not run(code="b")[1] and not run(source.unionByName(source.limit(1)))[1] and len(calls) == 4
    mark = sinks.stamp({"x": source}, {"n": 1}, "a")
    assert stages.stage_issues(spark, path, {"s": mark}).count() == 0
    stages.refuse_stale(spark, path, {"s": mark})
    # a table that was changed behind the manifest's back is made anew
    source.withColumn("w", F.lit(7.0)).write.mode("overwrite").parquet(f"{path}/s/{mark}/table")
    found = {r.stage: r.issue for r in stages.stage_issues(spark, path, {"s": mark, "other": "x"}).collect()} | {r.stage + "2": r.issue for r in stages.stage_issues(spark, path, {"s": "0" * 64}).collect()}
    assert found == {"s": "content", "other": "missing", "s2": "stale"}
    with pytest.raises(ValueError, match="s: content"):
        stages.refuse_stale(spark, path, {"s": mark})
    assert not run()[1] and run()[1]
    # a build that breaks off leaves nothing behind that looks whole
    with pytest.raises(ZeroDivisionError):
        stages.stage(path, "t", {"x": source}, {}, "a", lambda: 1 / 0)
    assert {r.issue for r in stages.stage_issues(spark, path, {"t": sinks.stamp({"x": source}, {}, "a")}).collect()} == {"missing"}
    run(setting=9, keep=1)
    assert len([p for p in (tmp_path / "built" / "s").iterdir() if not p.name.startswith(".")]) == 2


def test_contracts_are_whole_and_mirrored(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    one, two = spark.range(3), spark.range(5)
    sinks.write_contract({"t": one}, path, "v1", latest=True)
    sinks.write_contract({"t": two}, path, "v2", latest=True)
    assert spark.read.parquet(f"{path}/latest/t").count() == 5 and spark.read.parquet(f"{path}/v1/t").count() == 3 and sinks.broken(spark, path, "v2").count() == 0
    with pytest.raises(FileExistsError):
        sinks.write_contract({"t": one}, path, "v2")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|broken"):
        sinks.write_contract({"t": one.select(F.raise_error(F.lit("broken")).alias("x"))}, path, "v3")
    assert not stages.exists(spark, f"{path}/v3")


def test_layers_must_lie_alike(spark):
    base = spark.createDataFrame([(r, c, float(r * c)) for r in range(3) for c in range(3)], "row long, col long, v double")
    moved = base.withColumn("row", F.col("row") + 1)
    hole = base.where("row <> 1 or col <> 1").unionByName(spark.createDataFrame([(2, 2, 1.0)], "row long, col long, v double"))
    got = sorted((r.layer, r.issue) for r in stages.alignment_issues({"a": base, "b": base.limit(9), "c": moved, "d": hole, "e": base.limit(0)}).collect())
    assert got == [("c", "other places"), ("d", "a place stands twice"), ("d", "other places"), ("e", "other places")]


def bitmap(spark, pixels):
    return spark.createDataFrame([(r, c, k) for (r, c), k in pixels.items()], "row long, col long, kind string")


def confluence():
    """A river from above with its source, and a tributary from the left whose marker stands before the junction."""
    pixels = {(r, 10): "flow" for r in range(2, 19)} | {(10, c): "flow" for c in range(2, 10)}
    return pixels | {(2, 10): "source", (10, 9): "marker"}


CHANGES = {
    "sound": ({}, set()),
    "marker on the junction": ({(10, 9): "flow", (10, 10): "marker"}, {"a marker without two neighbours"}),
    "no marker": ({(10, 9): "flow"}, {"a branch without a marker"}),
    "two sources": ({(18, 10): "source"}, {"not one source"}),
    "no source": ({(2, 10): "flow"}, {"not one source"}),
    "apart": ({(15, c): "flow" for c in range(2, 6)}, {"not one source"}),
    "source at the junction": ({(2, 10): "flow", (10, 10): "source"}, {"a source that is no end"}),
    "another tributary": ({(6, c): "flow" for c in range(12, 18)} | {(6, 11): "marker"}, set()),
    "a ring": ({(r, c): "flow" for r in range(14, 18) for c in range(2, 6) if r in (14, 17) or c in (2, 5)}, {"a cycle", "not one source"}),
    "source on the tributary": ({(2, 10): "flow", (10, 2): "source"}, {"a source on a tributary"}),
    "split": ({(5, 10): "split"}, {"a river parts"}),
    "two markers": ({(10, 8): "marker"}, {"markers side by side"}),
    "none": ({(5, 10): None, (6, 10): None}, {"not one source"}),
}


def test_bitmaps_that_are_no_trees(spark):
    from terraledger.operators import rivers

    # all of them in one bitmap, each forty rows below the one before
    names = list(CHANGES)
    drawn = {(r + 40 * n, c): k for n, name in enumerate(names) for (r, c), k in (confluence() | CHANGES[name][0]).items()}
    drawn |= {(40 * len(names) + c, 20 - r): k for (r, c), k in confluence().items()}  # turned
    pixels = bitmap(spark, drawn)
    found = {name: set() for name in [*names, "turned"]}
    for r in rivers.bitmap_violations(pixels.unionByName(pixels.limit(30)), 21).collect():
        found[[*names, "turned"][r.row // 40]].add(r.problem)
    assert not found["turned"]
    for name in names:
        want = CHANGES[name][1]
        assert found[name] >= want and bool(found[name]) == bool(want), name
    assert rivers.bitmap_violations(pixels.limit(0), 21).count() == 0


def broadcasts(spark, run):
    """How many broadcast joins ran in the executions that ``run`` started."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(store.executionsList(k, 1).apply(0).physicalPlanDescription().count("BroadcastHashJoin") for k in range(before, store.executionsCount()))


def chains(spark, n):
    return spark.range(n).where("id % 4 < 3").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))


def test_rounds_over_pixels_broadcast_nothing(spark):
    pixels = spark.range(400).select(F.expr("id div 20").alias("row"), F.expr("id % 20").alias("col"), F.when(F.col("id") % 7 == 0, "source").otherwise("flow").alias("kind"))
    assert broadcasts(spark, lambda: rivers.bitmap_violations(pixels, 20).collect()) == 0


def test_rounds_over_gaps_broadcast_nothing(spark):
    sources = spark.range(0, 400, 3).select("id")
    assert broadcasts(spark, lambda: paths.gap_links(chains(spark, 400), sources, 4)[0].collect()) == 0


def test_turns_of_a_search_look_at_the_last_rings_alone(spark):
    asked = spark.range(0, 400, 4).select(F.col("id").alias("pair"), F.col("id").alias("a"), (F.col("id") + 3).alias("b"))
    found = {}
    assert broadcasts(spark, lambda: found.update(zip("lw", paths.shortest_ways(chains(spark, 400), asked, 3), strict=True))) == 0
    assert {r.length for r in found["l"].collect()} == {3} and found["l"].count() == 100
    assert sorted((r.pair, r.place, r.node) for r in found["w"].collect()) == [(k, j, k + j) for k in range(0, 400, 4) for j in range(4)]
