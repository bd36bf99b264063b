"""Paths on graphs without walking them: every table is keyed by node, and rounds grow with the logarithm of lengths or with a hop limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraledger.operators.graph import components, spread
from terraledger.sources.lineage import drop_written
from terraledger.sources.lineage import written as settled


def both_ways(edges: DataFrame) -> DataFrame:
    """``(a, b)`` with every edge in both directions, once, without loops."""
    pairs = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def follow(steps: DataFrame, starts: DataFrame) -> DataFrame:
    """``(start, place, node)``: the way from each start ``(id)`` along ``steps(node, next)``, numbered from 0.

    Jumps of 1, 2, 4, ... steps are composed; a row at a place gives the row one
    jump further, longest jumps first, so that each place is reached once.  The
    rows are the result's; rounds are twice the logarithm of the longest way.  Ways
    that never end raise, as do nodes with several steps.
    """
    jump = settled(steps.select("node", F.col("next").alias("to")).where("next is not null"))
    if jump.groupBy("node").count().where("count > 1").limit(1).count():
        raise ValueError("a node has several steps")
    jumps, nodes = [jump], jump.count()
    while True:
        there = jumps[-1].select(F.col("node").alias("to"), F.col("to").alias("_further"))
        longer = settled(jumps[-1].join(spread(there), "to").select("node", F.col("_further").alias("to")))
        if not longer.limit(1).count():
            drop_written(longer)
            break
        if 1 << (len(jumps) - 1) > nodes:
            raise ValueError("the steps form a cycle")
        jumps.append(longer)
    rows = starts.where("id is not null").select(F.col("id").alias("start"), F.lit(0).cast("long").alias("place"), F.col("id").alias("node")).distinct()
    for k in range(len(jumps) - 1, -1, -1):
        on = rows.join(spread(jumps[k]), "node").select("start", (F.col("place") + (1 << k)).alias("place"), F.col("to").alias("node"))
        longer = settled(rows.unionByName(on))
        if k < len(jumps) - 1:
            drop_written(rows)
        rows = longer
    drop_written(*jumps)
    return rows


def claimed(edges: DataFrame, sources: DataFrame, hops: int, *, groups: DataFrame | None = None) -> DataFrame:
    """``(node, source, distance, back)``: the nearest source ``(id)`` of each node at most ``hops`` edges away (ties: the smallest), and the neighbour towards it.

    With ``groups(node, group)`` ways stay within one group, and nodes without a
    group are never entered.  A node is claimed once, so rows are nodes however many
    sources there are.
    """
    both = both_ways(edges)
    if groups is not None:
        g = groups.where("group is not null").select("node", "group")
        inside = both.join(spread(g.select(F.col("node").alias("a"), F.col("group").alias("_ga"))), "a").join(spread(g.select(F.col("node").alias("b"), F.col("group").alias("_gb"))), "b")
        both = inside.where("_ga = _gb").select("a", "b")
    both = settled(both)
    ring = sources.where("id is not null").select(F.col("id").alias("node"), F.col("id").alias("source"), F.lit(0).cast("long").alias("distance"), F.lit(None).cast(both.schema["a"].dataType).alias("back")).distinct()
    ring = settled(ring)
    seen = ring
    for k in range(1, hops + 1):
        met = ring.join(spread(both), F.col("node") == F.col("a")).groupBy(F.col("b").alias("node")).agg(F.min(F.struct("source", "a")).alias("m"))
        ring = settled(met.join(spread(seen.select("node")), "node", "left_anti").select("node", "m.source", F.lit(k).cast("long").alias("distance"), F.col("m.a").alias("back")))
        if not ring.limit(1).count():
            break
        seen = seen.unionByName(ring)
    drop_written(both)
    return seen


def gap_links(edges: DataFrame, sources: DataFrame, hops: int, *, groups: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Links between sources ``(id)`` whose gap is at most ``hops`` edges: ``(one, two, length, a, b)``, and the cells of each ``(one, two, node)``.

    Where the nearest-source regions of two sources touch lies a shortest way
    between them; of the touching pairs a forest of shortest links is kept (ties:
    smallest ids), by rounds in which every joined group takes its shortest.  ``groups``
    as in ``claimed``.
    """
    near = settled(claimed(edges, sources, hops, groups=groups))
    side = lambda n: near.select(F.col("node").alias(n), F.col("source").alias(f"s{n}"), F.col("distance").alias(f"d{n}"))
    open_ = both_ways(edges).where("a < b")
    if groups is not None:
        g = groups.select("node", "group")
        open_ = open_.join(spread(g.select(F.col("node").alias("a"), F.col("group").alias("_ga"))), "a").join(spread(g.select(F.col("node").alias("b"), F.col("group").alias("_gb"))), "b").where("_ga = _gb").select("a", "b")
    touch = open_.join(spread(side("a")), "a").join(spread(side("b")), "b").where("sa <> sb").withColumn("length", F.col("da") + F.col("db") + 1).where(F.col("length") <= hops)
    pair = touch.groupBy(F.least("sa", "sb").alias("one"), F.greatest("sa", "sb").alias("two")).agg(F.min(F.struct("length", "a", "b")).alias("m"))
    pair = settled(pair.select("one", "two", "m.length", "m.a", "m.b"))
    kept, label = None, sources.where("id is not null").select(F.col("id").alias("node"), F.col("id").alias("component")).distinct()
    while True:
        named = lambda n: label.select(F.col("node").alias(n), F.col("component").alias(f"_{n}"))
        between = pair.join(spread(named("one")), "one").join(spread(named("two")), "two").where("_one <> _two")
        rank = F.struct("length", "one", "two", "a", "b")
        best = between.select(F.explode(F.array("_one", "_two")).alias("_c"), rank.alias("r")).groupBy("_c").agg(F.min("r").alias("r")).select("r.*").distinct()
        best = settled(best)
        if not best.limit(1).count():
            drop_written(best)
            break
        kept = best if kept is None else kept.unionByName(best)
        label = settled(components(kept.select(F.col("one").alias("a"), F.col("two").alias("b")), nodes=label))
    links = (pair.where("false") if kept is None else kept).select("one", "two", "length", "a", "b")
    ends = links.select("one", "two", F.explode(F.array("a", "b")).alias("id"))
    ways = follow(near.select("node", F.col("back").alias("next")), ends.select("id").distinct())
    cells = ends.join(spread(ways), F.col("id") == F.col("start")).select("one", "two", "node").distinct()
    return links, cells


def shortest_ways(edges: DataFrame, pairs: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """For each ``(pair, a, b)`` the fewest edges from ``a`` to ``b``, at most ``most``: ``(pair, length)``, and one shortest way ``(pair, place, node)``.

    All pairs are searched at once from both ends, the sides taking turns; a pair
    leaves the search when its sides meet.  Sides can only meet where the ring just
    grown lies on the last one of the other side, and neighbours of a ring lie in it
    or in the two beside it, so no turn looks at more than two rings of a side.
    Pairs further apart, or with an unknown end, are left out.  Of several ways the
    one through the smallest nodes met is kept.
    """
    both = settled(both_ways(edges))
    known = settled(pairs.where("a is not null and b is not null").select("pair", "a", "b").distinct())
    none = F.lit(None).cast(both.schema["a"].dataType).alias("back")
    rings = [[settled(known.select("pair", F.col(end).alias("node"), none).distinct())] for end in ("a", "b")]
    step = both.select(F.col("a").alias("node"), F.col("b").alias("_to"))
    done = None
    for turn in range(most + 1):
        if turn:
            own = rings[(turn - 1) % 2]
            open_ = own[-1].join(spread(done.select("pair")), "pair", "left_anti")
            grown = open_.join(spread(step), "node").groupBy("pair", F.col("_to").alias("node")).agg(F.min("node").alias("back"))
            old = own[-1] if len(own) == 1 else own[-1].unionByName(own[-2])
            grown = settled(grown.join(spread(old.select("pair", "node")), ["pair", "node"], "left_anti").select("pair", "node", "back"))
            if not grown.limit(1).count():
                break
            own.append(grown)
        there = rings[1][-1].select("pair", "node")
        if done is not None:
            there = there.join(spread(done.select("pair")), "pair", "left_anti")
        met = rings[0][-1].select("pair", "node").join(spread(there), ["pair", "node"]).groupBy("pair").agg(F.min("node").alias("middle"))
        met = settled(met.select("pair", F.lit(turn).cast("long").alias("length"), "middle"))
        done = met if done is None else done.unionByName(met)
    # the ways from the middle to both ends, ring by ring along the neighbours that the search came from
    way = None
    for side, own in enumerate(rings):
        radius = F.floor((F.col("length") + 1 - side) / 2)
        at = None
        for k in range(len(own) - 1, -1, -1):
            here = done.where(radius == k).select("pair", "length", F.col("middle").alias("node"))
            here = here if at is None else here.unionByName(at)
            place = F.lit(k).cast("long") if side == 0 else F.col("length") - k
            kept = here if side == 0 else here.where(radius > k)  # the first side has the middle
            placed = kept.select("pair", place.alias("place"), "node")
            way = placed if way is None else way.unionByName(placed)
            if k:
                at = settled(here.join(spread(own[k]), ["pair", "node"]).select("pair", "length", F.col("back").alias("node")))
    drop_written(both, known, *rings[0], *rings[1])
    return done.select("pair", "length"), way


def greedy_cover(reach: DataFrame, *, most: int | None = None, least: int = 1) -> DataFrame:
    """``(port, gain, place)``: ports of ``reach(port, node)`` in the order in which the one with the most uncovered nodes is taken (ties: the smallest).

    In a round every port is taken that has more uncovered nodes than each port it
    shares one with: no such choice can change another's gain, so the ports are those
    of the one-by-one choice, and their order is that of their gains.  ``most`` ports
    at most are kept, and none with a gain under ``least``.
    """
    open_ = settled(reach.where("port is not null and node is not null").select("port", "node").distinct())
    taken = None
    while True:
        gain = open_.groupBy("port").agg(F.count(F.lit(1)).alias("gain")).where(F.col("gain") >= least)
        held = open_.join(gain, "port")
        rank = F.struct("gain", (-F.col("port")).alias("order"))
        top = held.groupBy("node").agg(F.max(rank).alias("top"))
        beaten = held.join(top, "node").where(rank != F.col("top")).select("port").distinct()
        won = settled(gain.join(beaten, "port", "left_anti"))
        if not won.limit(1).count():
            drop_written(won)
            break
        taken = won if taken is None else taken.unionByName(won)
        covered = open_.join(won.select("port"), "port", "left_semi").select("node").distinct()
        after = settled(open_.join(covered, "node", "left_anti"))
        drop_written(open_)
        open_ = after
    if taken is None:
        return reach.select("port", F.lit(0).cast("long").alias("gain"), F.lit(0).alias("place")).where("false")
    order = Window.orderBy(F.desc("gain"), "port")  # a row a port that was taken
    placed = taken.withColumn("place", F.row_number().over(order) - 1)
    return placed if most is None else placed.where(F.col("place") < most)
