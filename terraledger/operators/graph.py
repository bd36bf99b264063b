"""Forest and graph operators on edge tables ``(id, down_id)``, by rounds of joins.

A round's table is written to the shared folder, so lineage stays short and a
lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraledger.sources.lineage import drop_written
from terraledger.sources.lineage import written as settled

#: Rows of a label table that go into one file.
ROWS_A_FILE = 250_000
#: Levels that ``route`` works out node by node before it composes functions.
EXACT_LEVELS = 24


def spread(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the input: sorted and shuffled, never sent through the driver.

    Tables of ids fill many times their bytes in files, by which Spark judges what is small.
    """
    return df.hint("merge")


def dangling(nodes: DataFrame) -> DataFrame:
    """Links to nodes that do not exist."""
    return nodes.where("down_id is not null").join(nodes.select(F.col("id").alias("down_id")), "down_id", "left_anti")


def _doubled(nodes: DataFrame, first: dict[str, Column], gather: dict[str, Column], combine: Callable[[int], dict[str, Column]]) -> DataFrame:
    """``(id, ...)``: states of ``first`` gathered from all nodes above by doubling of pointers.

    Before a round each node points ``reach`` links down and its state covers the
    nodes less than ``reach`` links above it.  A node then gathers the states of the
    nodes that point to it, and pointers jump, so rows stay as many as nodes and
    rounds grow with the logarithm of the depth.  Repeated ids, links to nodes that do
    not exist, and cycles raise.
    """
    table = settled(nodes.select("id", F.col("down_id").alias("_to"), *[c.alias(k) for k, c in first.items()]))
    if table.groupBy("id").count().where("count > 1").limit(1).count():
        raise ValueError("an id stands on several nodes")
    if dangling(table.select("id", F.col("_to").alias("down_id"))).limit(1).count():
        raise ValueError("a link leads to a node that does not exist")
    total, reach = table.count(), 1
    while table.where("_to is not null").limit(1).count():
        if reach > total:
            raise ValueError("the links form a cycle")
        met = table.where("_to is not null").groupBy(F.col("_to").alias("id")).agg(*[c.alias(f"_{k}") for k, c in gather.items()])
        jump = table.select(F.col("id").alias("_to"), F.col("_to").alias("_next"))
        joined = table.join(met, "id", "left").join(jump, "_to", "left")
        new = settled(joined.select("id", F.col("_next").alias("_to"), *[c.alias(k) for k, c in combine(reach).items()]))
        drop_written(table)
        table, reach = new, reach * 2
    return table.drop("_to")


def downstream_closure(nodes: DataFrame, selected: DataFrame) -> DataFrame:
    """``(id)``: the selected nodes and all below them."""
    marked = nodes.select("id", "down_id").join(selected.select("id", F.lit(True).alias("_mark")).distinct(), "id", "left")
    found = _doubled(marked, {"mark": F.coalesce("_mark", F.lit(False))}, {"mark": F.max("mark")}, lambda reach: {"mark": F.col("mark") | F.coalesce("_mark", F.lit(False))})
    return found.where("mark").select("id")


def accumulate(nodes: DataFrame, value: str) -> DataFrame:
    """``(id, total, upstream)``: the value summed over a node and all above it, and how many nodes these are."""
    first = {"total": F.col(value), "upstream": F.lit(1).cast("long")}
    gather = {"total": F.sum("total"), "upstream": F.sum("upstream")}
    both = F.when(F.col("total").isNotNull() | F.col("_total").isNotNull(), F.coalesce("total", F.lit(0)) + F.coalesce("_total", F.lit(0)))
    return _doubled(nodes, first, gather, lambda reach: {"total": both, "upstream": F.col("upstream") + F.coalesce("_upstream", F.lit(0))})


def heights(nodes: DataFrame) -> DataFrame:
    """``(id, level)``: the longest way up from a node to a source."""
    return _doubled(nodes, {"level": F.lit(0).cast("long")}, {"level": F.max("level")}, lambda reach: {"level": F.greatest("level", F.col("_level") + reach)})


def stem_heads(nodes: DataFrame, weight: str) -> DataFrame:
    """``(id, head, place)``: the branch that a node lies on, named by its lowest node, and its links above it.

    Of the nodes above another the heaviest (ties: the smallest id) continues its
    branch; every other one is the lowest node of a branch of its own.
    """
    main = nodes.where("down_id is not null").groupBy("down_id").agg(F.max(F.struct(F.col(weight), (-F.col("id")).alias("_o"))).alias("_m"))
    main = main.select(F.col("down_id").alias("_d"), (-F.col("_m._o")).alias("_main"))
    table = settled(nodes.join(main, F.col("down_id") == F.col("_d"), "left").select("id", F.when(F.col("_main") == F.col("id"), F.col("down_id")).alias("to"), F.col("id").alias("head"), F.lit(0).cast("long").alias("place")))
    total, reach = table.count(), 1
    while table.where("to is not null").limit(1).count():
        if reach > total:
            raise ValueError("the links form a cycle")
        below = table.select(F.col("id").alias("to"), F.col("to").alias("_next"), F.col("head").alias("_head"), F.col("place").alias("_place"))
        ahead = F.col("to").isNotNull()
        new = settled(table.join(below, "to", "left").select("id", F.col("_next").alias("to"), F.when(ahead, F.col("_head")).otherwise(F.col("head")).alias("head"), F.when(ahead, F.col("_place") + reach).otherwise(F.col("place")).alias("place")))
        drop_written(table)
        table, reach = new, reach * 2
    return table.drop("to")


def route(nodes: DataFrame, runoff: str, demand: str, protected: float = 0.6, survival: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``(id, *by, generated, lost, allocated, outflow)``: demand met from what flows down, sources first.

    Rows are nodes, or nodes and keys ``by`` (months) that are routed apart.  Of what
    reaches a node with its own unprotected runoff the share ``survival`` is left;
    demand takes from that, and the rest flows on.

    What leaves a node is ``max(a x + b, c)`` of what enters it, and such functions
    compose to the same form.  In each round nodes without an open node above settle
    and add to the one below, while a node with a single open one above takes over
    that one's function and looks as far up as it did; stretches halve, so rounds grow
    with the logarithm of the nodes however deep the forest is.  Rows stay as many.
    Composed functions round otherwise than a walk from node to node, in the last
    digits of a double, so nodes with fewer than ``EXACT_LEVELS`` levels above them are
    worked out without; only deeper ones may differ so from the walk.

    Negative or missing runoff, demand or survival raises, as do repeated rows, links
    to nowhere (or to a node without that key) and cycles.
    """
    kept = (F.col(survival) if survival else F.lit(1.0)).cast("double")
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (c < 0)
    if nodes.where(bad(F.col(runoff)) | bad(F.col(demand)) | bad(kept) | (kept > 1)).limit(1).count():
        raise ValueError("runoff, demand and survival must be known and not negative")
    keys = ["id", *by]
    flow = (F.col(runoff) * (1 - protected)).cast("double")
    base = settled(nodes.select(*keys, "down_id", flow.alias("generated"), F.col(demand).cast("double").alias("want"), kept.alias("kept")))
    if base.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError("an id stands on several nodes")
    if base.where("down_id is not null").join(base.select(F.col("id").alias("down_id"), *by), ["down_id", *by], "left_anti").limit(1).count():
        raise ValueError("a link leads to a node that does not exist")
    out = _settled_outflow(base, keys)
    arrived = out.where("down_id is not null").groupBy(F.col("down_id").alias("id"), *by).agg(F.sum("out").alias("inflow"))
    all_flow = F.col("generated") + F.coalesce("inflow", F.lit(0.0))
    routed = base.join(arrived, keys, "left").withColumn("lost", all_flow * (1 - F.col("kept"))).withColumn("allocated", F.least(all_flow * F.col("kept"), F.col("want")))
    return routed.withColumn("outflow", F.greatest(all_flow * F.col("kept") - F.col("allocated"), F.lit(0.0))).select(*keys, "generated", "lost", "allocated", "outflow")


def _settled_outflow(base: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, down_id, out)`` of routed rows ``(*keys, down_id, generated, want, kept)``, written."""
    by, kind = keys[1:], base.schema["id"].dataType
    a, b, c, inflow = F.col("a"), F.col("b"), F.col("c"), F.col("inflow")
    nothing = {"inflow": F.lit(0.0), "a": F.col("kept"), "b": F.lit(0.0), "c": F.lit(0.0), "src": F.lit(None).cast(kind), "out": F.lit(None).cast("double"), "composed": F.lit(False), "told": F.lit(False)}
    table = settled(base.select(*keys, "down_id", "generated", "want", "kept", *[v.alias(k) for k, v in nothing.items()]))
    open_, rounds = table.count(), 0
    while open_:
        # what nodes hear from above: outflows that settled last round, and which nodes are open still
        above = table.where("down_id is not null and not told").groupBy(F.col("down_id").alias("id"), *by)
        above = above.agg(F.sum("out").alias("_sum"), F.count_if(F.col("out").isNull()).alias("_open"), F.min(F.when(F.col("out").isNull(), F.col("id"))).alias("_one"))
        # the node that one looks up to; the others look at themselves, so that no key holds all of them
        seen = table.select(F.col("id").alias("_at"), *by, a.alias("_a"), b.alias("_b"), c.alias("_c"), F.col("src").alias("_src"), F.col("out").alias("_out"))
        now = table.join(above, keys, "left").withColumn("_at", F.coalesce("src", "id")).join(seen, ["_at", *by])
        waits = F.col("out").isNull() & F.col("src").isNull()
        looks = F.col("out").isNull() & F.col("src").isNotNull()
        passes = looks & F.col("_out").isNull() & F.col("_src").isNotNull() & F.lit(rounds >= EXACT_LEVELS)
        heard, left = inflow + F.coalesce("_sum", F.lit(0.0)), F.coalesce("_open", F.lit(0))
        through = F.when(F.col("composed"), F.greatest(a * F.col("_out") + b, c)).otherwise(_flows_on(inflow + F.col("_out")))
        new = {
            "inflow": F.when(waits, heard).otherwise(inflow),
            "a": F.when(passes, a * F.col("_a")).otherwise(a),
            "b": F.when(waits, F.col("kept") * (F.col("generated") + heard) - F.col("want")).when(passes, a * F.col("_b") + b).otherwise(b),
            "c": F.when(passes, F.greatest(a * F.col("_c") + b, c)).otherwise(c),
            "src": F.when(waits & (left == 1), F.col("_one")).when(passes, F.col("_src")).otherwise(F.col("src")),
            "out": F.when(waits & (left == 0), _flows_on(heard)).when(looks & F.col("_out").isNotNull(), through).otherwise(F.col("out")),
            "composed": F.col("composed") | passes,
            "told": F.col("out").isNotNull(),
        }
        after = settled(now.select(*keys, "down_id", "generated", "want", "kept", *[v.alias(k) for k, v in new.items()]))
        drop_written(table)
        table, rounds = after, rounds + 1
        # of an open forest some node has none open above it, so each round settles one at least
        still = table.where("out is null").count()
        if still == open_:
            raise ValueError("the links form a cycle")
        open_ = still
    return table.select(*keys, "down_id", "out")


def _flows_on(inflow: Column) -> Column:
    """What leaves a node that ``inflow`` enters, in the order of ``route``'s own columns."""
    left = (F.col("generated") + inflow) * F.col("kept")
    return F.greatest(left - F.least(left, F.col("want")), F.lit(0.0))


def route_balance(routed: DataFrame, nodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, generated, allocated, lost, at_outlets, residual)``: what goes in and out of all forests; the residual is rounding alone."""
    ends = routed.join(nodes.where("down_id is null").select("id").distinct().withColumn("_end", F.lit(True)), "id", "left")
    sums = ends.groupBy(*by).agg(F.sum("generated").alias("generated"), F.sum("allocated").alias("allocated"), F.sum("lost").alias("lost"), F.sum(F.when(F.col("_end"), F.col("outflow")).otherwise(0.0)).alias("at_outlets"))
    return sums.withColumn("residual", F.col("generated") - F.col("allocated") - F.col("lost") - F.col("at_outlets"))


def distances(edges: DataFrame, sources: DataFrame, most: int = 10_000) -> DataFrame:
    """``(node, distance)``: the fewest undirected ``edges(a, b)`` from any source ``(id)``; unreached nodes are left out.

    The neighbours of one ring lie in it, in the ring before or in the next, so a
    round looks at two rings and not at all that was seen.  More than ``most`` rounds raise.
    """
    both = settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    rings = [settled(sources.select(F.col("id").alias("node")).where("node is not null").distinct())]
    for _ in range(1, most):
        last = rings[-1] if len(rings) == 1 else rings[-1].unionByName(rings[-2])
        next_ = rings[-1].join(both, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
        ring = settled(next_.join(last, "node", "left_anti"))
        if not ring.limit(1).count():
            drop_written(both, ring)
            return reduce(DataFrame.unionByName, [r.withColumn("distance", F.lit(k).cast("long")) for k, r in enumerate(rings)])
        rings.append(ring)
    raise RuntimeError("distances did not settle")


def components(edges: DataFrame, *, nodes: DataFrame | None = None, most_rounds: int = 200) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)`` and of ``nodes(node)``; the component is its smallest node.

    Each round takes the smallest label among a node and its neighbours, then the
    label of that label, so long chains shrink by jumps.  Labels are written each
    round; nothing goes to the driver but whether labels moved.
    """
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    # label tables are small beside the shuffle's partitions: as many files as their rows ask for
    files = -(-edges.count() // ROWS_A_FILE) or 1
    both = settled(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().coalesce(files))
    labels = settled(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node").coalesce(files))
    for _ in range(most_rounds):
        near = both.join(spread(labels.withColumnRenamed("node", "u")), "u").groupBy("v").agg(F.min("label").alias("near"))
        hooked = labels.join(spread(near.withColumnRenamed("v", "node")), "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        parent = labels.select(F.col("node").alias("label"), F.col("label").alias("over"))
        moved = hooked.join(spread(parent), "label", "left").select("node", "old", F.least("label", F.coalesce("over", "label")).alias("label"))
        new = settled(moved.coalesce(files))
        changed = new.where("label <> old").limit(1).count()
        drop_written(labels)
        labels = new.select("node", "label")
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    drop_written(both)
    labels = labels.withColumnRenamed("label", "component")
    if nodes is None:
        return labels
    return nodes.select("node").distinct().join(spread(labels), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def toward_source(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """``(node, distance, next)``: of ``distances`` the neighbour that is one nearer (the smallest); null at a source."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    ahead = reached.select(F.col("node").alias("b"), (F.col("distance") + 1).alias("distance"))
    step = both.join(ahead, "b").groupBy(F.col("a").alias("node"), "distance").agg(F.min("b").alias("next"))
    return reached.join(step, ["node", "distance"], "left").select("node", "distance", "next")
