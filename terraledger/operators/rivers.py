"""Rules of river bitmaps, found by counts: neighbours, components and their edges.

Pixels are rows ``(row, col, kind)`` with the kinds ``flow``, ``source`` (a river's
one beginning), ``marker`` (where a tributary meets another river, the pixel before
the junction) and ``split`` (a river that parts, which a tree can't).  Without its
markers each river falls into segments, simple lines; a marker joins the end of
one to the inside of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraledger.operators.graph import components, spread
from terraledger.sources.lineage import written


def pixel_edges(pixels: DataFrame) -> DataFrame:
    """``(a, b)``: pixels ``(node, row, col)`` that share a side, each pair once."""
    step = F.explode(F.array(F.struct(F.lit(0).alias("r"), F.lit(1).alias("c")), F.struct(F.lit(1).alias("r"), F.lit(0).alias("c")))).alias("s")
    sent = pixels.select(F.col("node").alias("a"), "row", "col", step).select("a", (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"))
    return sent.join(spread(pixels.select(F.col("node").alias("b"), "row", "col")), ["row", "col"]).select("a", "b")


def bitmap_violations(pixels: DataFrame, width: int) -> DataFrame:
    """``(row, col, problem)``: what keeps a bitmap of at most ``width`` columns from being a set of river trees.

    Problems of a whole river stand at its first pixel.  Pixels of no kind are none;
    a pixel that stands several times is one.
    """
    node = (F.col("row") * width + F.col("col")).cast("long").alias("node")
    held = written(pixels.where("kind is not null").groupBy("row", "col").agg(F.min("kind").alias("kind")).select(node, "row", "col", "kind"))
    edges = written(pixel_edges(held))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    kinds = held.select(F.col("node").alias("b"), F.col("kind").alias("beside"))
    around = both.join(spread(kinds), "b").groupBy(F.col("a").alias("node")).agg(
        F.count(F.lit(1)).alias("degree"), F.count_if(F.col("beside") != "marker").alias("line"), F.count_if(F.col("beside") == "marker").alias("markers")
    )
    full = held.join(spread(around), "node", "left").fillna(0, ["degree", "line", "markers"])
    full = written(full)
    river = written(components(edges, nodes=held.select("node")))
    # segments: components without the markers
    plain = full.where("kind <> 'marker'")
    inner = edges.join(spread(plain.select(F.col("node").alias("a"))), "a", "left_semi").join(spread(plain.select(F.col("node").alias("b"))), "b", "left_semi")
    segment = written(components(inner, nodes=plain.select("node")).withColumnRenamed("component", "segment"))

    at = lambda df, problem: df.select("row", "col", F.lit(problem).alias("problem"))
    first = lambda df, problem: df.select(F.floor(F.col("component") / width).alias("row"), F.pmod("component", F.lit(width)).alias("col"), F.lit(problem).alias("problem"))
    out = at(full.where("kind = 'split'"), "a river parts")
    out = out.unionByName(at(full.where("kind = 'marker' and degree <> 2"), "a marker without two neighbours"))
    out = out.unionByName(at(full.where("kind = 'marker' and markers > 0"), "markers side by side"))
    out = out.unionByName(at(full.where("kind = 'source' and degree <> 1"), "a source that is no end"))
    out = out.unionByName(at(full.where("kind <> 'marker' and line > 2"), "a branch without a marker"))
    # a marker joins the end of one segment to the inside of another
    ends = both.join(spread(full.where("kind = 'marker' and degree = 2 and markers = 0").select(F.col("node").alias("a"))), "a", "left_semi")
    ends = ends.join(spread(plain.select(F.col("node").alias("b"), "line")), "b").join(spread(segment.select(F.col("node").alias("b"), "segment")), "b")
    joins = ends.groupBy(F.col("a").alias("node")).agg(F.array_sort(F.collect_list("line")).alias("lines"), F.max(F.when(F.col("line") == 1, F.col("segment"))).alias("tributary"))
    joins = written(joins.withColumn("sound", F.col("lines") == F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))))
    out = out.unionByName(at(joins.where("not sound").join(spread(full), "node"), "a marker that joins no end to an inside"))
    # one source a river, no cycle, and the source on the segment that flows into no other
    sizes = river.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    links = edges.join(spread(river.withColumnRenamed("node", "a")), "a").groupBy("component").agg(F.count(F.lit(1)).alias("links"))
    sources = full.where("kind = 'source'").join(spread(river), "node").groupBy("component").agg(F.count(F.lit(1)).alias("sources"))
    whole = sizes.join(spread(links), "component", "left").join(spread(sources), "component", "left").fillna(0, ["links", "sources"])
    out = out.unionByName(first(whole.where("sources <> 1"), "not one source")).unionByName(first(whole.where("links <> n - 1"), "a cycle"))
    feeds = joins.where("sound").groupBy(F.col("tributary").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    bad = full.where("kind = 'source'").join(spread(segment), "node").join(spread(feeds), "segment")
    return out.unionByName(at(bad, "a source on a tributary")).unionByName(first(feeds.where("n > 1").withColumnRenamed("segment", "component"), "a segment that flows two ways"))


def zone_levels(pixels: DataFrame, zone: str, level: str, marker: str, most: int = 5) -> DataFrame:
    """``(zone, level, plain_level, promoted)``: the largest level of each zone, ``most`` where it holds a marker; ``promoted``: only a marker lifts it there."""
    per = pixels.where(F.col(zone).isNotNull()).groupBy(F.col(zone).alias("zone")).agg(F.coalesce(F.max(level), F.lit(0)).cast("int").alias("plain_level"), F.coalesce(F.bool_or(marker), F.lit(False)).alias("_m"))
    return per.select("zone", F.when(F.col("_m"), F.lit(most)).otherwise(F.col("plain_level")).alias("level"), "plain_level", (F.col("_m") & (F.col("plain_level") < most)).alias("promoted"))
