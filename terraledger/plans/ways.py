"""Queries of ways, links, covers and kept stages; parts with a value are the open cells of a grid of 40 columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.operators import paths, rivers
from terraledger.operators.graph import spread
from terraledger.plans.graphs import TREE, tree
from terraledger.plans.gridded import CELLS, cells
from terraledger.plans.registry import query
from terraledger.sources import stages
from terraledger.sources.lineage import shared_folder
from terraledger.sources.sinks import fingerprint
from terraledger.sources.tables import table


def open_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells that can be entered, named by one number, with the basin they lie in."""
    return cells(spark, sf).where("value is not null").select((F.col("row") * 40 + F.col("col")).cast("long").alias("node"), "row", "col", F.expr("(row + col div 3) div 9").cast("long").alias("group"))


def beside(nodes: DataFrame) -> DataFrame:
    """Edges between open cells that share a side."""
    step = F.explode(F.array(F.struct(F.lit(0).alias("r"), F.lit(1).alias("c")), F.struct(F.lit(1).alias("r"), F.lit(0).alias("c")))).alias("s")
    sent = nodes.select(F.col("node").alias("a"), "row", "col", step).select("a", (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"))
    return sent.join(spread(nodes.select(F.col("node").alias("b"), "row", "col")), ["row", "col"]).select("a", "b")


GRID = f"""{CELLS}, n AS (SELECT row * 40 + col AS node, row, col, (row + col // 3) // 9 AS basin FROM c WHERE value IS NOT NULL),
e AS (SELECT a.node AS a, b.node AS b, a.basin AS ba, b.basin AS bb FROM n a JOIN n b ON abs(a.row - b.row) + abs(a.col - b.col) = 1)"""


@query(f"""WITH RECURSIVE {TREE}, w AS (SELECT id AS start, 0 AS place, id AS node FROM t WHERE id % 7 = 3 UNION ALL SELECT w.start, w.place + 1, t.down_id FROM w JOIN t ON t.id = w.node WHERE t.down_id IS NOT NULL)
SELECT start, CAST(place AS BIGINT) AS place, node FROM w""")
def ways_down(spark: SparkSession, sf: str) -> DataFrame:
    """The way from each seventh node down to its outlet, numbered without walking it."""
    nodes = tree(spark, sf)
    return paths.follow(nodes.select(F.col("id").alias("node"), F.col("down_id").alias("next")), nodes.where("id % 7 = 3").select("id"))


@query(f"""WITH RECURSIVE {GRID}, q AS (SELECT a.node AS pair, a.node AS a, b.node AS b FROM n a JOIN n b ON b.row = a.row + 2 AND b.col = a.col + 5 AND a.node % 11 = 0),
r AS (SELECT pair, b, a AS here, 0 AS d FROM q UNION SELECT r.pair, r.b, e.b, r.d + 1 FROM r JOIN e ON e.a = r.here WHERE r.d < 9)
SELECT pair, CAST(min(d) AS BIGINT) AS length, true AS sound FROM r WHERE here = b GROUP BY 1""")
def shortest_ways(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths between pairs of cells, at most nine steps; ``sound``: the way given has that length, both ends, and steps between neighbours."""
    nodes = open_cells(spark, sf)
    far = nodes.select(F.col("node").alias("b"), (F.col("row") - 2).alias("row"), (F.col("col") - 5).alias("col"))
    pairs = nodes.where("node % 11 = 0").join(spread(far), ["row", "col"]).select(F.col("node").alias("pair"), F.col("node").alias("a"), "b")
    lengths, ways = paths.shortest_ways(beside(nodes), pairs, 9)
    after = ways.select("pair", (F.col("place") - 1).alias("place"), F.col("node").alias("after"))
    apart = F.abs(F.col("node") - F.col("after"))
    steps = ways.join(spread(after), ["pair", "place"], "left").groupBy("pair").agg(
        F.count(F.lit(1)).alias("cells"), F.bool_and(F.col("after").isNull() | apart.isin(1, 40)).alias("near"), F.min_by("node", "place").alias("first"), F.max_by("node", "place").alias("last")
    )
    met = lengths.join(spread(steps), "pair", "left").join(spread(pairs), "pair")
    return met.select("pair", "length", F.coalesce((F.col("cells") == F.col("length") + 1) & F.col("near") & (F.col("first") == F.col("a")) & (F.col("last") == F.col("b")), F.lit(False)).alias("sound"))


@query(f"""WITH RECURSIVE {GRID}, s AS (SELECT node AS source, basin FROM n WHERE node % 13 = 5),
r AS (SELECT source, basin, source AS here, 0 AS d FROM s UNION SELECT r.source, r.basin, e.b, r.d + 1 FROM r JOIN e ON e.a = r.here AND e.ba = r.basin AND e.bb = r.basin WHERE r.d < 5),
p AS (SELECT r.basin, r.source AS one, t.source AS two, min(r.d) AS d FROM r JOIN s t ON t.source = r.here AND t.source <> r.source GROUP BY ALL),
k AS (SELECT unnest(range(0, 6)) AS k),
m AS (SELECT k, source, source AS seen FROM k, s UNION SELECT m.k, m.source, p.two FROM m JOIN p ON p.one = m.seen AND p.d <= m.k),
parts AS (SELECT k, s.basin, count(DISTINCT low) AS parts FROM (SELECT k, source, min(seen) AS low FROM m GROUP BY 1, 2) JOIN s USING (source) GROUP BY ALL)
SELECT a.basin, CAST(b.k AS BIGINT) AS length, a.parts - b.parts AS links FROM parts a JOIN parts b ON b.basin = a.basin AND b.k = a.k + 1 WHERE a.parts > b.parts""")
def gap_closing(spark: SparkSession, sf: str) -> DataFrame:
    """Links over gaps of at most five steps inside a basin, by length; the SQL counts how many parts each longer reach leaves."""
    nodes = open_cells(spark, sf)
    links, _ = paths.gap_links(beside(nodes), nodes.where("node % 13 = 5").select(F.col("node").alias("id")), 5, groups=nodes)
    return links.join(spread(nodes.select(F.col("node").alias("one"), F.col("group").alias("basin"))), "one").groupBy("basin", "length").agg(F.count(F.lit(1)).alias("links"))


@query("""WITH RECURSIVE p AS (SELECT a.s_suppkey AS port, list(b.n_nationkey * 100 + c) AS own FROM supplier a JOIN nation b ON (a.s_suppkey * 7 + b.n_nationkey * 3) % 5 < 2 JOIN range(4) r(c) ON (a.s_suppkey + c * b.n_nationkey) % 3 = 0 GROUP BY 1),
g AS (SELECT -1 AS place, CAST(NULL AS BIGINT) AS port, CAST(0 AS BIGINT) AS gain, CAST([] AS BIGINT[]) AS covered
      UNION ALL SELECT g.place + 1, x.port, x.gain, list_distinct(list_concat(g.covered, x.own)) FROM g, LATERAL (
        SELECT p.port, p.own, len(list_filter(p.own, lambda n: NOT list_contains(g.covered, n))) AS gain FROM p ORDER BY 3 DESC, 1 LIMIT 1) x WHERE x.gain > 0)
SELECT port, gain, place FROM g WHERE place >= 0""")
def port_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers taken in the order of what they newly cover; the SQL takes one after the other."""
    k, n = F.col("s_suppkey"), F.col("n_nationkey")
    near = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("c")
    nations = table(spark, sf, "nation").select("n_nationkey", near).withColumn("three", (n * 3) % 5)
    # suppliers meet nations by the remainders that make them neighbours
    ask = table(spark, sf, "supplier").withColumn("three", F.explode(F.filter(F.array(*[F.lit(j) for j in range(5)]), lambda j: (k * 7 + j) % 5 < 2)))
    reach = ask.join(nations, "three").where((k + F.col("c") * n) % 3 == 0).select(k.cast("long").alias("port"), (n * 100 + F.col("c")).cast("long").alias("node"))
    return paths.greedy_cover(reach)


@query("""WITH t AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1), u AS (SELECT count(*) AS rows, CAST(sum(n) AS BIGINT) AS total FROM t)
SELECT k AS step, kind, rows, total FROM u, (VALUES (1, 'made'), (2, 'reused'), (3, 'made'), (4, 'made'), (5, 'reused')) s(k, kind)""")
def stage_reuse(spark: SparkSession, sf: str) -> DataFrame:
    """A stage made, taken again, made for another setting and another code, and taken again."""
    part = table(spark, sf, "part")
    folder = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    build = lambda: part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    out = []
    for step, (setting, code) in enumerate([(1, "a"), (1, "a"), (2, "a"), (1, "b"), (2, "a")], 1):
        made, reused = stages.stage(folder, "brands", {"part": part.select("p_brand")}, {"setting": setting}, code, build)
        out.append(made.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total")).select(F.lit(step).alias("step"), F.lit("reused" if reused else "made").alias("kind"), "rows", "total"))
    first, *others = out
    for o in others:
        first = first.unionByName(o)
    return first


@query("""WITH c AS (SELECT count(*) AS n FROM part) SELECT layer, issue, n AS cells FROM c, (VALUES ('doubled', 'a place stands twice'), ('short', 'other places'), ('short', 'not pinned'), ('doubled', 'not pinned'), ('altered', 'other content')) v(layer, issue)""")
def layer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Layers that may not be used with the first: other places, a place twice, other content than was pinned."""
    base = cells(spark, sf)
    layers = {"base": base, "same": base.withColumn("value", F.col("value") + 1), "short": base.where("col < 39"), "doubled": base.unionByName(base.where("row = 0 and col = 0")), "altered": base.withColumn("value", F.lit(0.0))}
    pins = {"base": fingerprint(base), "same": fingerprint(layers["same"]), "altered": "another"}
    return stages.alignment_issues(layers, pins).crossJoin(F.broadcast(base.agg(F.count(F.lit(1)).alias("cells"))))


#: A bitmap of pixels by size: about half are rivers, some of them sources, markers or splits.
RIVERS = f"""{CELLS.replace("p_retailprice END AS value FROM part", "p_retailprice END AS value, p_size FROM part")},
p AS (SELECT row * 40 + col AS node, row, col, CASE WHEN p_size = 8 THEN 'split' WHEN p_size % 10 = 0 THEN 'marker' WHEN p_size % 14 = 2 THEN 'source' ELSE 'flow' END AS kind FROM c WHERE p_size % 2 = 0 AND (row + col) % 13 > 0),
e AS (SELECT a.node AS a, b.node AS b, a.kind AS ka, b.kind AS kb FROM p a JOIN p b ON abs(a.row - b.row) + abs(a.col - b.col) = 1),
d AS (SELECT p.*, count(e.b) AS degree, count(*) FILTER (e.kb <> 'marker') AS line, count(*) FILTER (e.kb = 'marker') AS markers FROM p LEFT JOIN e ON e.a = p.node GROUP BY ALL),
r AS (SELECT node, node AS seen FROM p UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen), w AS (SELECT node, min(seen) AS river FROM r GROUP BY 1),
s AS (SELECT node, node AS seen FROM p WHERE kind <> 'marker' UNION SELECT s.node, e.b FROM s JOIN e ON e.a = s.seen AND e.kb <> 'marker'), g AS (SELECT node, min(seen) AS segment FROM s GROUP BY 1),
j AS (SELECT e.a AS node, list_sort(list(n.line)) AS lines, max(CASE WHEN n.line = 1 THEN g.segment END) AS tributary FROM e JOIN d m ON m.node = e.a AND m.kind = 'marker' AND m.degree = 2 AND m.markers = 0 JOIN d n ON n.node = e.b JOIN g ON g.node = e.b GROUP BY 1),
u AS (SELECT river, count(*) AS n, count(*) FILTER (kind = 'source') AS sources, sum(degree) / 2 AS links FROM d JOIN w USING (node) GROUP BY 1)"""


@query(f"""WITH RECURSIVE {RIVERS}
SELECT row, col, 'a river parts' AS problem FROM d WHERE kind = 'split' UNION ALL SELECT row, col, 'a marker without two neighbours' FROM d WHERE kind = 'marker' AND degree <> 2
UNION ALL SELECT row, col, 'markers side by side' FROM d WHERE kind = 'marker' AND markers > 0 UNION ALL SELECT row, col, 'a source that is no end' FROM d WHERE kind = 'source' AND degree <> 1
UNION ALL SELECT row, col, 'a branch without a marker' FROM d WHERE kind <> 'marker' AND line > 2 UNION ALL SELECT row, col, 'a marker that joins no end to an inside' FROM d JOIN j USING (node) WHERE lines <> [1, 2]
UNION ALL SELECT river // 40, river % 40, 'not one source' FROM u WHERE sources <> 1 UNION ALL SELECT river // 40, river % 40, 'a cycle' FROM u WHERE links <> n - 1
UNION ALL SELECT row, col, 'a source on a tributary' FROM d JOIN g USING (node) WHERE kind = 'source' AND segment IN (SELECT tributary FROM j WHERE lines = [1, 2])
UNION ALL SELECT tributary // 40, tributary % 40, 'a segment that flows two ways' FROM j WHERE lines = [1, 2] GROUP BY tributary HAVING count(*) > 1""")
def river_grammar(spark: SparkSession, sf: str) -> DataFrame:
    """What keeps a bitmap from being a set of river trees."""
    size = F.col("p_size")
    kind = F.when(size == 8, "split").when(size % 10 == 0, "marker").when(size % 14 == 2, "source").otherwise("flow")
    row, col = F.expr("p_partkey div 40"), F.col("p_partkey") % 40
    pixels = table(spark, sf, "part").select(row.alias("row"), col.alias("col"), F.when((size % 2 == 0) & ((row + col) % 13 > 0), kind).alias("kind"))
    return rivers.bitmap_violations(pixels, 40)


@query(f"""WITH {CELLS}, z AS (SELECT row // 3 * 100 + col // 4 AS zone, CASE WHEN value IS NOT NULL THEN CAST(row * 7 + col * 3 AS INTEGER) % 6 END AS level, (row * 5 + col) % 37 = 0 AS marker FROM c)
SELECT zone, CASE WHEN bool_or(marker) THEN 5 ELSE coalesce(max(level), 0) END AS level, coalesce(max(level), 0) AS plain_level, bool_or(marker) AND coalesce(max(level), 0) < 5 AS promoted FROM z GROUP BY 1""")
def zone_levels(spark: SparkSession, sf: str) -> DataFrame:
    rows = cells(spark, sf).select(F.expr("row div 3 * 100 + col div 4").alias("zone"), F.when(F.col("value").isNotNull(), ((F.col("row") * 7 + F.col("col") * 3) % 6).cast("int")).alias("level"), ((F.col("row") * 5 + F.col("col")) % 37 == 0).alias("marker"))
    return rivers.zone_levels(rows, "zone", "level", "marker")
