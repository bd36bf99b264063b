"""Queries of forests and graphs; parts form a binary tree by their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraledger.functions.expr import scaled_round
from terraledger.operators import graph
from terraledger.plans.registry import query
from terraledger.sources.lineage import written
from terraledger.sources.tables import table


def tree(spark: SparkSession, sf: str) -> DataFrame:
    down = F.when(F.col("p_partkey") > 0, F.expr("(p_partkey - 1) div 2"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), down.alias("down_id"), F.col("p_size").cast("long").alias("size"), F.col("p_retailprice").alias("price"))


TREE = "t AS (SELECT p_partkey AS id, CASE WHEN p_partkey > 0 THEN (p_partkey - 1) // 2 END AS down_id, CAST(p_size AS BIGINT) AS size, p_retailprice AS price FROM part)"
PATHS = f"WITH RECURSIVE {TREE}, a AS (SELECT id, id AS below, 0 AS hops FROM t UNION ALL SELECT a.id, t.down_id, hops + 1 FROM a JOIN t ON a.below = t.id WHERE t.down_id IS NOT NULL)"


@query(f"{PATHS} SELECT below AS id, CAST(max(hops) AS BIGINT) AS level FROM a GROUP BY 1")
def topology_level(spark: SparkSession, sf: str) -> DataFrame:
    return graph.heights(tree(spark, sf))


@query(f"{PATHS} SELECT below AS id, CAST(sum(size) AS BIGINT) AS total, count(*) AS upstream FROM a JOIN t USING (id) GROUP BY 1")
def upstream_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    return graph.accumulate(tree(spark, sf), "size")


@query(f"{PATHS} SELECT DISTINCT below AS id FROM a JOIN t USING (id) WHERE size >= 45")
def downstream_closure(spark: SparkSession, sf: str) -> DataFrame:
    nodes = tree(spark, sf)
    return graph.downstream_closure(nodes, nodes.where("size >= 45"))


def _level(k: int) -> str:
    """SQL of one level of the routing: inflow from the level's children, all of which lie in earlier levels."""
    return f"""r{k} AS (SELECT n.id, n.down_id, n.generated, n.kept, n.want, n.generated + coalesce((SELECT sum(p.outflow) FROM q{k - 1} p WHERE p.down_id = n.id), 0) AS flow FROM n WHERE level = {k}),
q{k} AS (SELECT * FROM q{k - 1} UNION ALL SELECT id, down_id, generated, flow * (1 - kept), least(flow * kept, want), greatest(flow * kept - least(flow * kept, want), 0) FROM r{k})"""


#: Levels that the SQL writes out; the parts are a binary tree of at most 2^16.
LEVELS = 16
ROUTE = f"""{PATHS}, h AS (SELECT below AS id, max(hops) AS level FROM a GROUP BY 1),
n AS (SELECT t.id, t.down_id, CAST(size * 0.5 AS DOUBLE) AS generated, CAST(t.id % 11 AS DOUBLE) AS want, CAST(1 - (t.id % 5) / 50.0 AS DOUBLE) AS kept, level FROM t JOIN h USING (id)),
q0 AS (SELECT id, down_id, generated, generated * (1 - kept) AS lost, least(generated * kept, want) AS allocated, greatest(generated * kept - least(generated * kept, want), 0) AS outflow FROM n WHERE level = 0),
{", ".join(_level(k) for k in range(1, LEVELS + 1))}"""


def watershed(spark: SparkSession, sf: str) -> DataFrame:
    nodes = tree(spark, sf).withColumn("runoff", F.col("size").cast("double")).withColumn("demand", (F.col("id") % 11).cast("double"))
    return nodes.withColumn("survival", 1 - (F.col("id") % 5) / 50.0)


@query(f"{ROUTE} SELECT id, round(allocated, 4) AS allocated, round(outflow, 4) AS outflow, round(lost, 4) AS lost FROM q{LEVELS}")
def route_allocate(spark: SparkSession, sf: str) -> DataFrame:
    out = graph.route(watershed(spark, sf), "runoff", "demand", 0.5, "survival")
    return out.select("id", *[scaled_round(F.col(c), 4).alias(c) for c in ("allocated", "outflow", "lost")])


@query(f"{ROUTE} SELECT round(sum(generated), 2) AS generated, round(sum(allocated), 2) AS allocated, round(sum(lost), 2) AS lost, round(sum(CASE WHEN down_id IS NULL THEN outflow ELSE 0 END), 2) AS at_outlets, true AS balanced FROM q{LEVELS}")
def route_balance(spark: SparkSession, sf: str) -> DataFrame:
    nodes = watershed(spark, sf)
    out = graph.route_balance(graph.route(nodes, "runoff", "demand", 0.5, "survival"), nodes)
    return out.select(*[scaled_round(F.col(c), 2).alias(c) for c in ("generated", "allocated", "lost", "at_outlets")], (F.abs("residual") < 1e-3).alias("balanced"))


HEADS = f"""{TREE}, m AS (SELECT down_id, id, row_number() OVER (PARTITION BY down_id ORDER BY size DESC, id) AS k FROM t WHERE down_id IS NOT NULL)"""


@query(f"""WITH RECURSIVE {HEADS}, s AS (
    SELECT t.id, t.id AS head, 0 AS place FROM t LEFT JOIN m ON m.id = t.id AND m.k = 1 WHERE m.id IS NULL
    UNION ALL SELECT m.id, s.head, s.place + 1 FROM s JOIN m ON m.down_id = s.id AND m.k = 1)
SELECT id, head, CAST(place AS BIGINT) AS place FROM s""")
def branches(spark: SparkSession, sf: str) -> DataFrame:
    """Forests cut into branches: the heaviest of the nodes above another continues its branch."""
    return graph.stem_heads(tree(spark, sf), "size")


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS a, (l_suppkey * 7 + 3) % 20 + (l_suppkey // 20) * 20 AS b FROM lineitem),
n AS (SELECT a AS node FROM e UNION SELECT b FROM e), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT node, node AS seen FROM n UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
SELECT node, min(seen) AS component FROM r GROUP BY 1""")
def connected_components(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("a")).distinct().withColumn("b", F.expr("(a * 7 + 3) % 20 + (a div 20) * 20"))
    edges = written(edges)
    return graph.components(edges, nodes=edges.select(F.explode(F.array("a", "b")).alias("node")))


@query(f"""WITH {TREE}, b AS (SELECT id, CASE WHEN id % 23 = 4 THEN id + 1000000 ELSE down_id END AS down_id FROM t) SELECT id, down_id FROM b WHERE down_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.id = b.down_id)""")
def dangling_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links that lead to no node, listed and not raised."""
    nodes = tree(spark, sf).withColumn("down_id", F.when(F.col("id") % 23 == 4, F.col("id") + 1_000_000).otherwise(F.col("down_id")))
    return graph.dangling(nodes).select("id", "down_id")
