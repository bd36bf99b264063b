"""Clustering by centroids with partial-distance search on whole numbers.

Each component ``x`` becomes the integer ``floor(256 x)``.  A task accumulates
squared differences over the dimensions of highest variance first, a few at a
time, and abandons a centroid for a vector as soon as its partial distance is
strictly above the best full distance known; whatever survives finishes all
dimensions, so the nearest centroid and its distance are exact.  Sums of a round
are added inside each task before the shuffle, so one row a task and centroid
moves, and ``k`` rows reach the driver, however many vectors there are.

Defined cases: vectors that are null, of another length, or that hold a null or
non-finite component are left out; a null id takes part and is hashed as the
empty text; repeated rows are vectors of their own; ties go to the smaller
centroid; with fewer vectors than ``k`` there are as many centroids as vectors;
an empty table gives no rows; other columns are not read.  A component beyond
2^20 in size would overflow the distances and raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraledger.sources.lineage import written

#: Dimensions that one step of the search adds.
STEP = 8
#: Beyond this size of a whole-number component a squared distance could pass 63 bits.
LARGEST = 1 << 28


def whole_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 256) -> DataFrame:
    """Rows ``(id, v)`` of the vectors with exactly ``dims`` known, finite components, as whole numbers."""
    x = F.col(vector_col)
    known = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    v = F.when(F.exists(v, lambda c: F.abs(c) >= LARGEST), F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(v)
    # a vector of another length is null here: the rule holds whatever order the filter's parts run in
    right = F.when((F.size(x) == dims) & known, v)
    return df.select(F.col(id_col).alias("id"), right.alias("v")).where("v IS NOT NULL")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``seed:id``; equal hashes by components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def by_variance(vectors: DataFrame, dims: int) -> np.ndarray:
    """Dimensions in descending order of their variance over all vectors."""
    row = vectors.agg(*[F.var_pop(F.col("v")[j].cast("double")) for j in range(dims)]).first()
    return np.argsort([-(x or 0.0) for x in row], kind="stable")


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` its nearest centroid (ties: the smaller number) and the squared distance.

    The first step's partial distances choose a centroid whose full distance is
    the first bound; the others then follow in ascending number.
    """
    n, k = len(x), len(centroids)
    x, c = np.ascontiguousarray(x[:, order].T), centroids[:, order]
    head = np.zeros((k, n), np.int64)
    for d in range(min(STEP, len(order))):
        head += (x[d] - c[:, d, None]) ** 2
    best_of = head.argmin(0)
    best = head[best_of, np.arange(n)]
    for d in range(STEP, len(order)):
        best += (x[d] - c[best_of, d]) ** 2
    for j in range(k):
        rows = np.flatnonzero((head[j] <= best) & (best_of != j))
        partial = head[j, rows]
        for lo in range(STEP, len(order), STEP):
            if not len(rows):
                break
            for d in range(lo, min(lo + STEP, len(order))):
                partial += (x[d, rows] - c[j, d]) ** 2
            going = partial <= best[rows]
            rows, partial = rows[going], partial[going]
        closer = (partial < best[rows]) | ((partial == best[rows]) & (j < best_of[rows]))
        rows, partial = rows[closer], partial[closer]
        best_of[rows], best[rows] = j, partial
    return best_of, best


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    v = batch.column(batch.schema.get_field_index("v"))
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def assigned(vectors: DataFrame, centroids: np.ndarray, order: np.ndarray) -> DataFrame:
    """Rows ``(id, cluster, distance)``; ``k`` centroids of fixed width travel with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of, distance = nearest(_matrix(batch), centroids, order)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    schema = vectors.select("id").schema.add("cluster", "integer").add("distance", "long")
    return vectors.mapInArrow(run, schema)


def moved(vectors: DataFrame, centroids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means; empty ones stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                of, _ = nearest(x, centroids, order)
                by = np.argsort(of, kind="stable")
                met, at = np.unique(of[by], return_index=True)
                sums[met] += np.add.reduceat(x[by], at)
                counts += np.bincount(of, minlength=k)
        own = np.flatnonzero(counts)
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(counts[own]), pa.array(sums[own].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    parts = vectors.mapInArrow(run, "cluster int, n long, s array<long>")
    # decimals: sums over a whole corpus stay exact
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[d].cast("decimal(20,0)")).alias(f"s{d}") for d in range(dims)])
    new = centroids.copy()
    for r in total.collect():
        new[r.cluster] = [int(r[f"s{d}"]) // r.n for d in range(dims)]
    return new


def cluster(df: DataFrame, *, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows ``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` after ``rounds`` of moving and a last assignment."""
    spark = df.sparkSession
    vectors = written(whole_vectors(df, id_col=id_col, vector_col=vector_col, dims=dims, scale=scale))
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        nothing = vectors.select("id", *[F.lit(None).cast(t).alias(n) for n, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
        return nothing.where("false")
    order = by_variance(vectors, dims)
    for _ in range(rounds):
        centroids = moved(vectors, centroids, order)
    last = assigned(vectors, centroids, order)
    # k rows at most: sums first, then joined by broadcast
    sums = {r.cluster: r.s for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    facts = [(j, sums.get(j, 0), total, sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256) -> str:
    """DuckDB SQL of the same rows for one table ``embeddings``: every vector against every centroid in every round."""
    distance = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"

    def nearest_of(j: int) -> str:
        return f"""a{j} AS MATERIALIZED (
            SELECT rid, vec_id, v, best.c AS cluster, best.d AS distance FROM (
                SELECT x.rid, x.vec_id, x.v, min(struct_pack(d := CAST({distance} AS BIGINT), c := c.c)) AS best
                FROM x CROSS JOIN c{j} c GROUP BY x.rid, x.vec_id, x.v))"""

    def moved_of(j: int) -> str:
        return f"""c{j + 1} AS MATERIALIZED (
            SELECT c.c, coalesce(m.v, c.v) AS v FROM c{j} c LEFT JOIN (
                SELECT cluster, list(f ORDER BY d) AS v FROM (
                    SELECT cluster, d, CAST((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS f
                    FROM (SELECT cluster, unnest(v) AS e, generate_subscripts(v, 1) AS d FROM a{j}) GROUP BY cluster, d) GROUP BY cluster) m
            ON m.cluster = c.c)"""

    steps = ", ".join(s for j in range(rounds + 1) for s in ([nearest_of(j)] + ([moved_of(j)] if j < rounds else [])))
    return f"""
        WITH x AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
        c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY key, v) - 1 AS INTEGER) AS c, v FROM (
                SELECT v, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS key FROM x ORDER BY key, v LIMIT {k})),
        {steps},
        h AS (SELECT c, sha256(array_to_string(v, ',')) AS centroid_sha256 FROM c{rounds})
        SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
        FROM a{rounds} a JOIN h ON h.c = a.cluster"""
