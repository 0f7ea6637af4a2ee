"""Centroid clustering whose assignments use the threshold algorithm.

The centroids' components are sorted once per dimension.  For every vector
each dimension's list is walked outward from the vector's own value, one
centroid a step, nearer neighbours first.  A centroid met for the first time
in any list gets its exact distance.  The squares of the frontiers' distances,
one of each list, add up to a bound that no centroid still unmet is below; the
walk stops when that sum strictly exceeds the best exact distance, so a tied
centroid with a smaller number is always met.

A round is one pass: tasks add up their vectors by cluster and dimension,
Spark adds the tasks' sums, and the new centroids (clusters times dimensions
integers, whatever the data) go out with the next round's tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stage

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Vectors that are walked at once.
ROWS = 4096
#: Components whose squared distances still add up within 64 bits.
LARGEST = 1 << 27

_FIGURES = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# ------------------------------------------------------------- assignment
def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, exact distances computed) of each row of
    ``x``; of equally near centroids the smaller number."""
    n, k = len(x), len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(x.shape[1])
    right = np.stack([np.searchsorted(values[:, d], x[:, d]) for d in dims], axis=1) if n else np.zeros(x.shape, np.int64)
    left = right - 1
    who, best, asked = np.full(n, k), np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    met, live = np.zeros((n, k), bool), np.arange(n)
    for _ in range(k):                                            # a list holds each centroid once
        own = x[live]
        down, up = left[live], right[live]
        below = np.where(down >= 0, own - values[np.maximum(down, 0), dims], LARGEST * 2)
        above = np.where(up < k, values[np.minimum(up, k - 1), dims] - own, LARGEST * 2)
        frontier = np.minimum(below, above)
        open_ = (frontier * frontier).sum(axis=1) <= best[live]
        live, down, up, below, above = live[open_], down[open_], up[open_], below[open_], above[open_]
        if not len(live):
            break
        lower = below <= above
        reached = order[np.where(lower, down, up), dims]
        left[live], right[live] = down - lower, up + ~lower
        fresh = np.zeros((len(live), k), bool)
        fresh[np.arange(len(live))[:, None], reached] = True
        fresh &= ~met[live]
        met[live] |= fresh
        row, centroid = np.nonzero(fresh)
        apart = x[live[row]] - centroids[centroid]
        distance = (apart * apart).sum(axis=1)
        asked[live] += fresh.sum(axis=1)
        sort = np.lexsort((centroid, distance, row))
        row, centroid, distance = row[sort], centroid[sort], distance[sort]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
        at, centroid, distance = live[row[first]], centroid[first], distance[first]
        better = (distance < best[at]) | ((distance == best[at]) & (centroid < who[at]))
        who[at[better]], best[at[better]] = centroid[better], distance[better]
    return who, best, asked


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ArithmeticError(f"components from {LARGEST} on have squared distances beyond 64 bits")
    return x


def _walked(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = _matrix(part.column(1), centroids.shape[1])
            yield part, x, *nearest(x, centroids)[:2]


def _sum_task(centroids: np.ndarray):
    """Sums of a task's vectors: cluster, dimension, total, n."""
    def run(batches):
        k, dimensions = centroids.shape
        totals, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for _, x, who, _ in _walked(batches, centroids):
            for c in np.unique(who).tolist():
                totals[c] += x[who == c].sum(axis=0)
            counts += np.bincount(who, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dimensions), pa.int32()), pa.array(np.tile(np.arange(dimensions), k), pa.int32()),
             pa.array(totals.ravel()), pa.array(np.repeat(counts, dimensions))], names=["cluster", "dimension", "total", "n"])
    return run


def _place_task(centroids: np.ndarray):
    def run(batches):
        for part, _, who, best in _walked(batches, centroids):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(who, pa.int32()), pa.array(best)], names=["vec_id", "cluster", "distance"])
    return run


# ------------------------------------------------------------- the operator
def whole_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): rows with exactly ``dimensions`` finite components, each
    turned into the integer floor(scale * component)."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    kept = rows.filter((F.size("embedding") == dimensions) & F.forall("embedding", finite))
    return kept.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of "seed:vec_id", in that order
    (equal hashes: by components); ``clusters`` rows at most reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r.v for r in vectors.select(key.alias("k"), "v").orderBy("k", "v").limit(clusters).collect()], np.int64)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floored means of the clusters; empty clusters keep theirs."""
    wide = "decimal(38,0)"
    sums = (vectors.mapInArrow(_sum_task(centroids), "cluster int, dimension int, total long, n long")
            .groupBy("cluster", "dimension").agg(F.sum(F.col("total").cast(wide)).alias("total"), F.sum("n").alias("n")).filter("n > 0"))
    out = centroids.copy()
    for r in sums.collect():                                      # clusters times dimensions rows at most
        out[r.cluster, r.dimension] = int(r.total) // r.n
    return out


def cluster_vectors(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
                    dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of
    every vector that ``whole_vectors`` keeps.

    Ties go to the smaller cluster number.  Repeated rows count each and give
    repeated results; a null vec_id hashes as empty text.  With fewer vectors
    than ``clusters`` there are as many clusters as vectors; without any the
    result is empty.  Null or misshapen vectors have no row.  Components from
    131,072 on (at scale 1024) have distances beyond 64 bits and are an error.
    Further columns are ignored.
    """
    spark = rows.sparkSession
    vectors = stage(whole_vectors(rows, dimensions, scale), "threshold-vectors")
    centroids = first_centroids(vectors, clusters, seed).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(vectors, centroids)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    placed = stage(vectors.mapInArrow(_place_task(centroids), f"vec_id {kind}, cluster int, distance long")
                   if len(centroids) else vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), "threshold-placed")
    sums = {r.cluster: r.n for r in placed.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}   # a row for each cluster
    figures = [(c, n, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
               for c, n in sums.items()]
    return placed.join(F.broadcast(spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")),
                       "cluster").select("vec_id", *_FIGURES)


def op12_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same rounds as plain SQL: all distances, no lists."""
    def placed(r: int) -> str:
        return f"""
placed_{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(far * {CLUSTERS} + cluster) AS near
  FROM (SELECT rid, vec_id, v, cluster,
               CAST(list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, {DIMENSIONS + 1})]) AS BIGINT) AS far
        FROM vectors, centroids_{r})
  GROUP BY rid
)"""

    def moved(r: int) -> str:
        return f"""
sums_{r} AS (
  SELECT near % {CLUSTERS} AS cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
  FROM placed_{r}, range(1, {DIMENSIONS + 1}) AS t(i) GROUP BY ALL
),
means_{r} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums_{r} GROUP BY cluster
),
centroids_{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, p.c) AS c FROM centroids_{r} p LEFT JOIN means_{r} m USING (cluster)
)"""

    steps = [f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS}
)""", f"""
centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c
  FROM (SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM vectors ORDER BY h, v LIMIT {CLUSTERS})
)"""]
    for r in range(ROUNDS):
        steps += [placed(r), moved(r)]
    steps.append(placed(ROUNDS))
    return ",".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM (SELECT vec_id, near % {CLUSTERS} AS cluster, near // {CLUSTERS} AS distance FROM placed_{ROUNDS})
JOIN centroids_{ROUNDS} USING (cluster)
"""


OP12_SQL = _sql()
