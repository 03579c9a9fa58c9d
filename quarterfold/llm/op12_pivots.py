"""Centroid clustering with Ptolemaic pivots.

Lloyd's rounds on integer vectors. The start centroids are also pivots, and every vector keeps its distances to them.
By Ptolemy's inequality, for a vector x, a centroid c and pivots p, s,

    d(x, c) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)| / d(p, s),

so cached distances and those of the few centroids to the pivots bound every distance from below. Each centroid uses
a fixed pair for each of the PAIRS pivots farthest from the one it began as, near which the bound is close. The centroid of
the least bound is measured; others are measured exactly only if their bound, lowered by more than all rounding can
come to, does not exceed what has been found. The result is that of measuring everything, ties included.

Tasks add up their vectors by cluster; Spark adds up tasks. Only centroids (k vectors) come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm.common import table, written

DIMENSIONS, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3
PAIRS = 3
SLACK = 2.0**-48  # a bound's relative rounding error is below 16 * 2**-53
LARGEST = 1 << 27  # squared distances of components up to it fit 63 bits
SMALL = 1 << 22  # up to it they are exact as doubles


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to a vector, or row by row."""
    difference = a - b
    if not len(difference):
        return np.zeros(0, dtype=np.int64)
    if max(int(np.abs(a).max()), int(np.abs(b).max())) <= SMALL:
        difference = difference.astype(np.float64)
    return np.einsum("ij,ij->i", difference, difference).astype(np.int64)


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(vectors, pivots), each correct to two units in the last place."""
    return np.sqrt(np.stack([squared(vectors, p) for p in pivots], axis=1).astype(np.float64))


@dataclass
class Bounds:
    """Centroids and what the lower bounds need of them."""

    centroids: np.ndarray
    pivots: np.ndarray

    def __post_init__(self):
        self.to_pivots = distances(self.centroids, self.pivots)
        self.between = distances(self.pivots, self.pivots)
        far = np.argsort(-self.between, axis=1, kind="stable")[:, :PAIRS]
        self.pairs = [(j, int(s)) for j in range(len(self.pivots)) for s in far[j] if self.between[j, s] > 0]

    def least(self, cached: np.ndarray) -> np.ndarray:
        """(vectors, centroids): no distance is below it. cached: distances to the pivots."""
        found = np.zeros((len(cached), len(self.centroids)))
        for j, s in self.pairs:
            one, other = cached[:, j] * self.to_pivots[j, s], cached[:, s] * self.to_pivots[j, j]
            bound = (np.abs(one - other) - SLACK * (one + other)) / self.between[j, s]
            np.maximum(found[:, j], bound * (1 - SLACK), out=found[:, j])
        return found

    def assigned(self, vectors: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (ties: the smaller number), squared distance, and how many distances were measured."""
        least = self.least(cached)
        cluster = np.argmin(least, axis=1)
        best = squared(vectors, self.centroids[cluster])
        first, measured = cluster.copy(), len(vectors)
        least = least * least * (1 - SLACK)
        for j, centroid in enumerate(self.centroids):
            at = np.flatnonzero((least[:, j] <= best) & (first != j))
            if not len(at):
                continue
            measured += len(at)
            d = squared(vectors[at], centroid)
            better = (d < best[at]) | ((d == best[at]) & (j < cluster[at]))
            best[at[better]], cluster[at[better]] = d[better], j
        return cluster, best, measured


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    value = F.col("embedding")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST // SCALE)
    whole = lambda x: F.floor(SCALE * x.cast("double")).cast("int")
    rows = vectors.where((F.size(value) == dimensions) & F.forall(value, sound))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(value, whole).alias("v"))


def _array(column: pa.Array, dtype, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _cached(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = distances(_array(batch.column("v"), np.int64, pivots.shape[1]), pivots)
            lists = pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), near.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "near"])
    return run


def _read(batches: Iterator[pa.RecordBatch], bounds: Bounds):
    for batch in batches:
        if batch.num_rows:
            vectors = _array(batch.column("v"), np.int64, bounds.centroids.shape[1])
            cluster, best, _ = bounds.assigned(vectors, _array(batch.column("near"), np.float64, len(bounds.pivots)))
            yield batch, vectors, cluster, best


def _sums(bounds: Bounds):
    """One row for each cluster that a task meets: vectors and component sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(bounds.centroids), dtype=np.int64)
        sums = np.zeros(bounds.centroids.shape, dtype=np.int64)
        for _, vectors, cluster, _ in _read(batches, bounds):
            for j in np.unique(cluster):
                of = vectors[cluster == j]
                count[j] += len(of)
                sums[j] += of.sum(axis=0)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(count[at]), pa.array([list(s) for s in sums[at]], pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])
    return run


def _labels(bounds: Bounds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, best in _read(batches, bounds):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])
    return run


def moved(held: DataFrame, bounds: Bounds) -> Bounds:
    """One round: every centroid that has vectors becomes their componentwise mean, rounded down."""
    parts = held.mapInArrow(_sums(bounds), "cluster int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(bounds.centroids.shape[1])]
    centroids = bounds.centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():  # a row a centroid
        centroids[r["cluster"]] = [int(s) // r["n"] for s in r[2:]]
    return Bounds(centroids, bounds.pivots)


def _by_cluster(values: list, kind: str) -> Column:
    return F.element_at(F.lit(values).cast(f"array<{kind}>"), F.col("cluster") + 1)


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector that takes part.

    vectors: vec_id, embedding. Those with ``dimensions`` components, none null or not finite, take part; so
    that distances fit a long, components must be below 131072 in size, other vectors are left out like broken ones.
    Component x counts as floor(1024 * x). Start centroids are the k vectors with the least sha256 of ``seed:vec_id``; rows
    without an id come last, rows with one id by their components. Fewer vectors than k start as many centroids.
    Repeated rows count as often as they are there. Centroids without vectors stay where they are. No rows: no rows.
    """
    spark, kept = vectors.sparkSession, integers(vectors, dimensions)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = kept.orderBy(mark.asc_nulls_last(), "v").limit(k).collect()
    result = "vec_id long, cluster int, distance long"
    if not start:
        extra = "cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"{result}, {extra}")
    pivots = np.array([r["v"] for r in start], dtype=np.int64)
    held = written(kept.mapInArrow(_cached(pivots), "vec_id long, v array<int>, near array<double>"), "vectors")
    bounds = Bounds(pivots, pivots)
    for _ in range(rounds):
        bounds = moved(held, bounds)
    labels = written(held.mapInArrow(_labels(bounds), result), "labels")
    inertia = [0] * len(pivots)
    for r in labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect():
        inertia[r["cluster"]] = int(r["s"])
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in bounds.centroids.tolist()]
    return labels.select(
        "vec_id", "cluster", "distance", _by_cluster(inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"), _by_cluster(digests, "string").alias("centroid_sha256"))


def op12_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
)""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k})
)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, c, d FROM (
    SELECT k.vec_id, k.v, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM kept k, c{r} c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, list(m ORDER BY pos) AS v FROM (
    SELECT c, pos, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r}) GROUP BY c, pos) GROUP BY c
  UNION ALL SELECT c, v FROM c{r} WHERE c NOT IN (SELECT c FROM a{r})
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT a.vec_id, a.c AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)
"""


SQL = _sql()
