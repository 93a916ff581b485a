"""Operator 13: k-means with the equal-average equal-variance nearest neighbour search.

Vectors are integers, and all that decides is integer arithmetic. Centroids are sorted by
their sums (means times the dimension). For a vector the search starts at its own sum and
goes outward on both sides. With sums s, dimension k and deviations r (the root of
k times the sum of squares, less the squared sum), k times a squared distance is at least
(s - s')^2 + (r - r')^2. Once the first part alone exceeds the best, everything
further out is rejected, and a single centroid is if both together do. Deviations are
floating-point and compared with a margin, so they reject only what is certain; the
distances of the rest are computed exactly, and ties go to the smaller number.

A round reads the staged vectors once; a task sums its vectors by centroid, so as many
rows as there are centroids leave it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import lean, staged

DIMENSION, CLUSTERS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
#: Largest component: four times its square, times the squared dimension, still is a 64-bit integer.
LIMIT = 1 << 24
#: Deviations are below 2^31 and their roots exact to some 2^-22.
MARGIN = 1e-6


class Centroids:
    """Centroids sorted by their sums, for searches."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.sums = vectors.sum(axis=1)
        self.order = np.argsort(self.sums, kind="stable")
        self.sorted = self.sums[self.order]
        self.spread = deviations(vectors, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each vector, its squared distance, and how many distances were computed."""
        k, n = vectors.shape[1], len(vectors)
        sums = vectors.sum(axis=1)
        spread = deviations(vectors, sums)
        best, cluster = np.full(n, (1 << 62) // k), np.full(n, len(self.order), np.int64)
        right = np.searchsorted(self.sorted, sums)
        left = right - 1
        live, computed = np.arange(n), 0
        far = np.int64(1) << 32
        while len(live):
            at, to = left[live], right[live]
            below = np.where(at >= 0, sums[live] - self.sorted[np.maximum(at, 0)], far)
            above = np.where(to < len(self.sorted), self.sorted[np.minimum(to, len(self.sorted) - 1)] - sums[live], far)
            gap, down = np.minimum(below, above), below <= above
            go = gap < far
            go[go] = gap[go] ** 2 <= k * best[live[go]]
            live, gap, down, at, to = live[go], gap[go], down[go], at[go], to[go]
            other = self.order[np.where(down, at, to)]
            left[live] -= down
            right[live] += ~down
            apart = np.maximum(np.abs(spread[live] - self.spread[other]) - MARGIN, 0)
            near = gap.astype(float) ** 2 + apart**2 * (1 - 1e-12) <= (k * best[live]).astype(float) * (1 + 1e-12) + 1
            row, other = live[near], other[near]
            distance = ((vectors[row] - self.vectors[other]) ** 2).sum(axis=1)
            computed += len(row)
            better = (distance < best[row]) | ((distance == best[row]) & (other < cluster[row]))
            best[row[better]], cluster[row[better]] = distance[better], other[better]
        return cluster, best, computed


def deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Root of the dimension times the squared deviations from the mean, of each vector."""
    return np.sqrt((vectors.shape[1] * (vectors**2).sum(axis=1) - sums**2).astype(float))


def rows_of(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def integers(vectors: DataFrame, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the vectors with ``dimension`` components, none null or non-finite, as floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter((F.size("embedding") == dimension) & finite)
    fits = F.forall(x, lambda c: F.abs(c) <= LIMIT / scale)
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component beyond {LIMIT // scale}: squared distances would leave 64 bits")).cast("array<long>"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), checked.alias("vector"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hash of seed and vec_id; those without vec_id come last, equal ids by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(name.alias("name"), "vector").orderBy(F.asc_nulls_last("name"), "vector").limit(clusters).collect()  # as many as centroids
    return np.array([r.vector for r in rows], np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as the floors of their vectors' means; one without vectors stays."""
    shared, k = kept.sparkSession.sparkContext.broadcast(Centroids(centroids)), centroids.shape[1]
    names = [f"s{j}" for j in range(k)]

    @lean
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        n, total = np.zeros(len(centroids.order), np.int64), np.zeros(centroids.vectors.shape, np.int64)
        for batch in batches:
            vectors = rows_of(batch.column("vector"), k)
            cluster = centroids.nearest(vectors)[0]
            order = np.argsort(cluster, kind="stable")
            own, heads, counts = np.unique(cluster[order], return_index=True, return_counts=True)
            n[own] += counts
            if len(own):
                total[own] += np.add.reduceat(vectors[order], heads, axis=0)
        some = np.flatnonzero(n)
        columns = [some, n[some], *total[some].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], ["cluster", "n", *names])

    schema = ", ".join(f"{c} long" for c in ["cluster", "n", *names])
    wide = kept.select("vector").mapInArrow(sums, schema).groupBy("cluster").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *names]])
    out = centroids.copy()
    for row in wide.collect():  # as many as centroids
        out[row.cluster] = [int(row[c]) // int(row.n) for c in names]
    return out


def cluster(vectors: DataFrame, dimension: int = DIMENSION, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that is kept.

    ``vectors`` has vec_id and embedding; other columns are ignored. Vectors with another
    number of components, or null or non-finite ones, are left out, and without any vector
    the result is empty. Repeated rows are vectors of their own, also without vec_id; with fewer vectors
    than clusters there are fewer clusters. Equal distances go to the smaller number.
    Components whose integers exceed 2^24 stop the job with a message, since distances
    would no longer be 64-bit integers. Inertias are summed in decimals.
    """
    kept = staged(integers(vectors, dimension, scale), "integers")
    centroids = first_centroids(kept, clusters, seed).reshape(-1, dimension)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(kept, centroids)
    shared = kept.sparkSession.sparkContext.broadcast(Centroids(centroids))

    @lean
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, distance, _ = shared.value.nearest(rows_of(batch.column("vector"), dimension))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    assigned = staged(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # as many as centroids
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(k, int(n), int(sum(sums.values())), names[k]) for k, n in sorted(sums.items())]
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("cluster_inertia", "inertia")), T.StructField("centroid_sha256", T.StringType())])
    facts = kept.sparkSession.createDataFrame(rows, schema)
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
