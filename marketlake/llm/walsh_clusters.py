"""Centroid clustering (operator 11) by progressive search over Walsh-Hadamard coefficients.

Vectors are rounded down to integers (SCALE * x), so everything is exact. The transform
keeps squared distances, but for a factor of the dimension, and gathers much of them
in its first coefficients. A search adds squared coefficient differences
coarse to fine, STAGES at a time. A partial sum never exceeds the whole: the whole
distance of the centroid that leads after the first stage bounds the best, and
centroids whose partial sum is strictly above it go. What stays is summed over all
coefficients; the least distance wins, ties go to the smaller number.

Each round is one pass of tasks over the vectors. A task returns one row of sums per
centroid, so what is shuffled and what the driver reads (the centroids) does not grow with the vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.embeddings import all_finite, hadamard, matrix
from marketlake.llm.text import by_batch, fresh, written

SCALE = 256
STAGES = (8, 16, 32)  # coefficients after which centroids go; then all
SAFE = 1 << 24  # 64-bit integers hold all sums for components up to here; beyond, Python's integers do
FITS = 1 << 27  # a distance between components up to here fits a 64-bit integer
BATCH = 4096  # vectors searched at once


def integers(vector: str, dimension: int):
    """floor(SCALE * x) of every component as array<bigint>; null unless the vector is to be clustered."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    fits = all_finite(vector) & (F.size(vector) == dimension) & F.forall(vector, lambda x: F.abs(x.cast("double") * SCALE) < FITS)
    return F.when(fits, whole)


class Search:
    """Nearest centroids, exactly."""

    def __init__(self, centroids: np.ndarray):
        self.dimension = centroids.shape[1]
        self.kind = np.int64 if not centroids.size or np.abs(centroids).max() <= SAFE else object
        self.centroids = centroids

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the number of the nearest centroid (ties: the smaller) and the squared distance."""
        kind = object if self.kind is object or (vectors.size and np.abs(vectors).max() > SAFE) else np.int64
        found = [self._search(hadamard(vectors[i : i + BATCH].astype(kind)), hadamard(self.centroids.astype(kind)), kind) for i in range(0, len(vectors), BATCH)]
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([c for c, _ in found]).astype(np.int32), np.concatenate([d // self.dimension for _, d in found]).astype(np.int64)

    def _search(self, x: np.ndarray, c: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
        def added(row: np.ndarray, number: np.ndarray, begin: int, end: int) -> np.ndarray:
            return ((x[row, begin:end] - c[number, begin:end]) ** 2).sum(axis=1)

        count, edges = len(x), [0, *[s for s in STAGES if s < self.dimension], self.dimension]
        partial = np.zeros((count, len(c)), kind)
        for k in range(edges[1]):
            partial += (x[:, k, None] - c[None, :, k]) ** 2
        lead = partial.argmin(axis=1).astype(np.int64)
        each = np.arange(count)
        bound = partial[each, lead] + added(each, lead, edges[1], self.dimension)
        row, number = np.nonzero((partial <= bound[:, None]).astype(bool))
        total = partial[row, number]
        for begin, end in zip(edges[1:], edges[2:]):
            total = total + added(row, number, begin, end)
            alive = (total <= bound[row]).astype(bool)  # strictly worse ones go
            row, number, total = row[alive], number[alive], total[alive]
        # Rows ascend and numbers within a row; the first of a row's least sums is the smaller number.
        begin = np.searchsorted(row, each)
        least = np.minimum.reduceat(total, begin)
        hit = np.flatnonzero((total == least[row]).astype(bool))
        first = hit[np.unique(row[hit], return_index=True)[1]]
        return number[first], total[first]


def _sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, n, s0, s1, ...: the vectors' count and componentwise sums, by centroid."""
    k, dimension = centroids.shape
    names = [f"s{j}" for j in range(dimension)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, n, total = Search(centroids), np.zeros(k, np.int64), np.zeros((k, dimension), np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), dimension)
            cluster, _ = search.nearest(rows)
            n += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, rows)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), *[pa.array(total[some, j]) for j in range(dimension)]], ["cluster", "n", *names])

    parts = vectors.select("ints").mapInArrow(gather, "cluster int, n bigint, " + ", ".join(f"{s} bigint" for s in names))
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])  # longs hold the sums of 2^36 vectors


def fit_centroids(vectors: DataFrame, clusters: int, rounds: int, seed: int, dimension: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds over ``vectors`` (id, ints); fewer rows than ``clusters`` give as many as there are."""
    first = vectors.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "ints").limit(clusters)
    start = [r.ints for r in first.select("ints").collect()]
    centroids = np.array(start, np.int64).reshape(len(start), dimension)
    for _ in range(rounds if start else 0):
        for r in _sums(vectors, centroids).collect():  # one row per centroid
            centroids[r.cluster] = [int(s) // r.n for s in r[2:]]
    return centroids


def cluster(vectors: DataFrame, clusters: int = 40, rounds: int = 5, seed: int = 2, dimension: int = 64, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster (int), distance, cluster_inertia, inertia (long), centroid_sha256 (string).

    Kept are vectors of ``dimension`` components (a power of two) without nulls, NaN and infinities, whose integers
    are below 2^27, so that a distance fits a long. First centroids are the ``clusters`` vectors of
    the smallest SHA-256 of ``seed:vec_id``; rows of one id are told apart by their
    components, a null id comes last. Each round assigns every vector to its nearest
    centroid (ties: the smaller number) and moves it to the floored mean; an empty centroid
    stays. Repeated rows count each for itself. Fewer vectors than ``clusters``
    give that many clusters; an empty table an empty one. Other columns are not read. An inertia
    that does not fit a long is null.
    """
    kept = vectors.select(F.col(vec_id).alias("id"), integers(vector, dimension).alias("ints")).where("ints is not null")
    centroids = fit_centroids(kept, clusters, rounds, seed, dimension)
    if not len(centroids):
        centroids = np.zeros((1, dimension), np.int64)  # no vector will ask for it

    def make():
        search = Search(centroids)

        def each(batch: pa.Array) -> pa.Array:
            number, distance = search.nearest(matrix(batch, dimension))
            return pa.StructArray.from_arrays([pa.array(number), pa.array(distance)], ["cluster", "distance"])

        return each

    assign = F.arrow_udf(by_batch(make), "struct<cluster:int,distance:bigint>", F.ArrowUDFType.SCALAR_ITER)
    found = fresh("found")
    placed = written(kept.select(F.col("id").alias("vec_id"), assign("ints").alias(found)).select("vec_id", f"{found}.*"))
    own = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = {r.cluster: int(r["sum"]) for r in own.collect()}  # one row per centroid
    fits = lambda x: x if x < 1 << 63 else None
    rows = [(i, fits(sums.get(i, 0)), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    per_cluster = placed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # one row per centroid
