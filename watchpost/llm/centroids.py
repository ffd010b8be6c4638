"""Clusters of vectors around integer centroids, nearest centroids found by a bisector tournament.

Vectors become integers, ``floor(scale * x)``, so that every sum and distance is exact and no
result depends on partitions or on the order of addition.  Between two centroids ``a < b`` lies a
bisector with the integer normal ``2 (b - a)`` and the threshold ``|b|^2 - |a|^2``: a vector whose
product with the normal is above the threshold is nearer to ``b``, one on the bisector belongs to
the smaller number.  Normals and thresholds of all pairs are computed once a round; then k - 1 sign
tests, as a knock-out tournament, leave the nearest centroid of a vector, and only its distance is
worked out.

The kept vectors are written once, as integers, to the shared folder.  A round is one scan of that
table without a shuffle of vectors: each task adds up its vectors per centroid and emits at most
k rows, which Spark adds up again.  A centroid with a third of all vectors is no different.  What
goes to the driver is k x dimensions sums, and centroids go back within the function: both sizes
are parameters, not data.

Kept are vectors with exactly ``dimensions`` components, none null or non-finite.  Edge cases: a
null vector isn't kept; rows that repeat an id or a vector count each; a null id is kept, but
starts a centroid only after all others; equal hashes are ordered by the vector; fewer kept vectors
than centroids give as many centroids; an empty table gives an empty result; other columns are not
read, so that their names can't clash.  A component beyond ``LARGEST`` after scaling raises an
ArithmeticError, since distances might not fit 64 bits; sums of distances beyond 64 bits fail in
Spark's cast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.llm.batches import list_array
from watchpost.llm.storage import written

CENTROIDS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
BLOCK = 4096  # vectors worked on at once
LARGEST = 1 << 27  # with it, 64 squared differences stay below 2^62


@dataclass
class Bisectors:
    """Centroids as rows of int64, and what separates each pair of them."""

    centroids: np.ndarray
    normals: np.ndarray  # [a, b]: points from a to b
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        lengths = (centroids * centroids).sum(axis=1)
        return cls(centroids, normals, lengths[None, :] - lengths[:, None])

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid for each row; ties go to the smaller number.

        Neighbours meet, and winners stay in order, so that in every test all numbers that stand on
        the left are smaller than those on the right.
        """
        players = [np.full(len(vectors), c) for c in range(len(self.centroids))]
        while len(players) > 1:
            winners = []
            for left, right in zip(players[::2], players[1::2]):
                along = np.einsum("ij,ij->i", vectors, self.normals[left, right])
                winners.append(np.where(along > self.thresholds[left, right], right, left))
            players = winners + players[2 * len(winners) :]
        return players[0]

    def distance(self, vectors: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        apart = vectors - self.centroids[numbers]
        return np.einsum("ij,ij->i", apart, apart)


def _blocks(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and matrix of each block of vectors."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    vectors = values.reshape(-1, dimensions).astype(np.int64)
    for begin in range(0, len(vectors), BLOCK):
        yield begin, vectors[begin : begin + BLOCK]


def whole_vectors(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """``(id, vector)`` of the kept rows, components as integers."""
    largest = LARGEST

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            scaled = np.floor(scale * values)
            if len(scaled) and np.abs(scaled).max() > largest:
                raise ArithmeticError(f"a component of a vector is beyond {largest} after scaling")
            counts = np.full(batch.num_rows, dimensions)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), list_array(scaled.astype(np.int32), counts)], ["id", "vector"]
            )

    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    kept = df.select(F.col(id_col).alias("id"), vector.alias("vector")).where(
        (F.size("vector") == dimensions) & finite
    )
    id_type = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(convert, f"id {id_type}, vector array<int>")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; Spark keeps k rows of each task."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(hashed.alias("hash"), "vector").orderBy(F.asc_nulls_last("hash"), "vector").limit(k)
    return np.array([row.vector for row in rows.collect()], np.int64)


def _sums(vectors: DataFrame, bisectors: Bisectors) -> list:
    """``(cluster, n, totals)`` for each centroid that has vectors."""
    k, dimensions = bisectors.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            for _, block in _blocks(batch, dimensions):
                numbers = bisectors.nearest(block)
                for c in range(k):
                    own = block[numbers == c]
                    counts[c] += len(own)
                    totals[c] += own.sum(axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, dimensions).astype(np.int32)),
                pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(used))),
                pa.array(np.repeat(counts[used], dimensions)),
                pa.array(totals[used].ravel()),
            ],
            ["cluster", "component", "n", "total"],
        )

    partial = vectors.select("vector").mapInArrow(add, "cluster int, component int, n long, total long")
    summed = partial.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return summed.collect()  # k x dimensions rows


def moved(centroids: np.ndarray, vectors: DataFrame) -> np.ndarray:
    """Each centroid at the floored mean of its vectors; one without vectors stays."""
    new = centroids.copy()
    for cluster, component, n, total in _sums(vectors, Bisectors.of(centroids)):
        new[cluster, component] = total // n
    return new


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)``: the nearest centroid and the squared distance to it."""
    bisectors = Bisectors.of(centroids)
    dimensions = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, block in _blocks(batch, dimensions):
                numbers = bisectors.nearest(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begin, len(block)),
                        pa.array(numbers.astype(np.int32)),
                        pa.array(bisectors.distance(block, numbers)),
                    ],
                    ["id", "cluster", "distance"],
                )

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"id {id_type}, cluster int, distance long")


def cluster_vectors(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """``(id_col, cluster, distance)`` of every kept vector, and the final centroids."""
    whole = whole_vectors(df, id_col=id_col, vector_col=vector_col, dimensions=dimensions, scale=scale)
    vectors = written(whole, "centroid-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        nothing = vectors.select(
            F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")
        )
        return nothing, np.zeros((0, dimensions), np.int64)
    for _ in range(rounds):
        before, centroids = centroids, moved(centroids, vectors)
        if (before == centroids).all():  # later rounds would change nothing
            break
    return assigned(vectors, centroids).withColumnRenamed("id", id_col), centroids


def with_inertia(clusters: DataFrame) -> DataFrame:
    """Adds the sums of distances of the cluster and of all; k rows meet the vectors."""
    clusters = written(clusters, "centroid-clusters")
    sums = clusters.groupBy(F.col("cluster").alias("__cluster")).agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("__sum")
    )
    rows = sums.collect()  # one for each centroid
    whole = sum(row[1] for row in rows)
    if whole >= 1 << 63:
        raise ArithmeticError("the sum of distances doesn't fit 64 bits")
    table = clusters.sparkSession.createDataFrame(
        [(c, int(own)) for c, own in rows], "__cluster int, cluster_inertia long"
    )
    return (
        clusters.join(F.broadcast(table), F.col("cluster") == F.col("__cluster"))
        .drop("__cluster")
        .withColumn("inertia", F.lit(int(whole)).cast("long"))
    )
