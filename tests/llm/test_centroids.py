"""Centroid clustering against a plain brute force in whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from watchpost.llm.centroids import Bisectors, cluster_vectors, with_inertia

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=8, rounds=10, dimensions=64):
    """``[(id, cluster, distance)]`` and centroids, from the contract word for word."""
    kept = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    by_hash = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=by_hash)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for c, vs in zip(centroids, own)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def vectors(n, seed, dimensions=64):
    draw = random.Random(seed)
    centres = [[draw.uniform(-0.3, 0.3) for _ in range(dimensions)] for _ in range(5)]
    rows = [[float(np.float32(x + draw.gauss(0, 0.1))) for x in draw.choice(centres)] for _ in range(n)]
    return [(i, v) for i, v in enumerate(rows)]


def check(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found, centroids = cluster_vectors(table, **options)
    expected, expected_centroids = brute(rows, **options)
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    assert centroids.tolist() == expected_centroids
    return found


def test_clusters_and_sums(spark):
    rows = vectors(300, 1)
    found = with_inertia(check(spark, rows)).collect()
    sums = {}
    for r in found:
        sums[r.cluster] = sums.get(r.cluster, 0) + r.distance
    assert all(r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values()) for r in found)


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_any_number_of_centroids(spark, k):
    check(spark, vectors(60, k, dimensions=3), k=k, rounds=3, dimensions=3)


def test_a_third_of_all_rows_is_one_vector(spark):
    rows = vectors(120, 2)
    check(spark, rows + [(1000 + i, rows[0][1]) for i in range(60)])


def test_vectors_that_are_not_kept(spark):
    rows = vectors(30, 3)
    v = rows[0][1]
    odd = [(90, None), (91, []), (92, v[:63]), (93, [*v, 0.5]), (94, [None, *v[1:]]), (95, [math.nan, *v[1:]]),
           (96, [math.inf, *v[1:]]), (97, [-math.inf, *v[1:]])]
    check(spark, rows + odd)


def test_repeated_rows_and_null_ids(spark):
    rows = vectors(20, 4)
    check(spark, rows + rows[:7] + [(None, rows[3][1]), (None, rows[5][1])])
    check(spark, [(None, v) for _, v in rows[:3]] + rows[:2])


def test_fewer_vectors_than_centroids_and_none(spark):
    check(spark, vectors(3, 5))
    empty, centroids = cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and len(centroids) == 0
    assert with_inertia(empty).collect() == []


def test_other_columns_do_not_clash(spark):
    rows = vectors(20, 6)
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows],
                                  "vec_id long, embedding array<float>, cluster int, distance int, vector string")
    found, _ = cluster_vectors(table)
    assert found.columns == ["vec_id", "cluster", "distance"]
    assert sorted(map(tuple, found.collect())) == brute(rows)[0]


def test_ties_on_the_bisector_go_to_the_smaller_number():
    centroids = np.array([[0, 0], [2, 0], [0, 2], [2, 2], [0, 0]], np.int64)
    grid = np.array([[x, y] for x in range(-1, 4) for y in range(-1, 4)], np.int64)
    numbers = Bisectors.of(centroids).nearest(grid)
    for v, c in zip(grid, numbers):
        distances = [int(((v - x) ** 2).sum()) for x in centroids]
        assert c == distances.index(min(distances))


def test_components_beyond_the_bound_are_refused(spark):
    table = spark.createDataFrame([(1, [1e9] * 64, 0)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        cluster_vectors(table)
