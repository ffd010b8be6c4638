from __future__ import annotations

import random

from watchpost.llm.graph import components


def found(spark, edges):
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return {r["node"]: r["component"] for r in rows}


def test_chain_star_and_loop(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 230)]
    assert found(spark, [*chain, *star, (500, 500)]) == {
        **{i: 100 for i in range(100, 141)},
        **{i: 7 for i in [7, *range(200, 230)]},
    }


def test_random_graph(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    parent = list(range(300))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    nodes = {x for u, v in edges if u != v for x in (u, v)}
    least = {}
    for x in sorted(nodes):
        least.setdefault(root(x), x)
    assert found(spark, edges) == {x: least[root(x)] for x in nodes}


def test_empty(spark):
    assert found(spark, []) == {}
