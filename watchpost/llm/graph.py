"""Connected components of an undirected graph by alternating stars (Kiveris et al., 2014).

Every step is a minimum per node, with map-side combine, and a join of the edges with it; a
node with very many edges is a skewed join key, which Spark splits.  Each round is
checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.llm.storage import checkpointed


def _star(edges: DataFrame, from_larger: bool) -> DataFrame:
    """Tie neighbours of each node ``u`` to the smallest of them and ``u``.

    The large star moves neighbours above ``u``; the small star those below, with ``u``.
    """
    if not from_larger:
        arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        arcs = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = arcs.join(least, "u")
    if from_larger:
        moved = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component: its smallest node."""
    edges = checkpointed(edges.select("u", "v").where("u <> v").distinct())
    state = None
    while True:
        edges = checkpointed(_star(_star(edges, True), False))
        # Stable when every node hangs on a root: a bit-wise sum over all edges tells changes.
        new = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
