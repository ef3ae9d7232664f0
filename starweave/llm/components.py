"""Connected components of an edge table by alternating star contraction, all in joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    pulled = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pulled.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), root being the smallest node that its links reach.

    Each round writes its edges to the shared checkpoint folder, so lost executors cost one round at most. The
    smallest neighbour is aggregated map-side and the joins are plain equi-joins, whose hot nodes AQE splits.
    Loops, repeated and reversed edges are allowed; null ends are dropped. No edges give no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a is not null and b is not null and a <> b").distinct()
    e, before = materialize(e, "edges"), None
    for _ in range(max_rounds):
        e = materialize(_small_star(_large_star(e).distinct()).distinct(), "edges")
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
