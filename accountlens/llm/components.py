"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.session import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: link every larger neighbour of a node to the least of the node and its neighbours.
    Small: link the node and its smaller neighbours to the least of them."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.unionByName(turned) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        linked = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return linked.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns node and root (the least node reachable) for every node of the edges (a, b), longs; a = b is ignored.

    The least neighbour is found by a partial aggregation, joins are skew-split by Spark, and each round is
    checkpointed in the shared folder, so neither a hub nor a lost executor restarts the work.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct())
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        edges = materialize(_star(_star(edges, large=True), large=False))
        state = _state(edges)
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
