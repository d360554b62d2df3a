"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sightlog.llm.common import stored


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node.

    Alternates between linking each node's larger and smaller neighbours to its least one until
    nothing changes; the number of rounds grows with the logarithm of the longest path.  Least
    neighbours are aggregates and are joined back, so a node with any number of neighbours is
    never gathered.  Each round is written, so a lost executor costs one round.
    """
    now = edges.where("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    ).distinct()
    before, rounds = None, 0
    while True:
        now = stored(_to_least(_larger(now)), folder, f"round-{rounds}")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            return now
        before, rounds = tuple(mark), rounds + 1


def _larger(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the least of the node and its neighbours."""
    both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).union(
        edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("node"), F.least("m", "u").alias("root"))
        .distinct()
    )


def _to_least(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the least of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("m"))
    moved = edges.join(least, "node").where("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root"))
    return moved.union(least.select("node", F.col("m").alias("root"))).distinct()
