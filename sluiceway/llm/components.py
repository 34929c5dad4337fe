"""Connected components of an edge table, by rounds of joins over settled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import settle

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); the root is the smallest node reached.

    Large-star and small-star rounds: neighbours move to the smallest node near them until every
    node hangs on its root, which takes a number of rounds that grows with the logarithm of the
    longest chain. Minima are combined before they are shuffled and settled, so that both sides of
    the joins have an exchange of their own and Spark may split a node with very many edges. Each round
    is written to the shared folder. Edges from a node to itself are allowed.
    """
    now = settle(_ordered(edges), "component-edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        now = settle(_small_star(_large_star(now)), "component-edges")
        # Equal sums of hashes over distinct edges: nothing has moved.
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    low = settle(low.select(F.col("a").alias("at"), F.least("a", "low").alias("low")), "component-lows")
    # Edges run from large to small, so the larger neighbours of b are its a.
    return edges.join(low, F.col("b") == F.col("at")).select("a", F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and it itself, move to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    low = settle(low.select(F.col("a").alias("at"), "low"), "component-lows")
    moved = edges.join(low, F.col("a") == F.col("at"))
    own = low.select(F.col("at").alias("a"), F.col("low").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").unionByName(own).distinct()
