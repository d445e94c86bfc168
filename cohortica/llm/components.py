"""Connected components by alternating stars; every step is a join or a grouped minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortica.llm.shared import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them. Edges come with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(least, "a")
    return (joined.select("a", F.col("low").alias("b"))
            .union(joined.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (two columns of one orderable type); root is the smallest node
    of its component.

    Self-links and NULL ends are ignored; repeated links count once. No edges: no rows. A hub's links are
    spread by Spark's skew join, as only its minimum is gathered. Each round is checkpointed, and the number
    of rounds grows with the logarithm of the longest chain.
    """
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = checkpoint(links.distinct())
    state = _state(links)
    while state[0]:
        links = checkpoint(_small_star(_large_star(links)))
        after = _state(links)
        if after == state:
            break
        state = after
    # every link is now (node, root)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
