"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import pinned

MAX_ROUNDS = 60


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select("hi", "lo").unionByName(
        pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))
    )


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("hi").agg(F.min("lo").alias("least"))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = _both(pairs)
    least = _least(both).select("hi", F.least("least", "hi").alias("least"))
    larger = both.where("lo > hi").join(least, "hi")
    return larger.select(F.col("lo").alias("hi"), F.col("least").alias("lo"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = _least(pairs)
    moved = pairs.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    own = least.select("hi", F.col("least").alias("lo"))
    return moved.unionByName(own).where("hi != lo").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in a pair of (a, b) longs; root is the least node.

    Large-star and small-star steps alternate until the pairs no longer change; then every node
    points to its root. Each round is stored in the shared folder: the lineage stays short and a
    lost executor costs one round at most. A hub keeps one row per neighbour and never a list, and
    its joins are plain ones that adaptive execution may split. Pairs with a null side or equal
    sides are ignored; an empty table gives an empty result.
    """
    sides = pairs.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    current = pinned(sides.where("hi != lo").distinct(), "pairs")
    seen = _digest(current)
    if seen[0]:
        for _ in range(MAX_ROUNDS):
            current = pinned(_small_star(_large_star(current)), "stars")
            now = _digest(current)
            if now == seen:
                break
            seen = now
        else:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return members.unionByName(roots)


def _digest(pairs: DataFrame) -> tuple:
    mix = F.xxhash64("hi", "lo")
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(mix).alias("x"),
        F.sum(mix.cast("decimal(20,0)")).alias("s"),
    ).first()
    return row.n, row.x, row.s
