"""Connected components by minimum labels, on edges that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, saved


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two sums of their hashes: the same for equal sets of edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit((1 << 31) - 1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of every node of the rows (a, b) of ``edges``.

    Each round joins every node with the least neighbour of its neighbours (large star, then small star), which
    halves the depth; a star of any size is one aggregate, so a hot node is combined before the shuffle. Only the last
    round's table is kept.
    """
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        new = saved(small.where("a <> b").distinct(), edges)
        now = _state(new)
        if now == state:
            out = saved(new.select(F.col("a").alias("node"), F.col("b").alias("root")).union(new.select("b", "b").distinct()))
            discard(new)
            return out
        edges, state = new, now
