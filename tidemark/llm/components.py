"""Connected components of a graph held in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them. Edges run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has an edge; the root is the least node of its component.

    ``edges`` has two long columns; direction, repeats and loops do not matter. A round is two joins on the
    node, each with combined minima, so a node with very many edges is split by the adaptive skew join. The
    edges of a round are written to the shared folder; the rounds end when a round changes nothing (their
    number grows with the logarithm of the longest path). No edges give no rows.
    """
    a, b = edges.columns
    now = edges.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = stored(now, "edges")
    mark = _mark(now)
    while True:
        now = stored(_small_star(_large_star(now)).distinct(), "edges")
        mark, before = _mark(now), mark
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
