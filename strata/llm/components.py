"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the smallest one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; ``component`` is the smallest node reachable.

    ``links`` holds pairs (a, b) of longs in any order and number. The number
    of rounds grows with the logarithm of the longest path; each round is
    written to the shared folder.
    """

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = staged(clean(links), "links")
    before = mark(links)
    while before[0]:
        links = staged(clean(_small_star(clean(_large_star(links)))), "links")
        now = mark(links)
        if now == before:
            break
        before = now
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return nodes.unionByName(roots)
