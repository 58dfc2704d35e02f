"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, directed: DataFrame) -> DataFrame:
    """Every row (a, b) of ``directed`` becomes (b, smallest of a and its neighbours in it)."""
    least = directed.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = edges.join(least, "a")
    return moved.select(F.col("b").alias("u"), "m").unionAll(least.select(F.col("a").alias("u"), "m"))


def _tidy(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> m").select(F.greatest("u", "m").alias("a"), F.least("u", "m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every id in ``links`` (a, b); a component is named by its smallest id.

    Each round ties every id to the smallest one near it, first among all neighbours of larger ids, then
    among its smaller neighbours; rounds grow with the logarithm of the longest chain. Minima are
    taken before the shuffle and joins split hot ids. Null ends and loops are passed over.
    """
    edges = stage(_tidy(links.where("a IS NOT NULL AND b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("m"))), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        both = _both(edges)
        large = _tidy(_star(both.where("b > a"), both))
        # edges now run from a larger id to a smaller one
        edges = stage(_tidy(_star(large, large)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
