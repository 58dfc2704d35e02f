"""Joins to unique-key lookups that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def _join_salted(left: DataFrame, lookup: DataFrame, keys: list[str], how: str) -> DataFrame:
    return left.join(lookup, [*keys, "_salt"], how).drop("_salt")


def salted_lookup(
    left: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join to a lookup far smaller than ``left``.

    Every key is spread over ``salts`` tasks by a hash of the ``spread`` columns, and the
    lookup is repeated once per salt. A hash, unlike a random number, gives the same
    salt when a lost task is run again. Keys that already hold a time or another fine part
    need fewer salts, or a plain join.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return _join_salted(salted, copies, keys, how)


def hot_key_lookup(
    left: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    parts: int = 1000,
) -> DataFrame:
    """Join to a wide or large lookup, unique on ``keys``, repeating only its hot rows.

    A key is hot when it holds more than 1/``parts`` of the rows of ``left``, so fewer than
    ``parts`` keys can be hot and the table of them is safe to broadcast at any size of
    data. A hot key is split so that no piece exceeds that share. Costs one narrow,
    pre-aggregated pass over ``left``: meant for a table at rest.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    hot = (
        counts.withColumn("_total", total.scalar())
        .filter(F.col("_n") * parts > F.col("_total"))
        .select(*keys, F.ceil(F.col("_n") * parts / F.col("_total")).cast("int").alias("_ways"))
    )
    ways = F.coalesce(F.col("_ways"), F.lit(1))
    salted = (
        left.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), ways).cast("int"))
        .drop("_ways")
    )
    copies = (
        lookup.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), ways - 1)))
        .drop("_ways")
    )
    return _join_salted(salted, copies, keys, how)
