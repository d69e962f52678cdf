"""Connected components of a graph of links, by star contraction in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.sources.scratch import save, save_counted


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node reachable from each linked node: columns ``node`` and ``root``, roots themselves left out.

    Links are rewritten until every node points at its root. In turn, each node hands its larger neighbours and then
    its smaller ones to the smallest it knows, so chains shorten by a constant factor in each round. Every step is an
    aggregate of minima, combined before the shuffle, and a join; a node with many neighbours is never gathered.
    Null ends and links of a node to itself are left out.
    """
    stars, digest = _digested(
        links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("node") != F.col("root"))).distinct()
    )
    if digest[0] == 0:
        return stars
    while True:
        both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("_least"))
        least = least.withColumn("_least", F.least("node", "_least"))
        large = (
            both.filter(F.col("root") > F.col("node")).join(least, "node")
            .select(F.col("root").alias("node"), F.col("_least").alias("root")).distinct()
        )
        large = save(large, "stars")
        least = large.groupBy("node").agg(F.min("root").alias("_least"))
        small = (
            large.join(least, "node").filter(F.col("root") != F.col("_least"))
            .select(F.col("root").alias("node"), F.col("_least").alias("root"))
        )
        stars, now = _digested(small.unionByName(least.withColumnRenamed("_least", "root")).distinct())
        if now == digest:
            return stars
        digest = now


def _digested(stars: DataFrame) -> tuple[DataFrame, tuple]:
    """The written links with their number and an order-free sum of hashes, to see whether a round changed them."""
    saved, count = save_counted(stars, "stars")
    total = saved.agg(F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()[0]
    return saved, (count, total)
