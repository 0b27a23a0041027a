"""Connected components of a link table by alternating star contraction.

``large star`` hangs every larger neighbour of a node on the smallest one in
its neighbourhood, ``small star`` does the same for the smaller neighbours;
the links shrink to stars in a logarithmic number of rounds.  Links never
leave the executors: each round is two grouped joins on stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, store


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(joined.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the component's least node."""
    links = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = mark(links)
    while True:
        after_links = store(_small_star(_large_star(links)), "links")
        drop(links)
        links, after = after_links, mark(after_links)
        if after == before:
            break
        before = after
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
