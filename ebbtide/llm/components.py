"""Connected components by large-star and small-star rounds over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import settle


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Re-link neighbours of every node to the smallest of them and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.where("a <> m").select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b): every linked node that isn't the smallest of its component, with that smallest node.

    ``links`` holds the two ends in columns a and b, in any order; loops and repeats
    do no harm. Every round is settled as Parquet, so a lost executor costs one round.
    """
    links = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while True:
        new = settle(_star(settle(_star(links, True)), False))
        # A forest of stars is stable: nobody's parent has a parent, nobody has two.
        deep = new.join(new.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        if not deep and not new.groupBy("a").count().where("count > 1").limit(1).count():
            return new
        links = new
