"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut


#: Links for each file of a round, about: rounds shrink, and so do the files that they write.
ROWS = 1 << 18


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node it knows of."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours, and itself, on the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link; links: (u, v) of
    longs, in either direction, repeats and loops allowed. Nulls must not occur; without rows the
    result is empty.

    Alternating large and small stars: the rounds grow with the logarithm of the longest path, and
    a round moves one row per link. Each round is checkpointed, so a lost executor costs that round's
    tasks alone. No link reaches the driver, only a count and a checksum."""
    links = cut(links.select("u", "v").where("u <> v").distinct())
    before = _signature(links)
    while before[0]:
        links = cut(_small_star(_large_star(links)).coalesce(1 + 2 * before[0] // ROWS))
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
