"""Connected components of a link table by alternating star contraction.

Each round is two aggregations and joins; the link table is written to the
shared folder after each, and the one before is removed. Nothing of it reaches
the driver but three numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a > b)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .distinct())
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node that is not the smallest of its component; root: that smallest."""
    now = written(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct(),
                  "links")
    seen = _digest(now)
    while seen[0]:
        after = written(_stars(now), "links")
        removed(now)
        now, before, seen = after, seen, _digest(after)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
