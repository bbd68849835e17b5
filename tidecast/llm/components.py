"""Connected components of a link table, by large and small stars.

Each round links every node to the smallest node of its neighbourhood, first for larger
neighbours, then for smaller ones, until nothing changes; the number of rounds is about the
logarithm of the longest path. Rows never outnumber the links they started from by more than the
nodes, a star with a hot centre is reduced before its shuffle, and every round is written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """(u, v) with u > v. Every node sends its larger neighbours to the smallest of all."""
    both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u > v")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """(u, v) with u > v. Every node sends its smaller neighbours and itself to the smallest."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): every node with a link to another one, and the smallest node that it can
    reach. Links may repeat and point either way; nodes must not be null."""
    now = materialize(
        links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    before = _state(now)
    while before[0]:
        now = materialize(_small_star(_large_star(now)), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
