"""Connected components of a link table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stage


def _fingerprint(edges: DataFrame) -> tuple:
    """Order-free digest of an edge table: equal digests end the iteration."""
    h = F.xxhash64("a", "b")
    row = edges.agg(
        F.count(F.lit(1)),
        F.sum(F.shiftrightunsigned(h, 32)),
        F.sum(h.bitwiseAND(0xFFFFFFFF)),
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node that links reach, itself for the smallest; nodes
    without a link to another node do not appear. Links are undirected; self links, nulls and repeats are ignored.

    Alternates two contractions until the edge table no longer changes: every larger neighbour of a node
    is moved to the smallest node of its neighbourhood, then every smaller one. Each is one aggregation
    with map-side combine and one join on the node, so a hub's rows never meet in one task unsplit.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(),
        "links",
    )
    seen = _fingerprint(edges)
    if not seen[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("least_b"))
        low = low.select("hub", F.least("hub", "least_b").alias("low"))
        large = both.join(low, both.a == low.hub).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        down = large.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low"))
        small = large.join(down, large.a == down.hub)
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").unionByName(down.select(F.col("hub").alias("a"), F.col("low").alias("b")))
        edges = stage(small.distinct(), "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = edges.unionByName(edges.select(F.col("b").alias("a"), "b"))
    return stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
