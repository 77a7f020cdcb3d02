"""Connected components of an edge table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, table

SPLIT = 1_000_000


def connected_components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long), component being the smallest node it reaches.

    Every round is a few equi-joins on a node with its smallest neighbour; no list of neighbours is ever gathered. Beyond
    SPLIT edges the smallest neighbours are written down first: the join then has partitions of its own, and the engine can
    split a hub's, which it can't where they are the aggregate's. Self loops and null ends are ignored.
    """

    def least_of(d: DataFrame, n: int) -> DataFrame:
        found = d.groupBy("a").agg(F.min("b").alias("m"))
        return table(found, "least") if n > SPLIT else found

    e = table(_oriented(edges), "edges")
    seen = None
    for _ in range(most_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not now[0] or now == seen:
            break
        seen = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = least_of(both, now[0])
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = _oriented(large)
        least = least_of(large, now[0])
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, e = e, table(_oriented(small.unionByName(least.select("a", F.col("m").alias("b")))), "edges")
        discard(old)
    else:
        raise RuntimeError("components did not settle")
    stars = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots.join(stars, "node", "left_anti"))


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
