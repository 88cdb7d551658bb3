"""Connected components of a link table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrisk.session import freeze


def _hooked(pairs: DataFrame) -> DataFrame:
    """Both directions of every pair with the least neighbour of the first end.

    A node with very many neighbours is one small row on one side of the join, so its rows
    on the other side can be split.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    return pairs.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """id, root (the smallest id reachable) of every id in `links` (a, b); each round's table is stored.

    Large star: neighbours above a node move to its least neighbour; small star: those below
    it, and the node itself, do. When nothing changes, every node hangs on its root. Rounds
    grow with the logarithm of the longest path. Pairs of equal ids and repeated pairs do no
    harm; no links give no rows.
    """
    pairs = freeze(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = F.least("a", "least")
        large = _hooked(both).where("b > a").select(F.col("b").alias("a"), root.alias("b")).distinct()
        small = _hooked(large).select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("x"))
        pairs = freeze(small.select("x.a", "x.b").where("a != b").distinct())
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
