"""Connected components of a large graph in a logarithmic number of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import pin, unpin


def _mark(edges: DataFrame) -> tuple:
    """Edge count and an order-free checksum: equal in two rounds when nothing changed."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Smallest node each node of ``edges`` (u, v: long) can reach; returns node, root.

    Alternates two steps until nothing moves: every node hands its larger neighbours to
    its smallest one, then its smaller ones. Minima are formed before a shuffle, edges meet
    them in plain joins, and every round is written, so neither a hub nor a lost executor
    matters. Nodes without an edge to another node are not listed.
    """
    held = pin(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _mark(held)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = held.select("u", "v").unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = pin(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = pin(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        unpin(held, large)
        after = _mark(now)
        held = now
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    pairs = held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
