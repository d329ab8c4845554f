"""Connected components by alternating large and small stars, each two shuffles of the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, Scratch, salted_join


def _star(neighbours: DataFrame, total: int, small: bool, scratch: Scratch) -> DataFrame:
    """Links every neighbour of u to the least of them and u. Hubs are dealt over salts; the list of hubs is bounded."""
    least = scratch.put(neighbours.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
    hot = least.where(F.col("n") > max(1000, total // HOT_SHARE)).select("u")
    both = salted_join(neighbours, least.select("u", F.least("u", "m").alias("m")), "u", ["v"], "inner", hot)
    if small:
        pairs = both.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("p")).select("p.*")
    else:
        pairs = both.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return scratch.put(pairs.where("a <> b").distinct())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (the least node of its component) for all nodes of ``edges`` (a, b).

    Both stars only ever link a node to a lesser one, so the edge set reaches a fixed point: a star round each root.
    """
    now = scratch.put(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    sign = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.count(F.when(F.col("a") % 2 == 0, 1))).first())
    before = sign(now)
    while before[0]:
        both_ways = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both_ways, before[0], False, scratch)
        small = _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), before[0], True, scratch)
        after = sign(small)
        scratch.drop(now)
        scratch.drop(large)
        now = small
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
