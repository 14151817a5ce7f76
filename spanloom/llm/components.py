"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.skew import hot_join
from spanloom.session import Scratch

HELD = 500  #: edges of one node that a task gets at most, but for a fixed share of a hotter node's


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: a, b. Returns node, comp: the smallest node that each node of an edge reaches, by rounds that end when nothing changes.

    Each star is a minimum by key (combined before the shuffle) joined back to the edges; no neighbour list is built, and
    the edges of a node with very many are dealt over tasks.
    """
    now = scratch.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = _state(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"), F.count("*").alias("n")))
        # large-star: a node's larger neighbours go to the least of its neighbourhood
        large = hot_join(both.where("v > u"), low, ["u"], "n", HELD).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.write(large)
        # small-star: its smaller neighbours and itself go there too
        least = scratch.write(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = hot_join(large, least, ["u"], "n", HELD).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = scratch.write(small)
        for old in (low, large, least, now):
            scratch.drop(old)
        now, state = after, _state(after)
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(now.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())
