"""Connected components of a graph of any size, by large-star and small-star steps on its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shared


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (longs a, b).

    Each round joins edges with the smallest neighbour of one end; no neighbourhood is ever gathered. Edges are written
    to the shared folder each round, until they no longer change: then each node points at its component.
    """

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = shared(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    was = mark(e)
    while was[0]:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that joins with it are between two shuffles, and Spark can split a hub's rows
        least = shared(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parent = shared(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(parent, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        before, e = e, shared(small.unionAll(parent.select("u", F.col("m").alias("v"))).distinct())
        discard(before, least, parent)
        now = mark(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
