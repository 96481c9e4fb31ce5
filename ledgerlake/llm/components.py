"""Connected components by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least(edges: DataFrame) -> DataFrame:
    """u and the smallest of u and its neighbours (a partial aggregate)."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b); the
    component is its smallest node.

    A large-star step ties each node's larger neighbours to its smallest one,
    a small-star step its smaller ones; repeated until nothing changes, every
    node points at its component's smallest.  A step is one aggregate and one
    equi-join; no node's neighbours are collected.  Each round is
    checkpointed in the shared folder.  Rounds end when the edges' number and
    128 bits of their hashes stay the same.
    """
    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    edges = cut(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, now = None, state(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .filter("u != v").distinct())
        small = large.join(_least(large), "u")
        new = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(small.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        edges = cut(new)
        before, now = now, state(edges)
    parts = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return parts.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
