"""Digest tree over two snapshots (M4): compare by digests, read what differs.

A snapshot is a table partitioned by a hash bucket of its key, with a digest
per bucket: its number of rows and two order-free sums of 64-bit row hashes.
Digests of ``FANOUT`` neighbours add up to one node of the level above, to a
single root.  Two snapshots are compared from the root down; only the children
of differing nodes are joined, and the change feed reads only the buckets
whose digests differ, so its cost follows the change and not the table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .history import change_feed

FANOUT = 16
_SUMS = ("row_count", "total", "mixed")


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(F.lit("bucket"), *keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """(level, node, row_count, total, mixed) of a frame with ``bucket``; level
    0 holds the buckets, the last level one root.  Every level is a sum of
    the one below, so the rows are read once."""
    named = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("!")) for c in columns])
    leaf = df.select("bucket", F.xxhash64(named).alias("h"), F.xxhash64(F.lit("mix"), named).alias("g")) \
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"),
                               F.bit_xor("g").alias("mixed"))
    levels = 1
    while FANOUT ** (levels - 1) < buckets:
        levels += 1
    up = F.posexplode(F.array(*[F.floor(F.col("bucket") / FANOUT ** k).cast("long") for k in range(levels)]))
    return leaf.select(up.alias("level", "node"), *_SUMS).groupBy("level", "node").agg(
        F.sum("row_count").alias("row_count"), F.sum("total").cast("decimal(38,0)").alias("total"),
        F.bit_xor("mixed").alias("mixed"))


def write_snapshot(lake, df: DataFrame, layer: str, table: str, keys: Sequence[str], buckets: int) -> None:
    """The table by bucket, and ``<table>_digests`` by level."""
    lake.overwrite(df.withColumn("bucket", bucket_of(keys, buckets)), layer, table, partition_by=["bucket"])
    tree = digests(lake.read(layer, table), sorted(df.columns), buckets)
    lake.overwrite(tree, layer, f"{table}_digests", partition_by=["level"])


def differing(lake, layer: str, old: str, new: str) -> list[int]:
    """Buckets whose rows differ, found level by level from the root; as many
    numbers as differing partitions."""
    a, b = (lake.read(layer, f"{t}_digests") for t in (old, new))
    top = a.agg(F.max("level")).first()[0]
    if top is None or top != b.agg(F.max("level")).first()[0]:
        raise ValueError(f"snapshots {old} and {new} have different trees")
    nodes = None
    for level in range(top, -1, -1):
        x, y = (t.filter(F.col("level") == level).select("node", F.struct(*_SUMS).alias(n))
                for t, n in ((a, "x"), (b, "y")))
        if nodes is not None:
            inside = F.floor(F.col("node") / FANOUT).isin(nodes)
            x, y = x.filter(inside), y.filter(inside)
        found = x.join(y, "node", "full_outer").filter(~F.col("x").eqNullSafe(F.col("y")))
        nodes = sorted(r[0] for r in found.select("node").collect())
        if not nodes:
            return []
    return nodes


def snapshot_feed(lake, layer: str, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """M4: ``change_feed`` between two snapshots, reading differing buckets only."""
    buckets = differing(lake, layer, old, new)
    a, b = (lake.read(layer, t).filter(F.col("bucket").isin(buckets)).drop("bucket") for t in (old, new))
    return change_feed(a, b.select(*a.columns), keys)
