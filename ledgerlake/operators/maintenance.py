"""File maintenance as Spark jobs: clustered layout and compaction (M1, M5)."""
from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, columns: Sequence[str], num_files: int) -> DataFrame:
    """M1 layout: rows range-partitioned and sorted by ``columns``, so the
    Parquet statistics of a file cover a short range of the leading key,
    whatever its type.  A row hash breaks ties, so a hot key is cut too."""
    named = df.withColumn("_tie", F.xxhash64(*df.columns))
    return (named.repartitionByRange(num_files, *columns, "_tie")
                 .sortWithinPartitions(*columns, "_tie").drop("_tie"))


def files_for_bytes(size_bytes: int, target_file_mb: int = 128) -> int:
    return max(1, math.ceil(size_bytes / (target_file_mb * 1024 * 1024)))


def optimize_table(lake, layer: str, table: str, cluster_by: Sequence[str] | None = None,
                   target_file_mb: int = 128, partition_by: Sequence[str] | None = None,
                   where: dict | None = None, schema=None) -> dict:
    """M1: rewrite a table (or only the partition ``where``, e.g.
    ``{"payment_date": "2024-01-15"}``) into files of about
    ``target_file_mb``, optionally clustered; reports files before/after
    and seconds taken.  ``partition_by`` must name the table's partition
    columns: they lead the clustering, so a file task holds few of them.

    The new layout is staged in the shared checkpoint folder first, then
    swapped in (full overwrite, or dynamic overwrite of just the chosen
    partition), so a lost executor never leaves a half table and the job
    never reads files it is deleting.
    """
    t0 = time.time()
    sub = "/".join(f"{k}={v}" for k, v in where.items()) if where else None
    before = lake.file_count(layer, table, sub)
    df = lake.read(layer, table, schema)
    if where:
        for k, v in where.items():
            df = df.filter(F.col(k) == F.lit(v).cast(df.schema[k].dataType))
    n = files_for_bytes(lake.size_bytes(layer, table, sub), target_file_mb)
    keys = [*(partition_by or []), *(c for c in cluster_by or [] if c not in (partition_by or []))]
    laid = cluster(df, keys, n) if keys else df.repartition(n)
    with lake.staged(laid) as staged:
        if partition_by:
            rows = lake.replace_partitions(staged, layer, table, partition_by, rebalance=False)
        else:
            rows = lake.overwrite(staged, layer, table, rebalance=False)
    return {"table": f"{layer}.{table}", "before": before, "after": lake.file_count(layer, table, sub),
            "rows": rows, "duration_s": time.time() - t0}


def optimize_tables(lake, registry: Sequence[tuple[str, str, Sequence[str], Sequence[str]]], **kw) -> dict:
    """M5: optimise every existing table of a registry (layer, table, cluster
    columns, partition columns); the partitioning stays as it is."""
    out = {}
    for layer, table, cols, parts in registry:
        if lake.exists(layer, table):
            out[f"{layer}.{table}"] = optimize_table(lake, layer, table, list(cols) or None,
                                                     partition_by=list(parts) or None, **kw)
    return out
