"""Helpers shared by the operators of this folder."""
from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: ASCII white space that separates words (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table.  Python workers are told where this package lies, for
    drivers that found it through their own path only."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0 (NULL id: False)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def batches(rows: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive groups of rows whose weights sum to about ``limit``."""
    group, total = [], 0
    for row in rows:
        group.append(row)
        total += weight(row)
        if total >= limit:
            yield group
            group, total = [], 0
    if group:
        yield group


def give_back() -> None:
    """Freed memory that the allocators still hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)        # glibc only
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` of a mapInArrow step that needs much memory.  Its Python worker
    stays for tasks of other steps, so it gives back what the task freed."""

    def task(stream):
        try:
            yield from run(stream)
        finally:
            give_back()
    return task
