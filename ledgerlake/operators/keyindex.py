"""Key-to-day index of Silver (C3, W4, J6): where an id lives, without a scan
of all days.

The index is a list of immutable *runs*, one per merge, each hash-bucketed by
key: ``{name}/run=../bucket=..`` holds (key, day, version) and
``{name}_bloom/run=../bucket=..`` a blocked Bloom filter of the keys, one
64-bit word per block.  Bucket and block counts of a run follow from its
number of rows, so a filter is as tight at any size.  ``lookup`` probes the
filters with the incoming keys only, reads the buckets that may hold one of
them, and returns each key's newest row.  More than ``MAX_RUNS`` runs are
merged into one, so probes stay bounded.

A run is added after the table itself has been written: a run that is missing
after a failure is added when the same batch is merged again, and a row that
is added twice changes nothing, since the newest version of a key counts.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket, keys of a 64-bit block and bits set per key: about one
#: false positive per two thousand probes of a run.
BUCKET_ROWS, BLOCK_KEYS, BITS = 1 << 20, 2, 5
MAX_RUNS = 8
RUNS = "run string, buckets int, blocks long, row_count long"


def _mask(key: Column) -> Column:
    h = F.xxhash64(F.lit("bits"), key)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def _place(key: Column, buckets: Column, blocks: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit("bucket"), key), buckets.cast("long")).cast("int").alias("bucket"),
            F.pmod(F.xxhash64(F.lit("block"), key), blocks).alias("block")]


class KeyIndex:
    """``key`` -> ``day`` with a ``version`` tuple that orders a key's rows."""

    def __init__(self, lake, key: str, day: str, version: Sequence[str], layer: str = "silver",
                 name: str = "payment_index"):
        self.lake, self.key, self.day, self.version = lake, key, day, list(version)
        self.layer, self.name, self.bloom, self.registry = layer, name, f"{name}_bloom", f"{name}_runs"

    def columns(self) -> list[str]:
        return [self.key, self.day, *self.version]

    def exists(self) -> bool:
        return self.lake.exists(self.layer, self.registry)

    def runs(self) -> list:
        """The registered runs (``MAX_RUNS`` of them, one more while merging)."""
        return self.lake.read(self.layer, self.registry).collect() if self.exists() else []

    def clear(self) -> None:
        for table in (self.registry, self.bloom, self.name):
            self.lake._delete(self.lake.path(self.layer, table))

    def _write(self, rows: DataFrame) -> bool:
        """Write ``rows`` as one run; it counts once it is in the registry."""
        run, n = uuid.uuid4().hex, rows.count()
        if not n:
            return False
        buckets = -(-n // BUCKET_ROWS)
        blocks = -(-n // (buckets * BLOCK_KEYS))
        placed = rows.select(*self.columns(), F.lit(run).alias("run"),
                             *_place(F.col(self.key), F.lit(buckets), F.lit(blocks)))
        self.lake.replace_partitions(placed.drop("block"), self.layer, self.name, ["run", "bucket"])
        words = placed.groupBy("run", "bucket", "block").agg(F.bit_or(_mask(F.col(self.key))).alias("bits"))
        self.lake.replace_partitions(words, self.layer, self.bloom, ["run", "bucket"])
        entry = self.lake.spark.createDataFrame([(run, buckets, blocks, n)], RUNS)
        self.lake.replace_partitions(entry, self.layer, self.registry, ["run"], rebalance=False)
        return True

    def add(self, rows: DataFrame) -> None:
        """Add one run of rows with a non-NULL key; merge all runs when there are many."""
        if self._write(rows.filter(F.col(self.key).isNotNull())) and len(self.runs()) > MAX_RUNS:
            self.compact()

    def compact(self) -> None:
        """One run with the newest row of every key in place of all runs."""
        old = self.runs()
        self._write(self._newest(self._rows(old)))
        for table in (self.registry, self.bloom, self.name):
            for r in old:
                self.lake._delete(f"{self.lake.path(self.layer, table)}/run={r['run']}")

    def _rows(self, runs: list) -> DataFrame:
        return self.lake.read(self.layer, self.name).filter(F.col("run").isin([r["run"] for r in runs]))

    def _newest(self, rows: DataFrame) -> DataFrame:
        packed = F.struct(*self.version, self.day)
        return rows.groupBy(self.key).agg(F.max(packed).alias("_v")).select(self.key, "_v.*") \
            .select(*self.columns())

    def candidates(self, keys: DataFrame) -> DataFrame:
        """(run, bucket, key) of the keys a run's filter does not rule out."""
        runs = F.array(*[F.struct(F.lit(r["run"]).alias("run"), F.lit(r["buckets"]).alias("buckets"),
                                  F.lit(r["blocks"]).alias("blocks")) for r in self.runs()])
        key = F.col(self.key)
        probes = keys.select(self.key).filter(key.isNotNull()).distinct().select(self.key, F.inline(runs)) \
            .select("run", self.key, *_place(key, F.col("buckets"), F.col("blocks")), _mask(key).alias("mask"))
        words = self.lake.read(self.layer, self.bloom)
        same = [probes[c] == words[c] for c in ("run", "bucket", "block")]
        return probes.join(words, [*same, words["bits"].bitwiseAND(probes["mask"]) == probes["mask"]], "left_semi") \
            .select("run", "bucket", self.key)

    def read_buckets(self, maybe: DataFrame) -> DataFrame:
        """Index rows of the buckets named in ``maybe`` (runs x buckets of
        them at most): a static partition filter."""
        read = maybe.select("run", "bucket").distinct().collect()
        inside = F.lit(False)
        for run in sorted({r["run"] for r in read}):
            inside = inside | ((F.col("run") == run)
                               & F.col("bucket").isin([r["bucket"] for r in read if r["run"] == run]))
        return self.lake.read(self.layer, self.name).filter(inside)

    def lookup(self, rows: DataFrame) -> DataFrame:
        """The newest indexed row of each key of ``rows`` (which has the
        index's columns); only buckets that may hold one are read."""
        if not self.exists():
            return rows.select(*self.columns()).limit(0)
        with self.lake.staged(self.candidates(rows)) as maybe:
            found = self.read_buckets(maybe).join(maybe, ["run", "bucket", self.key], "left_semi")
            return self.lake.cut(self._newest(found))
