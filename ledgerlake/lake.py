"""Parquet lake: table paths (S5), existence (S6), scans (S4), empty
fallback (S7) and writes (W1-W4, W7).

A table is a Parquet directory ``{root}/{layer}/{table}``; ``root`` may
be any Hadoop file system URI (``file:``, ``hdfs:``, ``s3a:``, ``gs:``).
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .operators.upsert import duplicate_keys, upsert_frames
from .session import checkpoint_dir


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
         where: Column | None = None, schema: StructType | None = None) -> DataFrame:
    """Parquet scan with projection and predicate; both reach the file
    reader (``ReadSchema`` / ``PushedFilters`` / ``PartitionFilters``)."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---------------------------------------------------------- paths
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, layer: str, table: str) -> bool:
        """The table directory exists and holds a data file (the listing
        stops at the first one, so a table with millions of files is cheap)."""
        fs, p = self._fs(self.path(layer, table))
        if not fs.exists(p):
            return False
        it = fs.listFiles(p, True)
        while it.hasNext():
            if it.next().getPath().getName().endswith(".parquet"):
                return True
        return False

    def file_count(self, layer: str, table: str, where: str | None = None) -> int:
        """Data files of the table, or of the partition sub-path ``where``
        (e.g. ``payment_date=2024-01-15``)."""
        path = self.path(layer, table) + (f"/{where}" if where else "")
        fs, p = self._fs(path)
        if not fs.exists(p):
            return 0
        it = fs.listFiles(p, True)
        n = 0
        while it.hasNext():
            if it.next().getPath().getName().endswith(".parquet"):
                n += 1
        return n

    def size_bytes(self, layer: str, table: str, where: str | None = None) -> int:
        path = self.path(layer, table) + (f"/{where}" if where else "")
        fs, p = self._fs(path)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    # ---------------------------------------------------------- reads
    def read(self, layer: str, table: str, schema: StructType | None = None,
             merge_schema: bool = False) -> DataFrame:
        """With a declared ``schema`` no footer is read while planning;
        ``merge_schema`` reads the footers of all files, so ask for it only
        where files of several schemas are expected and none is declared."""
        r = self.spark.read.schema(schema) if schema is not None else \
            self.spark.read.option("mergeSchema", str(merge_schema).lower())
        return r.parquet(self.path(layer, table))

    def read_or_empty(self, layer: str, table: str, schema: StructType) -> DataFrame:
        """The table, or an empty frame of the declared schema."""
        if self.exists(layer, table):
            return self.read(layer, table, schema)
        return self.spark.createDataFrame([], schema)

    def tables(self) -> list[tuple[str, str]]:
        """(layer, table) of every table directory under the root."""
        fs, root = self._fs(self.root)
        out = []
        if not fs.exists(root):
            return out
        for layer in fs.listStatus(root):
            name = layer.getPath().getName()
            if not layer.isDirectory() or name.startswith(("_", ".")):
                continue
            for t in fs.listStatus(layer.getPath()):
                tn = t.getPath().getName()
                if t.isDirectory() and not tn.startswith(("_", ".")) and self.exists(name, tn):
                    out.append((name, tn))
        return sorted(out)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every table as a temp view ``{prefix}{layer}_{table}`` for
        ``spark.sql`` (session-scoped; nothing is written to a catalog)."""
        names = []
        for layer, table in self.tables():
            name = f"{prefix}{layer}_{table}"
            self.read(layer, table).createOrReplaceTempView(name)
            names.append(name)
        return names

    # --------------------------------------------------------- writes
    @staticmethod
    def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
        obs = Observation()
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

    def _write(self, df: DataFrame, layer: str, table: str, mode: str,
               partition_by: Sequence[str] | None, dynamic: bool = False,
               rebalance: bool = True) -> int:
        if partition_by and rebalance:
            # one task per partition value where possible (few files), while
            # AQE splits a hot partition value over several tasks/files.
            df = df.hint("rebalance", *partition_by)
        counted, obs = self._counted(df)
        w = counted.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
        w.parquet(self.path(layer, table))
        return int(obs.get.get("rows", 0))

    def append(self, df: DataFrame, layer: str, table: str,
               partition_by: Sequence[str] | None = None) -> int:
        """Partitioned append; readers declare new columns (or merge schemas)."""
        return self._write(df, layer, table, "append", partition_by)

    def overwrite(self, df: DataFrame, layer: str, table: str,
                  partition_by: Sequence[str] | None = None, rebalance: bool = True) -> int:
        """Full overwrite."""
        return self._write(df, layer, table, "overwrite", partition_by, rebalance=rebalance)

    def replace_partitions(self, df: DataFrame, layer: str, table: str,
                           partition_by: Sequence[str], rebalance: bool = True) -> int:
        """Overwrite only the partitions present in ``df`` (dynamic mode)."""
        return self._write(df, layer, table, "overwrite", partition_by, dynamic=True,
                           rebalance=rebalance)

    def replace_partition(self, df: DataFrame, layer: str, table: str,
                          value: dict) -> int:
        """W3 with ``replaceWhere`` semantics for one partition value, e.g.
        ``{"report_date": "2024-01-15"}``: afterwards the partition holds
        exactly ``df``, also when ``df`` is empty (the partition is removed).
        A row outside the partition is an error that stops the write before
        anything is replaced.
        """
        cols = list(value)
        inside = F.lit(True)
        for c, v in value.items():
            inside = inside & (F.col(c) == F.lit(v).cast(df.schema[c].dataType))
        refuse = f"rows outside partition {value} of {layer}.{table}"
        checked = df.filter(F.when(F.coalesce(inside, F.lit(False)), F.lit(True))
                             .otherwise(F.raise_error(F.lit(refuse)).cast("boolean")))
        try:
            n = self._write(checked, layer, table, "overwrite", cols, dynamic=True)
        except Exception as e:
            if refuse in str(e):
                raise ValueError(refuse) from e
            raise
        if n == 0:
            self._delete(self.path(layer, table) + "/" + "/".join(f"{c}={v}" for c, v in value.items()))
        return n

    def replace_values(self, df: DataFrame, layer: str, table: str, column: str, values: Sequence[str]) -> int:
        """W3 for several values of one partition column: afterwards these
        partitions hold exactly ``df``; those without rows are removed.  A row
        outside them is an error that stops the write before it replaces."""
        if not values:
            return 0
        refuse = f"rows outside {column} of {layer}.{table}"
        wanted = [F.lit(v).cast(df.schema[column].dataType) for v in values]
        inside = F.coalesce(F.col(column).isin(*wanted), F.lit(False))
        checked = df.filter(F.when(inside, F.lit(True)).otherwise(F.raise_error(F.lit(refuse)).cast("boolean")))
        seen = Observation()
        checked = checked.observe(seen, F.collect_set(F.col(column).cast("string")).alias("values"))
        try:
            n = self._write(checked, layer, table, "overwrite", [column], dynamic=True)
        except Exception as e:
            if refuse in str(e):
                raise ValueError(refuse) from e
            raise
        for v in sorted(set(values) - set(seen.get.get("values") or [])):
            self._delete(f"{self.path(layer, table)}/{column}={v}")
        return n

    def cut(self, df: DataFrame) -> DataFrame:
        """Cut lineage through a reliable checkpoint in the shared folder."""
        checkpoint_dir(self.spark, f"{self.root}/_checkpoints")
        return df.checkpoint()

    @contextmanager
    def staged(self, df: DataFrame):
        """Cut lineage: write ``df`` to a fresh table in the shared checkpoint
        folder and yield it read back, so an overwrite never reads the files
        it replaces; the folder goes when the block ends."""
        d = checkpoint_dir(self.spark, f"{self.root}/_checkpoints")
        path = f"{d.rstrip('/')}/stage-{uuid.uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            self._delete(path)

    def _swap(self, merged: DataFrame, touched: DataFrame, layer: str, table: str,
              partition_by: Sequence[str]) -> int:
        """Replace the ``touched`` partitions by ``merged`` (staged rows); those
        left without rows are removed.  Their names are streamed, one at a
        time (a dynamic overwrite cannot express "no rows")."""
        cols = list(partition_by)
        n = self.replace_partitions(merged, layer, table, cols)
        emptied = touched.select(*cols).exceptAll(merged.select(*cols).distinct())
        for p in emptied.toLocalIterator():
            sub = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if p[c] is None else p[c]}" for c in cols)
            self._delete(f"{self.path(layer, table)}/{sub}")
        return n

    def upsert(self, source: DataFrame, layer: str, table: str, keys: Sequence[str],
               update_columns: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
               check_unique: bool = True, schema: StructType | None = None, null_safe: bool = False) -> int:
        """MERGE-like upsert; returns rows written.

        Only partitions touched by the source are read, merged and replaced
        (left-semi join on the partition columns, which Spark turns into
        dynamic partition pruning).  A key that the source moves between
        touched partitions moves; rows of its key in other partitions are
        the caller's (see ``delete_keys``).
        """
        if check_unique and duplicate_keys(source, keys).limit(1).count() > 0:
            raise ValueError(f"source has duplicate keys on {list(keys)}")
        if not self.exists(layer, table):
            return self._write(source, layer, table, "overwrite", partition_by)
        target = self.read(layer, table, schema)
        if partition_by:
            touched = source.select(*partition_by).distinct()
            same = [target[c].eqNullSafe(touched[c]) for c in partition_by]
            target = target.join(touched, same, "left_semi")
        with self.staged(upsert_frames(target, source, keys, update_columns, null_safe)) as merged:
            if partition_by:
                return self._swap(merged, touched, layer, table, partition_by)
            return self.overwrite(merged, layer, table)

    def _rewrite_without(self, t: DataFrame, gone: DataFrame, keep: DataFrame, layer: str, table: str,
                         partition_by: Sequence[str]) -> int:
        """Rewrite the partitions that hold rows of ``gone`` from ``keep``."""
        cols = list(partition_by)
        per = gone.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        with self.staged(per) as touched:
            deleted = touched.agg(F.sum("_n")).first()[0] or 0
            if not deleted:
                return 0
            same = [keep[c].eqNullSafe(touched[c]) for c in cols]
            with self.staged(keep.join(touched, same, "left_semi").select(*t.columns)) as kept:
                self._swap(kept, touched, layer, table, cols)
            return int(deleted)

    def delete_where(self, layer: str, table: str, predicate: Column, partition_by: Sequence[str],
                     schema: StructType | None = None) -> int:
        """Delete rows matching ``predicate``; returns rows deleted.  Only
        partitions that hold a matching row are read again and rewritten."""
        t = self.read(layer, table, schema)
        hit = F.coalesce(predicate, F.lit(False))
        return self._rewrite_without(t, t.filter(hit), t.filter(~hit), layer, table, partition_by)

    def delete_keys(self, layer: str, table: str, keys: DataFrame, partition_by: Sequence[str],
                    schema: StructType | None = None) -> int:
        """Delete the rows whose columns equal a row of ``keys``."""
        t = self.read(layer, table, schema)
        on = [t[c] == keys[c] for c in keys.columns]
        return self._rewrite_without(t, t.join(keys, on, "left_semi"), t.join(keys, on, "left_anti"),
                                     layer, table, partition_by)
