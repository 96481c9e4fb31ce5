"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` holds the line hashes seen so far as immutable runs, each a
Parquet table bucketed and sorted by hash.  A new batch is grouped by hash
(map-side first), merge-joined with every run without shuffling the runs, and
written as one more run of level 0 with the keys that no run has.  When a
level holds ``fanout`` runs, the next batch first merges them into one run of
the level above, so a batch meets ``fanout`` runs a level at most, and there
are logarithmically many levels.

A key is a line without ASCII white space at its ends and with A-Z in lower
case, named by two 64-bit hashes (a false match needs an equal 128-bit name).
A run keeps, per key, the document that holds it first; a line goes where its
key's first document is another one.  So adding a batch again, after a
failure, gives the same decisions, and in batches by ascending id the first
document is the one with the smallest id.

Hot lines: the group by collapses a line's copies before the shuffle, and the
keys with at least ``HOT_SHARE`` of a batch's lines (1 / ``HOT_SHARE`` of them
at most) meet their lines by broadcast, so no task receives a hot key's rows.

Cases: a NULL or empty text is one empty line; lines with short keys always
stay; a line repeated inside its first document stays; a NULL id counts as the
largest; rows with equal ids are one document; an empty table gives no rows;
other columns are ignored (``dedup_lines``) or kept (``dedup_documents``).
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lake import Lake
from .common import shared_path

#: ASCII white space stripped at both ends of a line.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with at least this share of a batch's lines is hot.
HOT_SHARE = 0.001
LAST_ID = 2**63 - 1
RUN = "h BIGINT, g BIGINT, first BIGINT, known BOOLEAN, repeated BOOLEAN, n BIGINT"


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else as it is; plain ASCII takes the fast way."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _names(c: Column) -> list[Column]:
    return [F.xxhash64(c), F.xxhash64(F.lit("second"), c)]


def _document(doc_id: str, text: str) -> list[Column]:
    """The columns that name a row: id (NULL: the largest) and text hashes."""
    a, b = _names(F.coalesce(F.col(text), F.lit("")))
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("_doc"), a.alias("_ta"), b.alias("_tb")]


def line_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """(_doc, _ta, _tb, pos, h, g): the lines whose key has ``min_chars``."""
    lines = docs.select(*_document(doc_id, text), F.posexplode(split_lines(F.col(text))).alias("pos", "line"))
    h, g = _names(F.col("key"))
    return (lines.select("_doc", "_ta", "_tb", "pos", line_key(F.col("line")).alias("key"))
                 .filter(F.length("key") >= min_chars)
                 .select("_doc", "_ta", "_tb", "pos", h.alias("h"), g.alias("g")))


class LineRuns:
    """Runs below ``path`` (a shared folder): ``level-<l>/run-<buckets>-<id>``."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = 4, buckets: int | None = None):
        self.spark, self.lake, self.fanout = spark, Lake(spark, path), fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[tuple[int, str]]:
        """(level, run), from the folder, so that another session can go on."""
        return [(int(level[6:]), run) for level, run in self.lake.tables()]

    def read(self, level: int, run: str) -> DataFrame:
        """A run as a bucketed, sorted table of the session's catalog."""
        name = run.replace("-", "_")
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({RUN}) USING parquet CLUSTERED BY (h, g) SORTED BY (h, g) "
                           f"INTO {run.split('-')[1]} BUCKETS LOCATION '{self.lake.path(f'level-{level}', run)}'")
        return self.spark.table(name)

    def _write(self, keys: DataFrame, level: int) -> tuple[int, str]:
        run = f"run-{self.buckets}-{uuid.uuid4().hex}"
        (keys.repartition(self.buckets, "h", "g").write.bucketBy(self.buckets, "h", "g").sortBy("h", "g")
             .option("path", self.lake.path(f"level-{level}", run)).saveAsTable(run.replace("-", "_")))
        return level, run

    def _drop(self, level: int, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run.replace('-', '_')}")
        self.lake._delete(self.lake.path(f"level-{level}", run))

    def close(self) -> None:
        """Take the runs out of the session's catalog; their files stay."""
        for _, run in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {run.replace('-', '_')}")

    def compact(self) -> None:
        """Merge every level that is full into one run of the level above.
        The merged run is written before its sources go; a key that is seen in
        both after a failure is the same key."""
        level = 0
        while True:
            full = [r for r in self.runs() if r[0] == level]
            if len(full) >= self.fanout:
                rows = None
                for r in full:
                    own = self.read(*r).filter("NOT known")
                    rows = own if rows is None else rows.unionByName(own)
                self._write(rows, level + 1)
                for r in full:
                    self._drop(*r)
            elif not any(r[0] > level for r in self.runs()):
                return
            level += 1

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of ``line_hashes`` (a table that can be read twice) and
        return (_doc, _ta, _tb, pos) of its lines to drop, a written table:
        later batches may merge the runs it was made from."""
        self.compact()
        keys = lines.groupBy("h", "g").agg(F.min("_doc").alias("first"), F.max("_doc").alias("last"),
                                           F.count(F.lit(1)).alias("n"))
        held = F.lit(None).cast("long")
        for i, r in enumerate(self.runs()):
            run = self.read(*r).filter("NOT known").select("h", "g", F.col("first").alias(f"first_{i}"))
            keys = keys.join(run, ["h", "g"], "left")
            held = F.coalesce(held, F.col(f"first_{i}"))
        keys = keys.select("h", "g", F.coalesce(held, F.col("first")).alias("first"), held.isNotNull().alias("known"),
                           (F.col("last") > F.col("first")).alias("repeated"), "n")
        own = self.read(*self._write(keys, 0))
        total = own.agg(F.sum("n")).first()[0] or 0
        doubles = own.filter("known OR repeated")
        hot = doubles.filter(F.col("n") >= HOT_SHARE * total).select("h", "g", F.col("first").alias("hot_first"))
        rest = doubles.filter(F.col("n") < HOT_SHARE * total).select("h", "g", "first")
        met = lines.join(F.broadcast(hot), ["h", "g"], "left")              # at most 1 / HOT_SHARE keys
        here = met.filter("hot_first <> _doc").select("_doc", "_ta", "_tb", "pos")
        cold = met.filter("hot_first IS NULL").join(rest, ["h", "g"]).filter("first <> _doc")
        path = shared_path(self.spark, "lines-to-drop")
        here.unionByName(cold.select("_doc", "_ta", "_tb", "pos")).write.parquet(path)
        return self.spark.read.schema("_doc long, _ta long, _tb long, pos int").parquet(path)


def _decided(docs: DataFrame, doc_id: str, text: str, min_chars: int, batches: int, fanout: int,
             keep: list[str]) -> DataFrame:
    """``keep`` columns, ``_lines`` and the sorted positions ``_gone`` (NULL: none)."""
    spark = docs.sparkSession
    own = [F.col(c) for c in keep]
    ids = docs.select(_document(doc_id, text)[0])
    edges = ids.agg(F.percentile_approx("_doc", [i / batches for i in range(1, batches)], 10000)).first()[0] or []
    number = F.lit(0)
    for e in edges:
        number = number + (F.col("_doc") > e).cast("int")
    path = shared_path(spark, "line-hashes")
    line_hashes(docs, doc_id, text, min_chars).withColumn("batch", number).write.partitionBy("batch").parquet(path)
    schema = "_doc long, _ta long, _tb long, pos int, h long, g long, batch int"
    store = LineRuns(spark, shared_path(spark, "line-runs"), fanout)
    gone = None
    for b in range(len(edges) + 1):
        found = store.add(spark.read.schema(schema).parquet(path).filter(F.col("batch") == b).drop("batch"))
        gone = found if gone is None else gone.unionByName(found)
    store.close()
    at = gone.groupBy("_doc", "_ta", "_tb").agg(F.sort_array(F.collect_set("pos")).alias("_gone"))
    named = docs.select(F.struct(*own).alias("_own"), *_document(doc_id, text),
                        split_lines(F.col(text)).alias("_lines"), F.col(text).isNull().alias("_empty"))
    return named.join(at, ["_doc", "_ta", "_tb"], "left").select("_own", "_lines", "_gone", "_empty")


def _kept_text() -> Column:
    """``_lines`` without the positions ``_gone``, joined again."""
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    return F.array_join(F.when(F.col("_gone").isNull(), F.col("_lines"))
                         .otherwise(F.transform(stay, lambda i: F.get("_lines", i))), "\n")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): lines whose key an earlier document
    holds go.  The table is read in ``batches`` of ascending ids."""
    done = _decided(docs, doc_id, text, min_chars, batches, fanout, [doc_id])
    return done.select(F.col("_own").getField(doc_id).alias("doc_id"), F.size("_lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
                       _kept_text().alias("kept"))


def dedup_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10,
                    batches: int = 4, fanout: int = 2) -> DataFrame:
    """The documents with their texts deduplicated (NULL stays NULL)."""
    done = _decided(docs, doc_id, text, min_chars, batches, fanout, docs.columns)
    return done.select(*[F.when(~F.col("_empty"), _kept_text()).alias(c) if c == text
                         else F.col("_own").getField(c).alias(c) for c in docs.columns])
