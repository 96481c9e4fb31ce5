"""Phrase collocations by top-order marginalisation.

Every word position gives one window: the word and the ``order - 1`` words
after it in its piece (lead columns), padded at the piece's end.  Only these
longest windows are counted, in each task first and then per bucket of their
two leading words.  An occurrence of a shorter phrase starts exactly one
window, so a ROLLUP over the window columns that sums the counts by
successively shorter prefixes gives the frequency of every shorter phrase, of
every word and (no column left) of all words of a group.  No second n-gram
explosion is made.

A bucket holds all windows with its leading pairs, so it knows every prefix of
two or more words in full.  A window is shortened there to its longest prefix
with ``min_count`` occurrences (at least its first word): the sums of all
frequent phrases stay exact, and the ROLLUP reads few rows.

A candidate's score is the smallest, over its cuts into two parts, of
floor(scale * a * a / (l * r)) with a, l and r the frequencies of the phrase
and of its parts, in exact decimals (a up to 10^16).  A candidate goes when a
longer candidate contains it contiguously with at least ``inside_percent`` of
its frequency.

Skew: copies of a window collapse in the task that reads them, so a hot
passage or word reaches no other task as rows; the joins run over candidates
and their parts, which are distinct phrases; the ranking keeps each task's
first ``top`` rows of a group before the shuffle (window group limit).

Cases: NULL texts have no words; a NULL group is ``other``; a group without
candidates gives no rows; ties rank by frequency, then phrase in byte order;
an empty table gives no rows.  Other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_path

#: Byte that ends a piece after ``TABLE``; no UTF-8 text contains it.
END = 0xFF
_MAP = {**{c: END for c in b".,;:!?\n\x0b\x0c\r"}, 0x09: 0x20, **{c: c + 32 for c in range(65, 91)}}
#: A-Z in lower case, tabs as spaces, piece ends as ``END``.
TABLE = bytes(_MAP.get(c, c) for c in range(256))
#: Bytes split at once, words counted at once in a task, text of a bucket.
CHUNK, FLUSH, BUCKET_BYTES = 1 << 21, 1 << 21, 1 << 25


def _word_ids(data: bytes, vocab: defaultdict) -> Iterator[np.ndarray]:
    """Word numbers of a text, 0 at the end of a piece; a long text is cut
    between words, which no window sees."""
    data, at = data.translate(TABLE), 0
    while at < len(data):
        ends = [e for e in (data.find(b" ", at + CHUNK), data.find(bytes([END]), at + CHUNK)) if e >= 0]
        cut = min(ends, default=len(data))
        words = data[at:cut].replace(b"\xff", b" \xff ").split()
        yield np.fromiter(map(vocab.__getitem__, words), np.int64, len(words))
        at = cut


def _sum_equal(cols: list[np.ndarray], counts: np.ndarray | None, top: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``cols`` (numbers below ``top``), sorted, and the sums
    of their counts (None: one each)."""
    bits = max(1, int(top - 1).bit_length())
    if bits * len(cols) <= 63:
        key = cols[0]
        for c in cols[1:]:
            key = (key << bits) | c
        if counts is None:
            key, total = np.unique(key, return_counts=True)
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            total = np.add.reduceat(counts[order], first) if len(key) else counts
            key = key[first]
        out = [(key >> (bits * (len(cols) - 1 - i))) & ((1 << bits) - 1) for i in range(len(cols))]
        return out, total.astype(np.int64)
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)]
    first = np.flatnonzero(new)
    weights = np.ones(len(order), np.int64) if counts is None else counts[order]
    return [c[first] for c in cols], np.add.reduceat(weights, first)


def _lead_columns(ids: np.ndarray, order: int) -> list[np.ndarray]:
    """The word of every position and the words after it in its piece (0: none)."""
    padded = np.r_[ids, np.zeros(order, np.int64)]
    cols, inside = [ids], ids != 0
    for i in range(1, order):
        nxt = padded[i:i + len(ids)]
        inside = inside & (nxt != 0)
        cols.append(np.where(inside, nxt, 0))
    start = ids != 0
    return [c[start] for c in cols]


def _buckets(group: str, hashes: np.ndarray, first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (hashes[first] + np.uint64(zlib.crc32(group.encode()))) * np.uint64(0x9E3779B97F4A7C15)
        h = ((h ^ (h >> np.uint64(29))) + hashes[second]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def _count_windows(order: int, buckets: int):
    """Arrow batches of (group, text) -> this task's distinct windows and
    their counts, one row per bucket: words joined by spaces, the window
    columns one after the other as word places (0: padding), counts."""
    names = ["bucket", "group", "words", "w", "c"]

    def flush(vocab, held) -> Iterator[pa.RecordBatch]:
        words = [None, *list(vocab)[1:]]
        hashes = np.array([0, *[zlib.crc32(w) for w in words[1:]]], np.uint64)
        for group, parts in held.items():
            cols, c = _sum_equal(_lead_columns(np.concatenate(parts), order), None, len(words))
            if not len(c):
                continue
            b = _buckets(group, hashes, cols[0], cols[1], buckets)
            by = np.argsort(b, kind="stable")
            cols, c, b = [x[by] for x in cols], c[by], b[by]
            cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1], True])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                flat = np.concatenate([x[lo:hi] for x in cols])
                used = np.unique(np.r_[0, flat])                    # place 0 is the padding
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(b[lo])], pa.int64()), pa.array([group]),
                     pa.array([b" ".join(words[i] for i in used[1:])], pa.binary()),
                     pa.array([np.searchsorted(used, flat).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([c[lo:hi].astype(np.int32)], pa.list_(pa.int32()))], names)

    def fresh():
        vocab = defaultdict(count().__next__)
        vocab[b"\xff"]                                              # number 0
        return vocab, {}, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, held, size = fresh()
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for group, text in zip(batch.column("group").to_pylist(), texts):
                parts = held.setdefault(group, [])
                for ids in _word_ids(text, vocab):
                    parts.append(ids)
                    size += len(ids)
                parts.append(np.zeros(1, np.int64))
                if size >= FLUSH:
                    yield from flush(vocab, held)
                    vocab, held, size = fresh()
        yield from flush(vocab, held)
    return run


def _fold(words: list[bytes], cols: list[np.ndarray], c: np.ndarray, min_count: int):
    """Shorten every window to its longest prefix with ``min_count``
    occurrences; windows are sorted, so a prefix is a stretch of them."""
    depth = np.ones(len(c), np.int64)
    new = np.r_[True, cols[0][1:] != cols[0][:-1]]
    for i in range(1, len(cols)):
        new = new | np.r_[True, cols[i][1:] != cols[i][:-1]]
        stretch = np.cumsum(new) - 1
        sums = np.bincount(stretch, weights=c).astype(np.int64)[stretch]
        depth[(sums >= min_count) & (cols[i] != 0)] = i + 1
    return _sum_equal([np.where(i < depth, x, 0) for i, x in enumerate(cols)], c, len(words))


def _merge_windows(order: int, min_count: int):
    """Rows of ``_count_windows``, sorted by bucket and group -> (group, w1 ..,
    c), shortened windows of one bucket and group at a time."""
    names = ["group", *[f"w{i + 1}" for i in range(order)], "c"]

    def close(group: str, parts: list) -> pa.RecordBatch:
        vocab = defaultdict(count().__next__)
        vocab[None]                                                 # number 0: padding
        cols, counts = [[] for _ in range(order)], []
        for words, w, c in parts:
            place = np.array([0, *map(vocab.__getitem__, words.split(b" "))], np.int64)
            for i, x in enumerate(np.split(place[w], order)):
                cols[i].append(x)
            counts.append(c.astype(np.int64))
        words = list(vocab)
        cols, c = _sum_equal([np.concatenate(x) for x in cols], np.concatenate(counts), len(words))
        cols, c = _fold(words, cols, c, min_count)
        text = pa.array(["", *[w.decode() for w in words[1:]]], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([group] * len(c), pa.string()), *[text.take(pa.array(x)) for x in cols],
             pa.array(c, pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts = None, []
        for batch in batches:
            w, c = batch.column("w"), batch.column("c")
            for i, key in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("group").to_pylist())):
                if key != here and parts:
                    yield close(here[1], parts)
                    parts = []
                here = key
                parts.append((batch.column("words")[i].as_py(), w[i].values.to_numpy(), c[i].values.to_numpy()))
        if parts:
            yield close(here[1], parts)
    return run


def windows(docs: DataFrame, text: str, group: str, order: int, min_count: int, other: str) -> DataFrame:
    """(group, w1 .. w<order>, c): counted windows, shortened to frequent prefixes."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(other)).alias("group"), F.col(text).alias("text")) \
        .filter("text IS NOT NULL")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    counted = src.mapInArrow(_count_windows(order, buckets),
                             "bucket long, group string, words binary, w array<int>, c array<int>")
    words = ", ".join(f"w{i + 1} string" for i in range(order))
    return counted.repartition(buckets, "bucket", "group").sortWithinPartitions("bucket", "group") \
        .mapInArrow(_merge_windows(order, min_count), f"group string, {words}, c long")


def frequencies(docs: DataFrame, text: str = "text", group: str = "lang", order: int = 3, min_count: int = 10,
                other: str = "und") -> DataFrame:
    """(group, words, phrase, f): phrases of up to ``order`` words with at
    least ``min_count`` occurrences; ``words`` 0 holds all words of the group."""
    spark, w = docs.sparkSession, [f"w{i}" for i in range(1, order + 1)]
    path = shared_path(spark, "phrases")
    sums = windows(docs, text, group, order, min_count, other).rollup("group", *w) \
        .agg(F.sum("c").alias("f"), F.grouping_id("group", *w).alias("level"))
    words = F.lit(order) - F.bit_count("level")               # a level sums out the columns of its set bits
    sums = sums.withColumn("words", words).filter("words >= 0").withColumn("all", F.array(*w)) \
        .withColumn("last", F.when(F.col("words") > 0, F.get("all", F.col("words") - 1)).otherwise(F.lit("all")))
    sums.filter((F.col("last") != "") & ((F.col("words") == 0) | (F.col("f") >= min_count))) \
        .select("group", "words", F.array_join(F.slice("all", 1, F.col("words")), " ").alias("phrase"), "f") \
        .write.parquet(path)
    return spark.read.parquet(path)


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", order: int = 3, min_count: int = 10,
                 inside_percent: int = 50, top: int = 2000, scale: int = 1_000_000, other: str = "und") -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): each group's ``top``
    candidates of two to ``order`` words."""
    freq = frequencies(docs, text, group, order, min_count, other)
    cand = freq.filter("words >= 2").withColumnRenamed("f", "a")
    parts = F.split("phrase", " ")
    cuts = cand.select("group", "phrase", "words", "a", parts.alias("p"),
                       F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
        .withColumn("left", F.array_join(F.slice("p", 1, F.col("k")), " ")) \
        .withColumn("right", F.array_join(F.slice("p", F.col("k") + 1, F.col("words")), " ")).drop("p")
    phrases = freq.filter("words > 0")
    left = phrases.select("group", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("group", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["group", "left"]).join(right, ["group", "right"]).withColumn(
        "score", F.call_function("div", F.lit(scale).cast("decimal(7,0)") * (_exact("a") * _exact("a")),
                                 _exact("l") * _exact("r")).cast("long"))
    best = scored.groupBy("group", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")) \
        .select("group", "phrase", "words", "a", "b.l", "b.r", "b.score")
    # phrases inside longer candidates, with the longer one's frequency
    inner = cand.filter("words > 2").select(
        "group", "a", "words", parts.alias("p"),
        F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")) \
        .select("group", "a", "p", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at")) \
        .groupBy("group", F.array_join(F.slice("p", F.col("at"), F.col("size")), " ").alias("phrase")) \
        .agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["group", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * _exact("longer") < F.lit(inside_percent) * _exact("a")))
    w = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= top)
    totals = freq.filter("words = 0").select("group", F.col("f").alias("n"))
    return ranked.join(totals, "group").select("group", "rank", "phrase", "a", "l", "r", "n", "score")
