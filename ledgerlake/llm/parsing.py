"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up.  On each level runs of one symbol become a
symbol; deterministic coin tossing (the lowest bit in which a symbol differs
from its left neighbour, and that bit's value, four times over) gives labels
below six that differ between neighbours; a phrase begins at each local
maximum of the labels; and a phrase is named by a hash of its symbols.  A
cut depends on a few symbols around it only, so equal substrings get equal
interior names whatever their offset.  The fingerprint is the sorted list of
the SKETCH smallest names of levels LEVEL and up; likeness is the Dice
coefficient that the sketches estimate (exact for short texts).

Defined cases: NULL text counts as empty; the empty text has the empty
fingerprint, alike to the empty text only; NULL ids sort first; documents
that share an id are ordered by their text's hash; texts above SEGMENT code
points are parsed in segments of that size; one document is its own next; an
empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import _batch
from .tokenstore import _range_of

SKETCH, LEVEL, SEGMENT, CHARS = 64, 2, 2_000_000, 400_000
_RUN_BITS = 21                                        # a code point has 21 bits
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD, _ODD_INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [np.cumprod(np.full(max(n, 2 * CHARS), x, np.uint64)) for x in (_ODD, _ODD_INVERSE)]
    return _POWERS


def _labels(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Four rounds of coin tossing; a text's first symbol is compared with one
    that differs in bit 0."""
    for _ in range(4):
        x = np.empty_like(s)
        x[1:] = s[1:] ^ s[:-1]
        x[first] = 1
        bit = np.bitwise_count((x & (~x + 1)) - 1)
        s = ((bit << 1) | ((s >> bit) & 1).astype(np.uint8))
    return s


def _level(s: np.ndarray, starts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(names, starts) of the next level; ``starts`` are the texts' first symbols."""
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    new[starts] = True
    if not new.all():                                 # runs
        at = np.flatnonzero(new)
        run = np.diff(np.append(at, len(s)))
        starts = np.searchsorted(at, starts)
        s = s[at]
        long = run > 1
        if s.dtype == np.uint32:
            s[long] += (((run[long] - 1) % 2047) << _RUN_BITS).astype(np.uint32)
        else:
            s[long] = _mix(s[long] + run[long].astype(np.uint64) * _STEP)
    label = _labels(s, starts)
    cut = np.zeros(len(s), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    cut[np.append(starts[1:], len(s)) - 1] = False    # never by a neighbour of another text
    cut[starts] = True
    at = np.flatnonzero(cut)
    size = np.diff(np.append(at, len(s))).astype(np.uint64)
    up, down = _powers(len(s))
    run = np.cumsum(s * up[:len(s)])                  # polynomial hash of each phrase from running sums
    total = run[np.append(at[1:], len(s)) - 1]
    total[1:] -= run[at[1:] - 1]
    return _mix(total * down[at] + size + np.uint64(level * int(_STEP) % 2 ** 64)), np.searchsorted(at, starts)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The sorted smallest distinct 32-bit names of each text."""
    owner, parts = [], []
    for i, t in enumerate(texts):
        for a in range(0, len(t), SEGMENT):
            owner.append(i)
            parts.append(t[a:a + SEGMENT])
    if not parts:
        return [np.empty(0, np.uint32) for _ in texts]
    s = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).copy()
    sizes = np.array([len(p) for p in parts])
    starts, owner = np.cumsum(sizes) - sizes, np.array(owner, np.uint64)
    found, level = [], 0
    while level < LEVEL or len(s) > len(starts):
        level += 1
        if level > LEVEL:                             # texts of one name are done
            count = np.diff(np.append(starts, len(s)))
            s, owner = s[np.repeat(count > 1, count)], owner[count > 1]
            starts = np.cumsum(count[count > 1]) - count[count > 1]
        s, starts = _level(s, starts, level)
        if level >= LEVEL:
            count = np.diff(np.append(starts, len(s)))
            found.append((np.repeat(owner, count) << np.uint64(32)) | (s >> np.uint64(32)))
    names = np.concatenate(found)
    of = (names >> np.uint64(32)).astype(np.int64)
    # names above a text's likely last place are left out of the sort, unless too few remain
    most = np.minimum(4.0 * SKETCH / np.maximum(np.bincount(of, minlength=len(texts)), 1), 1.0)
    low = (names & np.uint64(2 ** 32 - 1)) <= (most * (2 ** 32 - 1)).astype(np.uint64)[of]
    out = _smallest(names[low], len(texts))
    short = [len(k) < SKETCH and m < 1 for k, m in zip(out, most)]
    if any(short):
        again = _smallest(names[np.array(short)[of]], len(texts))
        out = [b if x else a for a, b, x in zip(out, again, short)]
    return out


def _smallest(names: np.ndarray, n: int) -> list[np.ndarray]:
    names = np.unique(names)
    cuts = np.searchsorted(names, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    return [names[a:min(b, a + SKETCH)].astype(np.uint32) for a, b in zip(cuts, cuts[1:])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of the name sets, from their sketches."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SKETCH]
    shared = np.intersect1d(a, b, assume_unique=True)
    j = np.searchsorted(shared, union[-1], side="right") / len(union)
    return float(2 * j / (1 + j))


def _hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (hexadecimal, eight digits a name) of every row."""
    fields = [("doc_id", pa.int64()), ("fingerprint", pa.string())]

    def run(stream):
        for b in stream:
            rows = list(zip(b.column(0).to_pylist(), (t.as_py() or "" for t in b.column(1))))
            for a in range(0, len(rows), 100):
                some = rows[a:a + 100]
                yield _batch(fields, [(i, _hex(k)) for (i, _), k in zip(some, sketches([t for _, t in some]))])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(run, "doc_id long, fingerprint string"))


_PAIR_T = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _with_next(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(doc_id, text, next text) of each range's documents; the range ends
    with the document that follows its last one (kind 1)."""
    last = None
    for b in stream:
        for kind, doc, text in zip(b.column("kind").to_pylist(), b.column("doc_id").to_pylist(), b.column("text")):
            text = text.as_py() or ""
            if last:
                yield *last, text
            last = (doc, text) if kind == 0 else None


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Runs of rows, each row's next text the following row's own."""
    group, size = [], 0
    for r in rows:
        if group and group[-1][2] is not r[1]:        # another range begins
            yield group
            group, size = [], 0
        group.append(r)
        size += 2 * len(r[1]) + 50
        if size > CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def compare_neighbours() -> Callable:
    def run(stream):
        for group in _groups(_with_next(stream)):
            edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for _, t, n in group]
            k = len(group)
            own = sketches([t for _, t, _ in group] + [group[-1][2]] + edited)
            yield _batch(_PAIR_T, [
                (doc, len(t), hashlib.sha256(e.encode()).hexdigest(), _hex(own[i]), _hex(own[k + 1 + i]),
                 likeness(own[i], own[k + 1 + i]), likeness(own[i], own[i + 1]))
                for i, ((doc, t, n), e) in enumerate(zip(group, edited))])
    return run


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text (the last quarter replaced by the
    beginning of the next document, ascending id, the first after the last)
    and against that next document.

    The documents are dealt into id ranges and sorted within them; each range
    also gets a copy of the first document after it, so no order over the
    whole table is needed.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cuts = sorted({int(c) for c in rows.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.002)})
    keyed = rows.select(F.lit(0).alias("kind"), _range_of(F.col("doc_id"), cuts).cast("int").alias("pid"),
                        "doc_id", F.xxhash64("text").alias("tie"), "text")
    # the first document of each range: as many rows as ranges
    heads = keyed.groupBy("pid").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-2 ** 63)).alias("id"), "tie")).alias("head"))
    before = F.lag("pid").over(W.orderBy("pid"))
    last = F.max("pid").over(W.partitionBy())
    heads = heads.select(F.coalesce(before, last).alias("to"), "head.id", "head.tie")
    follow = (keyed.join(F.broadcast(heads.withColumnRenamed("tie", "h_tie")),
                         (F.coalesce("doc_id", F.lit(-2 ** 63)) == F.col("id")) & (F.col("tie") == F.col("h_tie")))
                   .select(F.lit(1).alias("kind"), F.col("to").alias("pid"), "doc_id", "tie", "text")
                   .dropDuplicates(["pid"]))
    return (keyed.unionByName(follow).repartition(n, "pid")
                 .sortWithinPartitions("pid", "kind", F.col("doc_id").asc_nulls_first(), "tie")
                 .select("kind", "doc_id", "text")
                 .mapInArrow(compare_neighbours(), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                             "edited_fingerprint string, near_edited double, near_next double"))
