"""Language identification with bit-sliced Bloom filters of n-grams.

Every slot of the filter holds a bitmask of languages; the AND of an n-gram's
slots gives all languages whose n-gram set holds it at once.  A text's
popcounts per language, corrected for each language's false-positive rate,
decide.  A language's set holds the n-grams that are at least SHARE as
frequent in it as in the language that uses them most.

Training reads at most ``per_language`` documents of each language (chosen by
hash among the rows that are not held out); prediction reads whole texts and
nothing else.

Defined cases: NULL text and text without a letter give ``und`` and score 0;
ties go to the language first in code-point order; rows without a language
teach nothing; with nothing to learn from every answer is ``und``; an empty
table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import _batch
from .common import batches, cut, held_out

#: n-gram lengths, slots (a power of two), hash functions and the share that
#: puts an n-gram into a language's set.
GRAMS, SLOTS, HASHES, SHARE = (3, 4), 1 << 20, 2, 0.3
CHARS = 400_000
_PRIMES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with one 0 for each run of other characters and
    around each text, and the index of each text's first symbol."""
    joined = "\0".join(t.lower() for t in texts)
    sizes = np.array([len(t.lower()) for t in texts]) + 1
    c = np.frombuffer(f"\0{joined}\0".encode("utf-32-le"), np.uint32)
    c = np.where(_letters()[c], c, 0)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] > 0) | (c[:-1] > 0)
    first = np.cumsum(sizes) - sizes                   # the 0 before each text
    keep[first] = True
    at = np.cumsum(keep) - 1
    return c[keep].astype(np.uint64), at[first]


def _grams(c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the n-grams without a gap inside."""
    size = len(c) - n + 1
    if size <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = c[:size] * np.uint64(_PRIMES[0])
    ok = np.ones(size, bool)
    for i in range(1, n):
        part = c[i:i + size]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(_PRIMES[i]) + part
        if i < n - 1:
            ok &= part > 0
    at = np.flatnonzero(ok)
    h = h[at]
    return at, h ^ (h >> np.uint64(32))


def _slots(h: np.ndarray, i: int) -> np.ndarray:
    return ((h * np.uint64(_PRIMES[i] | 1)) >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)


def _training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rank = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    some = (rows.join(F.broadcast(counts), "lang").withColumn("rank", rank)       # one row a language
                .filter(F.col("rank") * F.col("n") < 1.25 * per_language))        # thins before the shuffle
    best = W.partitionBy("lang").orderBy("rank", "doc_id")
    return some.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= per_language).select("lang", "text")


def _count_grams() -> Callable:
    fields = [("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())]

    def run(stream):
        for b in stream:
            rows = sorted(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            for lang in sorted({r[0] for r in rows}):
                for some in batches([t for x, t in rows if x == lang], len, CHARS):
                    c, _ = _symbols(some)
                    for n in GRAMS:
                        h, count = np.unique(_grams(c, n)[1].view(np.int64), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h),
                                                          pa.array(count, pa.int64())], [f for f, _ in fields])
    return run


def learn(docs: DataFrame, per_language: int = 2000) -> dict:
    """The filter: languages in code-point order, slot masks (one 64-bit plane
    per 64 languages) and false-positive rates.  Its size is SLOTS words a
    plane, whatever the corpus."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = cut(_training_rows(rows, per_language).mapInArrow(_count_grams(), "lang string, gram long, n long")
                 .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}   # one row a language
    langs = sorted(totals)
    planes = np.zeros((max(1, -(-len(langs) // 64)), SLOTS), np.uint64)
    if langs:
        table = docs.sparkSession.createDataFrame([(x, i, float(totals[x])) for i, x in enumerate(langs)],
                                                  "lang string, nr int, total double")
        share = counts.join(table, "lang").withColumn("share", F.col("n") / F.col("total"))
        most = W.partitionBy("gram")
        kept = (share.withColumn("most", F.max("share").over(most))
                     .filter((F.col("share") >= SHARE * F.col("most")) & (F.col("n") >= 2)))
        for plane in range(len(planes)):
            masks = (kept.filter(F.floor(F.col("nr") / 64) == plane)
                         .groupBy("gram").agg(F.bit_or(F.expr(f"shiftleft(1L, nr - {64 * plane})")).alias("mask")))
            got = masks.toArrow()                      # at most the n-grams of the bounded sample
            h = got["gram"].to_numpy().view(np.uint64)
            mask = got["mask"].to_numpy().view(np.uint64)
            for i in range(HASHES):
                np.bitwise_or.at(planes[plane], _slots(h, i), mask)
    rates = [float((planes[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()) ** HASHES for i in range(len(langs))]
    return {"langs": langs, "planes": planes, "rates": rates}


def predict_texts(texts: list[str], model: dict) -> list[tuple[str, float]]:
    langs, rates = model["langs"], np.array(model["rates"])
    c, first = _symbols(texts)
    hits, total = np.zeros((len(texts), len(langs))), np.zeros(len(texts))
    for n in GRAMS:
        at, h = _grams(c, n)
        cuts = np.searchsorted(at, first)              # a gap may only begin or end an n-gram
        total += np.diff(np.append(cuts, len(at)))
        for p, plane in enumerate(model["planes"]):
            mask = plane[_slots(h, 0)]
            for i in range(1, HASHES):
                mask &= plane[_slots(h, i)]
            for j in range(64 * p, min(64 * p + 64, len(langs))):
                run = np.concatenate([[0], np.cumsum((mask >> np.uint64(j % 64) & np.uint64(1)).astype(np.int32))])
                hits[:, j] += np.diff(run[np.append(cuts, len(at))])
    out = []
    for t, n, h in zip(texts, total, hits):
        if not n or not langs:
            out.append(("und", 0.0))
            continue
        est = (h - n * rates) / (1 - rates)
        best = int(np.argmax(est))
        out.append((langs[best], float(min(1.0, max(0.0, est[best] / n)))))
    return out


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # SLOTS words a plane
    fields = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]

    def run(stream):
        rows = ((i, t.as_py() or "") for b in stream for i, t in zip(b.column(0).to_pylist(), b.column(1)))
        for some in batches(rows, lambda r: len(r[1]) + 20, CHARS):
            yield _batch(fields, [(i, *p) for (i, _), p in zip(some, predict_texts([t for _, t in some], shared.value))])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(run, "doc_id long, lang_pred string, score double"))
