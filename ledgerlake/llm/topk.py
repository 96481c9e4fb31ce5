"""Exact top-k inner products by MaxScore over sharded postings.

Dimensions are the terms; a vector's component is its impact in that
dimension's posting list.  The candidates are hashed into shards of bounded
size, the queries into blocks; every (query block, shard) pair is one group.
Each query starts with a threshold that all its shards share: its k-th best
score among SEEDS vectors.  Inside a shard, each query's terms are split by
their score bounds: the essential terms are traversed over all postings (for
a block of queries at once, as one product), the others (whose bounds
together cannot lift a vector over the threshold by themselves) are probed
only for vectors that can still reach the threshold: pair by pair, or as one
product for queries to which a large share of the shard is competitive.  A
shard returns at most k rows a query; these lists are merged per query.

Defined cases: vectors that are NULL, or hold NULL or non-finite components,
and rows without an id take no part; a missing trailing component counts as
0; an empty vector scores 0 with all; ties go to the smaller id; rows that
share a query's id are not its candidates, and a repeated query id counts
once (its least vector); scores must fit a long; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Vectors scored in full to give each query its first threshold, and the
#: share of a shard's vectors from which on a query's probes are one product.
#: Both steer the cost only; any values give the same results.
SEEDS, DENSE = 2048, 1 / 16


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, valid rows only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("e"))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~F.exists("e", bad))
                .select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("v")))


def _matrix(rows, dims: int, exact_double: bool) -> np.ndarray:
    out = np.zeros((len(rows), dims), float if exact_double else object)
    if exact_double and len(rows) and all(len(r) == dims for r in rows):
        return np.stack(rows, out=out, casting="unsafe")
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def first_thresholds(queries: np.ndarray, q_ids: np.ndarray, seeds: np.ndarray, ids: np.ndarray, k: int) -> list:
    """Each query's ``k``-th best score among the seeds; None if they are fewer."""
    out = []
    for qid, scores in zip(q_ids, queries @ seeds.T):
        scores = np.sort(scores[ids != qid])
        out.append(int(scores[-k]) if len(scores) >= k else None)
    return out


def maxscore(queries: np.ndarray, q_ids: np.ndarray, theta: list, shard: np.ndarray, ids: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query numbers, vector numbers, scores): each query's ``k`` best of
    the shard that reach its threshold ``theta``."""
    least, most = queries * shard.min(axis=0), queries * shard.max(axis=0)
    bound, low = np.maximum(least, most), np.minimum(least, most)     # of what a term adds in this shard
    known = np.array([t is not None for t in theta])
    theta = np.array([0 if t is None else t for t in theta], queries.dtype)
    # least spread first: the longest tail of terms whose bounds stay below the threshold is probed
    order = np.argsort(bound - low, axis=1, kind="stable")
    tail = np.cumsum(np.take_along_axis(np.maximum(bound, 0), order, 1), axis=1)
    probed = np.empty(queries.shape, bool)
    np.put_along_axis(probed, order, ((tail < np.maximum(theta, 0)[:, None]) & known[:, None]).astype(bool), 1)
    score = np.where(probed, 0, queries) @ shard.T                    # essential postings, all traversed
    rest = np.where(probed, bound, 0).sum(axis=1)
    live = (score >= (theta - rest)[:, None]).astype(bool) | ~known[:, None]
    probes = np.where(probed, queries, 0)
    dense = live.mean(axis=1) > DENSE
    score[dense] += probes[dense] @ shard.T
    live[dense] &= (score[dense] >= theta[dense][:, None]).astype(bool) | ~known[dense][:, None]
    q, v = np.nonzero(live)
    value = score[q, v]
    for a in range(0, len(q), 1 << 16):                               # the others pair by pair
        some = np.flatnonzero(~dense[q[a:a + (1 << 16)]]) + a
        value[some] += (probes[q[some]] * shard[v[some]]).sum(axis=1)
    good = (ids[v] != q_ids[q]) & ((value >= theta[q]).astype(bool) | ~known[q])
    q, v, value = q[good], v[good], value[good].astype(np.int64)
    best = np.lexsort((ids[v], -value, q))
    q, v, value = q[best], v[best], value[best]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], v[rank < k], value[rank < k]


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = 8192,
               block_rows: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of each query.

    ``vectors`` and ``queries`` come from ``quantise``.  The numbers of
    shards and blocks follow the row counts, so a group stays bounded.
    """
    n, dims, big = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.array_max(
        F.transform("v", lambda x: F.abs(x))))).first()
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    m = queries.count()
    exact_double = (big or 0) ** 2 * (dims or 0) < 2 ** 53      # else Python integers
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(m / block_rows))
    dims = max(dims or 1, 1)
    some = vectors.orderBy(F.xxhash64("vec_id", F.lit(0)), "vec_id", "v").limit(SEEDS).collect()
    seeds = _matrix([r.v for r in some], dims, exact_double)
    seed_ids = np.array([r.vec_id for r in some], np.int64)

    def thresholds(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for a in range(0, len(p), 1024):
                q = p.iloc[a:a + 1024]
                found = first_thresholds(_matrix(q["v"], dims, exact_double), q["vec_id"].to_numpy(), seeds, seed_ids, k)
                yield q.assign(theta=pd.array(found, dtype="Int64"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        none = np.empty(0, np.int64)
        q, v, score = maxscore(
            _matrix(left["v"], dims, exact_double), q_ids, [None if pd.isna(t) else int(t) for t in left["theta"]],
            _matrix(right["v"], dims, exact_double), ids, k) if len(left) and len(right) else (none, none, none)
        return pd.DataFrame({"query_id": q_ids[q].astype(np.int64), "vec_id": ids[v].astype(np.int64), "score": score})

    place = lambda mod, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(mod)).cast("int")
    # a hot id is dealt by its vectors, and of equal rows no more than k can be hits
    copies = vectors.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    c = (copies.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
               .withColumn("block", F.explode(F.flatten(F.array_repeat(
                   F.sequence(F.lit(0), F.lit(blocks - 1)), F.col("copies"))))).drop("copies"))
    q = (queries.mapInPandas(thresholds, "vec_id long, v array<long>, theta long")
                .withColumn("block", place(blocks, 2))
                .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    hits = (q.groupBy("shard", "block").cogroup(c.groupBy("shard", "block"))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
