"""Embedding whitening through a weighted multiplicity covariance.

Vectors are rounded to integers, x = floor(scale * c) + offset, and identical
x are grouped with their multiplicity.  The fit weighs each distinct x by its
count, or by one.  Exact integer sums give the mean; a second pass multiplies
centred blocks, (w * (x - mean))^T (x - mean), one matrix a task; the sum's
eigenvectors (a dimension-sized matrix, the only thing the driver computes)
whiten each distinct x once, and the rows join back by x's 128-bit name.

Skew: copies of a vector collapse map-side, so a hot vector is one row in the
fit; in the join back the vectors with at least ``HOT_SHARE`` of the weight
(1 / ``HOT_SHARE`` of them at most) go by broadcast.

Cases: rows whose vector is NULL, empty, or holds a NULL or non-finite entry
go; so do vectors of another length than most have (ties: the longer).  Scaled
entries beyond +-2^52 are clamped there.  Components whose eigenvalue is zero
to double precision are left out, so a table of equal vectors, or an empty
one, gives no rows.  ``deviation`` is NULL from 10^38 on.  A NULL or repeated
id is a row like any other.  Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_path

CLAMP = float(2**52)
#: A distinct vector with at least this share of all rows is hot.
HOT_SHARE = 0.001
SMALL = 2**62
DEVIATION = pa.decimal128(38, 0)
SCHEMA = ("vec_id long, component int, n decimal(38,0), deviation decimal(38,0), whitened double, "
          "explained double, identity_error double")


def quantise(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024,
             offset: int = 100_000) -> DataFrame:
    """(vec_id, x, h, g) of the vectors that take part."""
    e = F.col(embedding)
    inf = F.lit(float("inf"))
    finite = F.forall(e, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < inf), F.lit(False)))
    sound = vectors.filter(e.isNotNull() & (F.size(e) > 0) & F.coalesce(finite, F.lit(False)))
    length = (sound.groupBy(F.size(e).alias("d")).agg(F.count(F.lit(1)).alias("c"))
                   .orderBy(F.desc("c"), F.desc("d")).first())
    x = F.transform(e, lambda c: F.floor(F.greatest(F.least(F.lit(float(scale)) * c.cast("double"), F.lit(CLAMP)),
                                                    F.lit(-CLAMP))).cast("long") + F.lit(offset).cast("long"))
    return (sound.filter(F.size(e) == (length["d"] if length else -1))
                 .select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
                 .select("vec_id", "x", *names(F.col("x"))))


def names(x: Column) -> list[Column]:
    return [F.xxhash64(x).alias("h"), F.xxhash64(F.lit("second"), x).alias("g")]


def _block(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pos, s, n): this task's weighted integer sums per dimension, exact."""
    total, n = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        x, w = _block(b, "x"), b.column("w").to_numpy()
        if int(np.abs(x).max()) * int(w.sum()) >= SMALL:
            x, w = x.astype(object), w.astype(object)
        part = (x * w[:, None]).sum(axis=0)
        total = [int(v) for v in part] if total is None else [a + int(v) for a, v in zip(total, part)]
        n += int(w.sum())
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(v) for v in total], DEVIATION),
             pa.array([n] * len(total), pa.int64())], ["pos", "s", "n"])


def _gram(column: str, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(pos, cells): the rows of this task's weighted centred product; the
        last row holds the weighted centred sums."""
        d = len(centre)
        total = np.zeros((d + 1, d))
        for b in batches:
            if b.num_rows:
                x, w = _block(b, column) - centre, b.column("w").to_numpy().astype(np.float64)
                total[:d] += (x * w[:, None]).T @ x
                total[d] += w @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()),
                                          pa.array(list(total), pa.list_(pa.float64()))], ["pos", "cells"])
    return run


def _add_rows(rows: pa.Table) -> pa.Table:
    """One matrix row from the tasks' rows of the same number."""
    cells = np.array(rows.column("cells").to_pylist())
    order = np.lexsort(cells.T)                    # the same sum whatever the order they came in
    return pa.table({"pos": pa.array([rows.column("pos")[0].as_py()], pa.int32()),
                     "cells": pa.array([cells[order].sum(axis=0)], pa.list_(pa.float64()))})


def centred_product(rows: DataFrame, column: str, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over rows of w * (x - centre)^T (x - centre), and of w * (x - centre);
    a task sends one matrix, whatever its rows."""
    schema = "pos int, cells array<double>"
    parts = rows.select(F.col(column), "w").mapInArrow(_gram(column, centre), schema)
    got = parts.groupBy("pos").applyInArrow(_add_rows, schema).orderBy("pos").collect()
    matrix = np.array([r["cells"] for r in got])
    return matrix[:-1], matrix[-1]


def _whiten(centre: np.ndarray, sums: list[int], n: int, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        largest = max(abs(s) for s in sums)
        for b in batches:
            if not b.num_rows:
                continue
            x = _block(b, "x")
            y = (x - centre) @ axes
            small = n * int(np.abs(x).max()) + largest < SMALL
            gap = n * x - np.array(sums) if small else n * x.astype(object) - np.array(sums, dtype=object)
            if int(np.abs(gap).max()) ** 2 * x.shape[1] >= SMALL:
                gap = gap.astype(object)
            square = [int(v) for v in (gap * gap).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [b.column("h"), b.column("g"), b.column("m"), b.column("w"),
                 pa.array([Decimal(v) if v < 10**38 else None for v in square], DEVIATION),
                 pa.array(list(y), pa.list_(pa.float64()))], ["h", "g", "m", "w", "deviation", "y"])
    return run


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024,
           offset: int = 100_000, components: int = 8, weights: str = "counts") -> DataFrame:
    """One row per vector and component, in falling order of variance:
    vec_id, component, n, deviation, whitened, explained, identity_error.

    ``weights`` is ``counts`` (the fit list is all vectors) or ``one`` (each
    distinct x once).  ``deviation`` is the exact sum over dimensions of
    (n*x - S)^2, ``identity_error`` the largest absolute entry of the fit
    list's whitened covariance minus the identity.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"unknown weights {weights!r}")
    spark = vectors.sparkSession
    rows = quantise(vectors, vec_id, embedding, scale, offset)
    path, out = shared_path(spark, "distinct-vectors"), shared_path(spark, "whitened")
    w = F.col("m") if weights == "counts" else F.lit(1).cast("long")
    rows.groupBy("x").agg(F.count(F.lit(1)).alias("m")).select("x", "m", w.alias("w"), *names(F.col("x"))) \
        .write.parquet(path)
    distinct = spark.read.parquet(path)
    total = distinct.select("x", "w").mapInArrow(_sums, "pos int, s decimal(38,0), n long").groupBy("pos") \
        .agg(F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n")).orderBy("pos").collect()
    empty = spark.createDataFrame([], SCHEMA)
    if not total:
        return empty
    n, sums = int(total[0]["n"]), [int(r["s"]) for r in total]
    centre = np.array([s / n for s in sums])                       # exact integers, rounded once
    product, rest = centred_product(distinct, "x", centre)
    cov = product / n - np.outer(rest / n, rest / n)               # rest is rounding only
    values, axes = np.linalg.eigh((cov + cov.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    k = int((values[:components] > len(values) * np.finfo(float).eps * max(values[0], 0)).sum())
    if not k:
        return empty
    explained = [float(v) for v in values[:k] / np.trace(cov)]
    distinct.mapInArrow(_whiten(centre, sums, n, axes[:, :k] / np.sqrt(values[:k])),
                        "h long, g long, m long, w long, deviation decimal(38,0), y array<double>").write.parquet(out)
    done = spark.read.parquet(out)
    mean = rest / n @ (axes[:, :k] / np.sqrt(values[:k]))
    unit, _ = centred_product(done.withColumnRenamed("y", "x"), "x", mean)
    error = float(np.abs(unit / n - np.eye(k)).max())
    # join back: hot vectors by broadcast, the others by their name
    copies = int(done.agg(F.sum("m")).first()[0])
    kept = done.select("h", "g", "m", "deviation", "y")
    hot = kept.filter(F.col("m") >= HOT_SHARE * copies).drop("m")
    met = rows.select("vec_id", "h", "g").join(F.broadcast(hot), ["h", "g"], "left")
    cold = met.filter("y IS NULL").select("vec_id", "h", "g").join(
        kept.filter(F.col("m") < HOT_SHARE * copies).drop("m"), ["h", "g"])
    every = met.filter("y IS NOT NULL").unionByName(cold)
    share = F.array(*[F.lit(v) for v in explained])
    return every.select("vec_id", "deviation", F.posexplode("y").alias("_i", "whitened")).select(
        "vec_id", (F.col("_i") + 1).alias("component"), F.lit(n).cast("decimal(38,0)").alias("n"), "deviation",
        "whitened", F.get(share, F.col("_i")).alias("explained"), F.lit(error).alias("identity_error"))
