"""op11: whitening against numpy on all rows."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import whitening
from ledgerlake.llm.queries import QUERIES
from tests.conftest import SF01


def _plain(rows, k=8):
    """{vec_id: (deviation, whitened)}, explained, from whole vectors at once."""
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = ((n * x - s) ** 2).sum(axis=1)
    xc = (x - np.array([t / n for t in s], dtype=object)).astype(float)
    cov = xc.T @ xc / n
    val, vec = np.linalg.eigh(cov)
    val, vec = val[::-1][:k], vec[:, ::-1][:, :k]
    return dev, xc @ vec / np.sqrt(val), val / np.trace(cov)


def test_query_equals_plain(spark):
    src = [(r.vec_id, list(r.embedding)) for r in
           spark.read.parquet(f"{SF01}/embeddings.parquet").orderBy("vec_id").collect()]
    dev, white, explained = _plain(src)
    got = {}
    for r in QUERIES["op11_whitening"](spark, SF01).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == len(src) and r.identity_error < 1e-9
    assert len(got) == len(src)
    y = np.array([[got[v][c].whitened for c in range(1, 9)] for v, _ in src])
    assert [got[v][1].deviation for v, _ in src] == [int(d) for d in dev]
    assert np.allclose([got[src[0][0]][c].explained for c in range(1, 9)], explained, rtol=1e-9)
    sign = np.sign((y * white).sum(axis=0))
    assert np.abs(y - white * sign).max() < 1e-8
    assert np.abs(np.cov(y.T, bias=True) - np.eye(8)).max() < 1e-9


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, component int")


def test_cases(spark):
    rng = np.random.default_rng(3)
    base = [(i, [float(v) for v in rng.normal(size=3)], "x", 7) for i in range(30)]
    hot = [(100 + i, [0.5, 0.25, -1.0], "x", 7) for i in range(300)]           # one vector is most of the rows
    odd = [(900, None, "", 1), (901, [], "", 1), (902, [1.0, None, 2.0], "", 1), (903, [1.0, float("nan"), 2.0], "", 1),
           (904, [float("inf"), 0.0, 0.0], "", 1), (905, [1.0, 2.0], "", 1)]
    extra = [(None, [0.1, 0.2, 0.3], None, None), (5, [0.7, 0.2, 0.3], None, None)]  # NULL id, repeated id
    rows = base + hot + extra
    out = whitening.whiten(_frame(spark, rows + odd)).collect()
    assert len(out) == 3 * len(rows)
    dev, white, _ = _plain([(r[0], np.float32(r[1])) for r in rows])
    assert sorted(int(r.deviation) for r in out if r.component == 1) == sorted(int(d) for d in dev)
    first = np.array(sorted(r.whitened for r in out if r.component == 1))
    assert min(np.abs(first - np.sort(white[:, 0])).max(), np.abs(first - np.sort(-white[:, 0])).max()) < 1e-8
    same = {round(r.whitened, 12) for r in out if r.vec_id and r.vec_id >= 100 and r.component == 2}
    assert len(same) == 1
    # each distinct vector once: the copies weigh as one
    once = whitening.whiten(_frame(spark, rows), weights="one").filter("component = 1")
    distinct = {tuple(np.float32(r[1])): r for r in rows}
    dev1, _, _ = _plain([(0, v) for v in distinct])
    got = {int(r.deviation) for r in once.collect()}
    assert got == {int(d) for d in dev1} and once.count() == len(rows)
    with pytest.raises(ValueError):
        whitening.whiten(_frame(spark, rows), weights="two")


def test_degenerate_tables(spark):
    assert whitening.whiten(_frame(spark, [])).count() == 0
    assert whitening.whiten(_frame(spark, [(1, None, "", 1)])).count() == 0
    assert whitening.whiten(_frame(spark, [(i, [1.0, 2.0], "", 1) for i in range(5)])).count() == 0
    flat = whitening.whiten(_frame(spark, [(i, [float(i), 2.0, 3.0], "", 1) for i in range(5)]))   # rank one
    assert [r.component for r in flat.collect()] == [1] * 5
    huge = whitening.whiten(_frame(spark, [(1, [1e30, 0.0], "", 1), (2, [-1e30, 0.0], "", 1), (3, [0.0, 0.0], "", 1)]))
    x = [2**52 + 100000, -(2**52) + 100000, 100000]
    want = sorted((3 * v - sum(x)) ** 2 for v in x)
    assert sorted(int(r.deviation) for r in huge.collect()) == want                # past 64 bits, exact
    assert huge.filter(F.abs("identity_error") > 1e-9).count() == 0
