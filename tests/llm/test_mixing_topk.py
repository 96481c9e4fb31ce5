"""Source mixing and exact top-k against plain versions."""
import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing, queries, topk
from ledgerlake.llm.mixing import mix_sources
from ledgerlake.llm.topk import exact_topk, quantise
from tests.conftest import SF01
from tests.oracle import compare, duck

DOCS = "doc_id long, text string, source string, taken int, size int, sid string"


@pytest.mark.parametrize("name", ["op6_source_mix", "op8_exact_topk"])
def test_query_matches_sql(spark, name):
    info = compare(spark, duck(SF01), name, queries.QUERIES[name], queries.ORACLE[name], SF01)
    assert info["ok"], info


def _targets(sizes):
    """Rounds of resharing, as the contract words them."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        w = sum(weight[s] for s in open_) or 1
        t = {s: weight[s] * (total - sum(full.values())) / w for s in open_}
        over = [s for s in open_ if t[s] > 3 * sizes[s]]
        if not over:
            return {**full, **t}
        full |= {s: 3 * sizes[s] for s in over}


def test_mix_targets_and_limits(spark):
    rows = [(i, "w " * (i % 50), ["hot", "hot", "b", None, "", "é"][i % 6], 1, 2, "x") for i in range(3000)]
    rows += [(None, "w w", "tiny", 1, 2, None), (5, None, "nul", 1, 2, None)] + [(9, "w w w", "b", 1, 2, None)] * 40
    df = spark.createDataFrame(rows, DOCS)
    got = mix_sources(df, block_tokens=64).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    want, taken = _targets(sizes), collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(want[r.source])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1, s
    again = mix_sources(df.repartition(5), block_tokens=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def _mixed_rows(n=4000):
    return [(i, "w " * (1 + i * 7 % 90), ["a", "b", "b", "b", "c", None][i % 6], 1, 2, "x") for i in range(n)]


def test_schedule_keeps_every_stretch_near_the_targets(spark):
    lined, targets = mixing.lay_out(spark.createDataFrame(_mixed_rows(), DOCS))
    pieces = mixing.mix_schedule(lined, targets, block_tokens=64).toPandas()
    quota = {r.sid: r.quota for r in targets.collect()}
    total = sum(quota.values())
    pieces["words"] = pieces["to_word"] - pieces["from_word"]
    assert (pieces["words"] > 0).all() and dict(pieces.groupby("sid")["words"].sum()) == quota
    by_slot = pieces.groupby(["slot", "sid"])["words"].sum().reset_index()
    assert by_slot["slot"].is_unique and (by_slot["words"] <= 64).all()
    slots, seen = by_slot.sort_values("slot"), 0
    assert len(slots) > 2000
    for a in range(0, len(slots) - 1000, 250):
        part = slots.iloc[a:a + 1000].groupby("sid")["words"].sum()
        for sid, q in quota.items():
            assert abs(part.get(sid, 0) / part.sum() - q / total) < 0.01
        seen += 1
    assert seen > 4


def test_another_schedule_gives_another_result(spark, monkeypatch):
    df = spark.createDataFrame(_mixed_rows(600), DOCS)
    key = lambda r: (r.doc_id, r.taken, r.first_slot)
    before = sorted(map(key, mix_sources(df, block_tokens=64).collect()))
    real = mixing.slot_schedule
    monkeypatch.setattr(mixing, "slot_schedule", lambda *a: real(*a).withColumn("slot", F.col("slot") + 5))
    assert [(i, t, s and s - 5) for i, t, s in map(key, sorted(mix_sources(df, block_tokens=64).collect(), key=key))] \
        == [(i, t, s) for i, t, s in before]
    monkeypatch.setattr(mixing, "slot_schedule", lambda *a: real(*a).filter("block != 1"))   # one slot a source left out
    got = mix_sources(df, block_tokens=64).collect()
    assert sum(t for _, t, _ in before) - sum(r.taken for r in got) == 64 * 4


def test_documents_come_in_the_order_of_the_schedule(spark):
    rows = _mixed_rows(900) + [(7, "same words here", "b", 1, 2, "x")] * 300
    rows += [(8, "nul", None, 1, 2, None), (8, None, "nul", 1, 2, None), (None, "nul", None, 1, 2, None)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.take_documents(df, block_tokens=64).collect()
    mixed = mix_sources(df, block_tokens=64).collect()
    want = collections.Counter()
    for r in mixed:
        want[(r.doc_id, r.source, r.size)] += int(r.taken / max(r.size, 1) + 0.5)
    got = collections.Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out)
    assert got == +want
    slot = {r.doc_id: r.first_slot for r in mixed}
    once = [r.doc_id for r in out if r.doc_id not in (None, 7, 8) and want[(r.doc_id, r.source, len((r.text or "").split()))] == 1]
    assert len(once) > 50 and [slot[i] for i in once] == sorted(slot[i] for i in once)


def test_mix_empty(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    assert [r.taken for r in mix_sources(spark.createDataFrame(
        [(1, None, None, 1, 1, None)], DOCS)).collect()] == [0]


def _brute(vectors, k):
    out = []
    for qi, q in vectors:
        if qi % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors if i != qi)[:k]
            out += [(qi, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_topk_ties_nulls_and_shards(spark, shard_rows):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 64]) for i in range(150)]
    rows += [(200 + i, [0.0] * 6) for i in range(30)] + [(300, []), (320, [1.0])]
    bad = [(400, None), (420, [None, 1.0]), (440, [float("nan")]), (460, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad],
                               "vec_id long, embedding array<float>, score int, rank int")
    v = quantise(df)
    got = sorted(map(tuple, exact_topk(v, v.filter("vec_id % 20 = 0"), 5, shard_rows, 3).collect()))
    assert got == _brute([(i, [int(np.floor(64 * np.float32(x))) for x in e]) for i, e in rows], 5)


def test_topk_hot_id_and_hot_vector(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-9, 10, 5)]) for i in range(60)]
    rows += [(7, [9] * 5)] * 400 + [(7, [int(x), 9, 9, 9, 9]) for x in rng.integers(0, 9, 200)]
    rows += [(1000 + i, [8] * 5) for i in range(300)]                    # one vector, many ids
    df = spark.createDataFrame([(i, [x / 64 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    v = quantise(df)
    got = sorted(map(tuple, exact_topk(v, v.filter("vec_id % 20 = 0"), 25, 50, 3).collect()))
    asks = {}
    for i, x in rows:
        if i % 20 == 0:
            asks[i] = min(asks.get(i, x), x)
    want = []
    for i, q in asks.items():
        s = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in rows if j != i)[:25]
        want += [(i, n + 1, j, -y) for n, (y, j) in enumerate(s)]
    assert got == sorted(want)


@pytest.mark.parametrize("dense", [0, 0.3, 2])
def test_topk_probes_equal_products(monkeypatch, dense):
    monkeypatch.setattr(topk, "DENSE", dense)
    rng = np.random.default_rng(8)
    q, x = rng.integers(-60, 60, (30, 16)).astype(float), rng.integers(-60, 60, (500, 16)).astype(float)
    ids, q_ids = np.arange(500), np.arange(30)
    theta = topk.first_thresholds(q, q_ids, x[:100], ids[:100], 10)
    a, b, s = topk.maxscore(q, q_ids, theta[:-1] + [None], x, ids, 10)
    for i in range(30):
        want = sorted((-int(v), j) for j, v in enumerate(x @ q[i]) if j != i)[:10]
        assert [(-v, j) for v, j in zip(s[a == i].tolist(), b[a == i].tolist())] == want


def test_topk_large_components_and_empty(spark):
    big = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1.0, 1.0]), (2, [1e6, 3.0])], "vec_id long, embedding array<double>")
    v = quantise(big)
    got = [(r.vec_id, r.score) for r in exact_topk(v, v.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(2, 64 * 10**9 * 64 * 10**6 + 64 * 192), (1, 64 * 10**9 * 64 + 4096)]
    none = v.filter("vec_id < 0")
    assert exact_topk(none, none).count() == 0
    assert exact_topk(v.filter(F.col("vec_id") == 0), v.filter("vec_id = 0")).count() == 0
