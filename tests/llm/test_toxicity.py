"""The random field against enumeration; held-out accuracy; cases."""
import itertools

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import queries, toxicity
from tests.conftest import SF01

DOCS = "doc_id long, text string, score double, toxic string, spans int"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    moves = rng.normal(size=4)
    sizes = [1, 2, 5, 7, toxicity.SEQUENCE + 3]
    e = [rng.normal(size=n) for n in sizes]
    cell, mask = toxicity.sequences(sizes)
    flat = np.full(mask.size, -30.0)
    flat[cell] = np.concatenate(e)
    p, pairs = toxicity.marginals(flat.reshape(mask.shape), mask, moves)
    got = np.split(p.ravel()[cell], np.cumsum(sizes)[:-1])
    want_pairs = np.zeros(4)
    parts = [(x[:toxicity.SEQUENCE], g[:toxicity.SEQUENCE]) for x, g in zip(e[:4], got[:4])]
    parts.append((e[4][toxicity.SEQUENCE:], got[4][toxicity.SEQUENCE:]))     # the second sequence of a text
    for x, g in parts:
        paths = list(itertools.product((0, 1), repeat=len(x)))
        w = np.array([np.exp(sum(a * b for a, b in zip(s, x)) + sum(
            moves[2 * a + b] for a, b in zip(s, s[1:]))) for s in paths])
        w /= w.sum()
        assert g == pytest.approx(w @ np.array(paths, float))
        for s, q in zip(paths, w):
            for a, b in zip(s, s[1:]):
                want_pairs[2 * a + b] += q
    assert pairs.sum() == pytest.approx(sum(n - 1 for n in sizes[:4]) + 63 + 2)
    cell, mask = toxicity.sequences([len(x) for x, _ in parts])
    flat = np.full(mask.size, -30.0)
    flat[cell] = np.concatenate([x for x, _ in parts])
    assert toxicity.marginals(flat.reshape(mask.shape), mask, moves)[1] == pytest.approx(want_pairs)


def test_greedy_words_ignore_what_copies_share():
    y = np.array([1.0] * 40 + [0.0] * 200)
    docs = [{"bad1", f"x{i}"} if i < 25 else {"bad2", "bad1", "copied", "along"} for i in range(40)]
    docs += [{f"y{i}", "the"} for i in range(200)]
    assert toxicity.toxic_words(docs, y, 0.01, 8.0, enough=1) == {"bad1"}
    many = [{"bad1", "bad2"} for _ in range(30)] + [{"bad1", "bad2", "copied", "along"} for _ in range(10)]
    assert toxicity.toxic_words(many + docs[40:], y, 0.01, 8.0, enough=2) == {"bad1", "bad2"}


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op7_toxicity(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from read_parquet('{sf}/labels.parquet')").fetchall()
    assert len(got) == duckdb.sql(f"select count(*) from read_parquet('{sf}/documents.parquet')").fetchall()[0][0]
    held = [(got[i], t) for i, t in labels if got[i].held_out]
    assert np.mean([r.predicted == t for r, t in held]) > 0.97
    toxic = [r.predicted for r, t in held if t]
    assert np.mean(toxic) > 0.85 and len(toxic) > 50
    assert np.mean([r.predicted for r, t in held if not t]) < 0.02


def _corpus():
    good = [f"calm words number{i % 13} here all quiet today {i}" for i in range(200)]
    bad = [f"calm you zorgling{'abcdef'[i % 6]} words number{i % 13} zorgling{'abcdef'[(i + 1) % 6]} here {i}" for i in range(60)]
    docs = [(i, t) for i, t in enumerate(good + bad)]
    labels = [(i, None, int(i >= 200)) for i in range(260)]
    return docs, labels


def test_spans_and_cases(spark):
    docs, labels = _corpus()
    d = spark.createDataFrame([(i, t, 0.0, "", 1) for i, t in docs], DOCS)
    lab = spark.createDataFrame(labels + [(3, None, None), (None, None, 1)], "doc_id long, quality int, toxic int")
    scorer = toxicity.learn(d, lab)
    asks = [(1, "quiet 😀 words, Zorglingb! here zorglinga"), (2, "calm words here"), (3, None), (4, ""), (None, "quiet"),
            (5, "quiet words " * 50_000), (6, "zorglingc zorglingd"), (6, "zorglingc zorglingd")]
    got = toxicity.score_texts(spark.createDataFrame([(i, t, 0.0, "", 1) for i, t in asks], DOCS), scorer).collect()
    assert len(got) == len(asks)
    by = {r.doc_id: r for r in got}
    assert by[1].score >= 0.5 and [(s.start, s.end) for s in by[1].spans] == [(15, 25), (31, 40)]
    assert by[6].score >= 0.5 and by[2].score < 0.5 and by[5].score < 0.5
    assert by[3].score == by[4].score < 0.5 and by[None].n_toxic == 0
    assert toxicity.score_texts(d.filter("doc_id < 0"), scorer).collect() == []


@pytest.mark.parametrize("keep,want", [("toxic = 0", 0.0), ("toxic = 1", 1.0), ("toxic > 5", 0.0)])
def test_one_sided_labels(spark, keep, want):
    docs, labels = _corpus()
    d = spark.createDataFrame([(i, t, 0.0, "", 1) for i, t in docs], DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").filter(keep)
    assert {r.score for r in toxicity.score_texts(d, toxicity.learn(d, lab)).collect()} == {want}
