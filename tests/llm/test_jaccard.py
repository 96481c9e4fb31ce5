"""The Jaccard join against all pairs; components against a plain union."""
import collections
import random
import re

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import jaccard, queries
from ledgerlake.llm.components import connected_components
from tests.conftest import SF01

SCHEMA = "doc_id long, text string, node long, n int, h int, a string"


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)])


def plain_components(docs):
    """[(doc_id, size, component)] by testing every pair that shares a shingle."""
    sets = [plain_set(t) for _, t in docs]
    classes = {s: i for i, s in enumerate(dict.fromkeys(sets)) if s}
    group = {s: {i} for s, i in classes.items()}
    lists = collections.defaultdict(list)
    for s in classes:
        for x in s:
            lists[x].append(s)
    shared = collections.Counter()
    for m in lists.values():
        for i, s in enumerate(m):
            for o in m[:i]:
                shared[o, s] += 1
    for (s, o), n in shared.items():
        if 100 * n >= 85 * (len(s) + len(o) - n) and group[s] is not group[o]:
            joined = group[s] | group[o]
            back = {i: k for k, i in classes.items()}
            for i in joined:
                group[back[i]] = joined
    least = {}
    for (d, _), s in zip(docs, sets):
        if s and d is not None:
            k = min(group[s])
            least[k] = min(d, least.get(k, d))
    return sorted(((d, len(s), least.get(min(group[s])) if s else d) for (d, _), s in zip(docs, sets)), key=str)


def _got(members):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in members.collect()), key=str)


def test_query_on_all_documents(spark):
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{SF01}/documents.parquet')").fetchall()
    want = plain_components(docs)
    assert _got(queries.op4_ngram_jaccard(spark, SF01)) == want
    assert sum(d != c for d, _, c in want) > 20


def _edited(base, k, rng):
    w = base.split()
    for i in rng.sample(range(len(w)), k):
        w[i] = f"e{rng.randrange(10**9)}"
    return " ".join(w)


def _planted():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for size in (40, 150, 400):                       # groups of near copies of all degrees
        base = " ".join(word() for _ in range(size))
        texts += [_edited(base, rng.randrange(0, max(2, size // 14)), rng) for _ in range(70)] + [base] * 3
    passage = " ".join(word() for _ in range(60))     # a passage in many unlike documents
    texts += [" ".join(word() for _ in range(rng.randrange(20, 200))) + " " + passage for _ in range(150)]
    chain = [word() for _ in range(120)]              # a chain of links, its ends unlike
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[6:] + [word() for _ in range(6)]
    texts += ["a b c", "A  B\tc", "a b", "x", "X", "x y z q", "x y z q r", "é É", "Σ σ"]
    texts += [None, "", " \n\t", "a b c d e", "a b c d e"]
    return texts


@pytest.mark.parametrize("held, block", [(50_000, 1024), (3, 20)])
def test_planted_groups(spark, held, block, monkeypatch):
    monkeypatch.setattr(jaccard, "HELD_ROWS", held)
    monkeypatch.setattr(jaccard, "LIST_ROWS", block)
    texts = _planted()
    ids = [i * 3 % 1009 for i in range(len(texts))]
    docs = [(None if i % 41 == 5 else i, t) for i, t in zip(ids, texts)] + [(7, "w1 w2 w3 w4"), (7, "w1 w2 w3 w4"), (7, "other")]
    df = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in docs], SCHEMA).repartition(3)
    members, links = jaccard.near_duplicates(df)
    assert _got(members) == plain_components(docs)
    assert links.filter("a = b").count() == 0


def test_long_text_and_empty(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    docs = [(1, long), (2, long + " tail"), (3, long[:len(long) // 2])]
    members, _ = jaccard.near_duplicates(spark.createDataFrame([(i, t, 1, 1, 1, "") for i, t in docs], SCHEMA))
    assert _got(members) == plain_components(docs)
    members, links = jaccard.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert members.collect() == [] and links.collect() == []


def test_probe_and_heads_never_lose_a_link():
    rng = np.random.default_rng(4)
    long = np.packbits(rng.random(1 << jaccard.COUNTERS_LOG2) < 0.3)
    near = 0
    for _ in range(400):
        x = np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64) * np.uint64(2))
        keep = rng.random(len(x)) < rng.choice([0.3, 0.85, 0.9, 0.95, 1.0])
        y = np.unique(np.append(x[keep], rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64)))
        if not len(y):
            continue
        both = len(np.intersect1d(x, y))
        linked = 100 * both >= 85 * (len(x) + len(y) - both)
        near += linked
        assert jaccard.reaches(x.tobytes(), y.tobytes(), 85) == linked
        differ = sum(((a ^ b) & 2**64 - 1).bit_count() for a, b in zip(jaccard.signature(x), jaccard.signature(y)))
        assert differ <= len(np.setxor1d(x, y))
        if linked:
            assert jaccard.heads_allow(jaccard.head(x, long, 85), jaccard.head(y, long, 85), 85)
    assert near > 50


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(280)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(100)] + [(9, 9)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def plain_links(docs):
    """Linked pairs of sets, by testing all pairs; each row's number of other
    texts that its text is linked with."""
    texts = {t: plain_set(t) for _, t in docs}
    sets = [s for s in dict.fromkeys(texts.values()) if s]
    copies = collections.Counter(texts.values())
    links, number = 0, {s: copies[s] - 1 for s in sets}
    for i, s in enumerate(sets):
        for o in sets[:i]:
            n = len(s & o)
            if 100 * n >= 85 * (len(s) + len(o) - n):
                links += 1
                number[s] += copies[o]
                number[o] += copies[s]
    return links, collections.Counter((d, number.get(texts[t], 0)) for d, t in docs)


@pytest.mark.parametrize("rows", [256, 7])
def test_all_links(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", rows)  # 7: bands, blocks and pairs of them
    monkeypatch.setattr(jaccard, "COLUMNS", 4096 if rows == 256 else 50)
    rng, base = random.Random(9), " ".join(f"v{i}" for i in range(200))
    docs = list(enumerate(_planted() + [_edited(base, 1 + i % 4, rng) for i in range(60)])) + [(None, "w1 w2 w3 w4"), (7, "W1 w2  w3 w4")]
    members, links = jaccard.near_duplicates(spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in docs], SCHEMA).repartition(3))
    got = [(r.a, r.b) for r in links.collect()]
    n, number = plain_links(docs)
    assert len(got) == len(set(got)) == n > 500 and all(a != b for a, b in got)
    assert collections.Counter((r.doc_id, r.n_links) for r in members.collect()) == number


def test_overlaps():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64)) for _ in range(9)] + [np.array([10**6], np.uint64)]
    assert jaccard.overlaps(sets, 4).tolist() == [[len(np.intersect1d(a, b)) if a is not b else int((np.isin(a, np.concatenate(
        [x for x in sets if x is not a]))).sum()) for b in sets] for a in sets[:4]]
