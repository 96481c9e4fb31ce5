"""The pipeline's stages, each against a plain version on its own input."""
import collections

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from ledgerlake.llm import toxicity
from tests.conftest import SF01
from tests.llm.test_secrets import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs, out = spark.read.parquet(f"{SF01}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        out.append(docs)
        stage(spark, docs, SF01).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def test_stages_and_columns(steps):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard", "secrets", "mixing", "bpe"]
    assert all(s.columns == COLUMNS for s in steps[:5])
    assert steps[5].columns == ["doc_id", "n_tokens", "ids"]


def test_toxic_documents_go(spark, steps):
    scorer = toxicity.learn(steps[0], spark.read.parquet(f"{SF01}/labels.parquet"))
    rows = _rows(steps[0])
    score, _ = scorer.score([(r[1] or "").split() for r in rows])
    assert sorted(_rows(steps[1])) == sorted(r for r, s in zip(rows, score) if s < 0.5)


def test_one_of_each_group_stays(steps):
    rows = _rows(steps[1])
    def five(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    sets = {r[0]: five(r[1]) for r in rows}
    lists, root = collections.defaultdict(list), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    shared = collections.Counter((a, b) for m in lists.values() for k, a in enumerate(m) for b in m[k + 1:])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    want = sorted(i for i in sets if find(i) == i)
    assert sorted(r[0] for r in _rows(steps[2])) == want
    assert set(_rows(steps[2])) <= set(rows)


def test_secrets_are_masked(steps):
    before, after = ({r[0]: r for r in _rows(s)} for s in (steps[2], steps[3]))
    assert before.keys() == after.keys()
    masked = 0
    for i, r in after.items():
        assert not brute(r[1]) and r[4] == len(r[1])
        if brute(before[i][1]):
            masked += 1
            assert "[SECRET]" in r[1]
        else:
            assert r == before[i]
    assert masked > 3


def test_mix_is_near_its_targets(steps):
    words = lambda t: len((t or "").encode().split())
    size, got = collections.Counter(), collections.Counter()
    before, after = _rows(steps[3]), _rows(steps[4])
    for r in before:
        size[r[3]] += words(r[1])
    for r in after:
        got[r[3]] += words(r[1])
    assert set(after) <= set(before) and max(collections.Counter(after).values()) <= 3
    total, longest = sum(size.values()), max(words(r[1]) for r in before)
    weight = {s: 1 + k % 3 for k, s in enumerate(sorted(size))}
    free = dict(size)
    target = {}
    while free:
        left = total - sum(target.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * left / w > 3 * size[s]]
        if not over:
            target |= {s: weight[s] * left / w for s in free}
            break
        for s in over:
            target[s] = 3 * size.get(s)
            del free[s]
    assert all(abs(got[s] - t) <= longest for s, t in target.items())


def test_tokens_equal_the_library(steps):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = sorted((r[0], np.array(t.encode(r[1] or "", add_special_tokens=False).ids, "<u4").tobytes())
                  for r in _rows(steps[4]))
    got = steps[5].collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)


def test_repeats_nulls_and_empty(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "en", "a", 1)] * 3 + [(None, text, "en", None, 1)] * 2 + [(9, None, None, None, None)] * 2
    rows += [(1, "", "en", "a", 0), (2, f"token=abcdefgh {text[::-1]}", "en", "b", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = _rows(pipeline.drop_near_duplicates(spark, docs, SF01))
    assert sorted(map(str, kept)) == sorted(map(str, [rows[0], *rows[5:]]))
    masked = _rows(pipeline.mask_secrets(spark, docs, SF01))
    assert len(masked) == len(rows) and (2, f"[SECRET] {text[::-1]}", "en", "b", 57) in masked
    mixed = collections.Counter(map(str, _rows(pipeline.mix(spark, docs, SF01))))
    assert mixed and set(mixed) <= set(map(str, rows)) and not any("None, None, None" in r for r in mixed)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.filter("doc_id > 100"), SF01).count() == 0


def test_run(spark, steps):
    got = pipeline.run(spark, SF01)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[5].collect()))


def test_a_task_gives_freed_memory_back():
    """What a step's task freed does not stay with its worker: small blocks
    below a kept one go back to the system when the task ends."""
    import re

    from ledgerlake.llm.common import giving_back

    def held_mb():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) / 1024

    kept = []

    def run(stream):
        for n in stream:
            freed = [np.ones(2_000) for _ in range(n)]             # 16 kB each, from malloc's heap
            kept.append(np.ones(2_000))
            yield len(freed)
            del freed

    before = held_mb()
    assert list(giving_back(run)(iter([10_000]))) == [10_000]     # 160 MB
    assert held_mb() - before < 60
