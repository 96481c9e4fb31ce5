"""op12 and op13 against their SQL twins and plain versions on small cases."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import collocations, linededup
from ledgerlake.llm.common import shared_path
from ledgerlake.llm.queries import ORACLE, QUERIES
from tests.conftest import SF01
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", ["op12_line_dedup", "op13_collocations"])
def test_query_matches_sql(spark, name):
    info = compare(spark, duck(SF01), name, QUERIES[name], ORACLE[name], SF01)
    assert info["ok"], info


SPACE = " \t\n\x0b\x0c\r"
LONG = "a long line that comes back"


def _key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def _plain_lines(rows):
    """{doc_id: (n_lines, n_dropped, kept)} (rows with one id, one text each)."""
    first, last = {}, {}
    order = [(2**63 - 1 if i is None else i, i, t or "") for i, t in rows]
    for d, _, t in order:
        for line in t.split("\n"):
            k = _key(line)
            first[k], last[k] = min(first.get(k, d), d), max(last.get(k, d), d)
    out = []
    for d, i, t in order:
        lines = t.split("\n")
        kept = [x for x in lines if len(_key(x)) < 10 or first[_key(x)] == d]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


ROWS = [(1, f"{LONG}\nshort\n{LONG}\nunique one two three"), (2, f"  {LONG.upper()} \nshort\n"), (3, None), (4, ""),
        (5, f"\n\n{LONG}\x0b\n\n"), (-7, "été ÉTÉ été ÉTÉ\nkey of ten.\n"), (9, "été ÉTÉ été Été\nkey of ten"),
        (10, "ÉTÉ été été ÉTÉ"), (None, f"tail\n{LONG}"), (11, "\n".join([LONG, "x" * 50_000, "y"] * 50)),
        (12, "x" * 50_000), (13, "KEY OF TEN.\r"), (13, "KEY OF TEN.\r"), (14, LONG)]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("pos", F.lit(1)) \
        .withColumn("h", F.lit("clash")).withColumn("n_lines", F.lit("clash"))


@pytest.mark.parametrize("batches", [1, 5])
def test_lines_equal_plain(spark, batches):
    got = linededup.dedup_lines(_docs(spark, ROWS), batches=batches)
    assert sorted([tuple(r) for r in got.collect()], key=str) == _plain_lines(ROWS)
    docs = linededup.dedup_documents(_docs(spark, ROWS), batches=batches)
    assert docs.columns == _docs(spark, ROWS).columns
    want = {(i, t if t is None else k) for (i, _, _, k), (_, t) in
            zip(_plain_lines(ROWS), sorted(ROWS, key=lambda r: str((r[0], (r[1] or "").count("\n") + 1))))
            if i not in (None, 3)}
    assert {(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in (None, 3)} == want
    assert docs.filter("doc_id = 3 AND text IS NULL").count() == 1


def test_lines_of_an_empty_table_and_a_hot_line(spark):
    assert linededup.dedup_lines(_docs(spark, ROWS).limit(0)).count() == 0
    rows = [(i, f"{LONG}\nown line number {i}" if i % 3 else f"own line number {i}") for i in range(2000)]
    got = linededup.dedup_lines(_docs(spark, rows), batches=3)
    assert sorted([tuple(r) for r in got.collect()], key=str) == _plain_lines(rows)


def test_runs_are_levelled_and_a_replay_changes_nothing(spark):
    path = shared_path(spark, "runs-test")
    store = linededup.LineRuns(spark, path, fanout=2, buckets=4)
    docs = _docs(spark, [(i, f"line number {i % 7} of the batch\nonly in document {i}") for i in range(60)])
    lines = linededup.line_hashes(docs)
    seen = []
    for b in range(6):
        batch = lines.filter(f"_doc >= {10 * b} AND _doc < {10 * b + 10}")
        seen.append(store.add(batch).count())
    assert seen == [3] + [10] * 5
    levels = Counter(level for level, _ in store.runs())
    assert all(n <= 2 for n in levels.values()) and max(levels) == 2
    again = linededup.LineRuns(spark, path, fanout=2, buckets=4)          # a new session's view of the folder
    store.close()
    assert again.add(lines.filter("_doc < 10")).count() == 3              # replayed: the same decisions
    assert again.add(lines.filter("_doc >= 50")).count() == 10
    rows = [r for run in again.runs() for r in again.read(*run).filter("NOT known").select("h", "g").collect()]
    assert len(rows) == len(set(rows)) == 67
    again.close()


def test_a_run_is_joined_without_a_shuffle_of_it(spark):
    store = linededup.LineRuns(spark, shared_path(spark, "runs-plan"), buckets=8)
    lines = linededup.line_hashes(_docs(spark, ROWS))
    store.add(lines)
    run = store.read(*store.runs()[0])
    keys = lines.groupBy("h", "g").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keys.join(run, ["h", "g"], "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    store.close()


# ------------------------------------------------------------------- phrases
def _plain_phrases(rows, order, min_count, inside, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, order + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    inner = Counter()
    for (lang, p), a in cand.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inner[lang, p[i:i + size]] = max(inner[lang, p[i:i + size]], a)
    by = {}
    for (lang, p), a in cand.items():
        if inner[lang, p] and 100 * inner[lang, p] >= inside * a:
            continue
        score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, lo, hi, n[lang], -s) for lang, v in by.items()
            for i, (s, a, p, lo, hi) in enumerate(sorted(v)[:top])}


TEXTS = ([("en", "New York City is big. New York is old, new york city"), (None, "a b c d\ta b c d a b"), ("fr", None),
          ("fr", ""), ("en", "in new york city: the Été the été"), ("und", "a b c d")] * 6
         + [("en", "hot words here " * 3000), ("de", "einmal"), ("en", "new york")])


@pytest.mark.parametrize("order,inside", [(2, 50), (3, 50), (4, 80)])
def test_phrases_equal_plain(spark, order, inside):
    docs = spark.createDataFrame(TEXTS, "lang string, text string").withColumn("phrase", F.lit("clash"))
    got = collocations.collocations(docs, order=order, min_count=5, inside_percent=inside, top=6)
    assert {tuple(r) for r in got.select("group", "rank", "phrase", "a", "l", "r", "n", "score").collect()} \
        == _plain_phrases(TEXTS, order, 5, inside, 6)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    from ledgerlake.llm.collocations import _exact
    big = 4_000_000_000_000
    row = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long").select(F.call_function(
        "div", F.lit(1_000_000).cast("decimal(7,0)") * (_exact("a") * _exact("a")), _exact("l") * _exact("r"))).first()
    assert row[0] == 1_000_000 * big * big // (big * (big + 1))


def test_long_texts_are_cut_between_words(monkeypatch):
    """Word numbers and windows do not depend on where a text is cut, and the
    sorting ways of counting agree."""
    from collections import defaultdict
    from itertools import count

    import numpy as np
    text = ("a bb.ccc d\te " * 40 + "x" * 300 + ",Y z\n" + "é É;no-space,at,all " * 9).encode()

    def ids(chunk):
        monkeypatch.setattr(collocations, "CHUNK", chunk)
        vocab = defaultdict(count().__next__)
        vocab[b"\xff"]
        return np.concatenate(list(collocations._word_ids(text, vocab)))

    whole = ids(1 << 21)
    for chunk in (1, 7, 100):
        assert (ids(chunk) == whole).all()
    cols = collocations._lead_columns(whole, 3)
    packed, n = collocations._sum_equal(cols, None, int(whole.max()) + 1)
    sorted_way, m = collocations._sum_equal(cols, None, 1 << 30)
    weighted, w = collocations._sum_equal(cols, np.full(len(cols[0]), 2), int(whole.max()) + 1)
    assert (n == m).all() and (w == 2 * n).all() and n.sum() == (whole != 0).sum()
    assert all((a == b).all() and (a == c).all() for a, b, c in zip(packed, sorted_way, weighted))
