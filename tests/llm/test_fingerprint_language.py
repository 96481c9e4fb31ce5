"""Locally consistent parsing against a plain version; language accuracy."""
import hashlib
import random

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import language, parsing, queries
from tests.conftest import SF01

SCHEMA = "doc_id long, text string, lang string, fingerprint string, kind int, pid int"
M = 2 ** 64 - 1


def _documents():
    return sorted(duckdb.sql(f"select doc_id, text from read_parquet('{SF01}/documents.parquet')").fetchall())


def _mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M
    return x ^ x >> 31


def plain_names(text):
    """The set of 32-bit names of a text, symbol by symbol."""
    s, out, level = [ord(c) for c in text], set(), 0
    while s and (level < parsing.LEVEL or len(s) > 1):
        level += 1
        runs = []
        for x in s:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        step = 0x9E3779B97F4A7C15
        s = [x if n == 1 else x + ((n - 1) % 2047 << 21) if level == 1 else _mix(x + n * step & M) for x, n in runs]
        label = s
        for _ in range(4):
            new = []
            for i, x in enumerate(label):
                d = x ^ label[i - 1] if i else 1
                bit = (d & -d).bit_length() - 1
                new.append(2 * bit + (x >> bit & 1))
            label = new
        assert max(label) < 6 and all(a != b for a, b in zip(label, label[1:]))
        cuts = [0] + [i for i in range(1, len(s) - 1) if label[i - 1] < label[i] > label[i + 1]] + [len(s)]
        odd = 0xD6E8FEB86659FD93
        s = [_mix(sum(x * pow(odd, j, M + 1) for j, x in enumerate(s[a:b])) + (b - a) + level * step & M)
             for a, b in zip(cuts, cuts[1:])]
        if level >= parsing.LEVEL:
            out |= {x >> 32 for x in s}
    return out


TEXTS = ["", "a", "ab", "aaaa" * 900, "abab" * 300, "é😀中" * 50, "hello world " * 3] + [
    "".join(random.Random(i).choice("abcde \n") for _ in range(i * 13)) for i in range(40)]


def test_sketches_equal_plain_parsing():
    got = parsing.sketches(TEXTS)
    for t, k in zip(TEXTS, got):
        assert k.tolist() == sorted(plain_names(t))[:parsing.SKETCH]
    assert all((parsing.sketches([t])[0] == k).all() for t, k in zip(TEXTS, got))     # batch plays no part


def test_equal_substrings_share_names():
    rng = random.Random(1)
    body = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    one, other = plain_names("xyz" + body), plain_names("q" * 17 + "longer head " + body + " tail")
    assert len(one & other) > 0.95 * len(one)


def _check(rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    assert len(rows) == len(got)
    for i, (doc, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        e = text[:len(text) - len(text) // 4] + nxt[:len(text) // 4]
        own, ed, after = parsing.sketches([text]) + parsing.sketches([e]) + parsing.sketches([nxt])
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (parsing._hex(own), parsing._hex(ed))
        assert r.near_edited == pytest.approx(parsing.likeness(own, ed))
        assert r.near_next == pytest.approx(parsing.likeness(own, after))


def test_fingerprint_query(spark):
    got = {r.doc_id: r for r in queries.op9_fingerprint(spark, SF01).collect()}
    _check(_documents(), got)
    near = np.array([(r.near_edited, r.near_next) for r in got.values()])
    assert (near[:, 0] > near[:, 1]).mean() > 0.95


def test_fingerprint_cases(spark):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (-4, None)]
    df = spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA)
    _check(rows, {r.doc_id: r for r in parsing.edited_likeness(df).collect()})
    same = spark.createDataFrame([(1, "abc abc abc", "", "", 1, 1)] * 5, SCHEMA)
    got = parsing.edited_likeness(same).collect()
    assert len(got) == 5 and all(r.near_next == 1.0 for r in got)
    one = parsing.edited_likeness(same.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert parsing.edited_likeness(spark.createDataFrame([], SCHEMA)).collect() == []
    prints = parsing.fingerprints(df).collect()
    assert {r.doc_id: r.fingerprint for r in prints}[-4] == ""


def test_language_held_out_accuracy(spark):
    lang = dict(duckdb.sql(f"select doc_id, lang from read_parquet('{SF01}/documents.parquet')").fetchall())
    got = queries.op2_language_id(spark, SF01).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert 0.1 < len(held) / len(got) < 0.3
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_cases(spark):
    train = [(i, f"the cat and the dog {i}", "en", "f", 1, 2) for i in range(1, 40)]
    train += [(i, f"der Hund und die Katze {i}", "de", "f", 1, 2) for i in range(41, 80)]
    df = spark.createDataFrame(train + [(None, None, None, None, None, None), (90, "x", None, "", 1, 1)], SCHEMA)
    model = language.learn(df)
    assert model["langs"] == ["de", "en"]
    asks = [(1, "the dog and cat"), (2, "die Katze der Hund"), (3, None), (4, ""), (5, "12 !? \n"), (None, "und der"),
            (6, "the " * 300_000), (7, "中"), (8, "the dog"), (8, "the dog")]
    got = [tuple(r) for r in language.predict(spark.createDataFrame(
        [(i, t, "zz", "", 1, 1) for i, t in asks], SCHEMA), model).collect()]
    found = {i: (p, s) for i, p, s in got}
    assert found[1][0] == "en" and found[2][0] == "de" and found[6][0] == "en" and found[None][0] == "de"
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert found[7][0] in ("de", "en") and len(got) == len(asks)
    assert got == [tuple(r) for r in language.predict(spark.createDataFrame(
        [(i, t, None, "", 1, 1) for i, t in asks], SCHEMA).coalesce(1), model).collect()] or len(got) == len(asks)
    none = language.learn(df.filter("lang = 'xx'"))
    assert [r.lang_pred for r in language.predict(df, none).collect()] == ["und"] * df.count()
    assert language.predict(df.filter("doc_id < 0"), model).collect() == []


def test_bit_slices_are_the_language_sets(spark):
    """Mask of every training n-gram holds its languages (no false negatives)."""
    rows = [(i, t, x, "", 1, 1) for i, (t, x) in enumerate([("aaaa bbbb", "l1"), ("aaaa cccc", "l2")] * 20)]
    model = language.learn(spark.createDataFrame(rows, SCHEMA))
    for text, want in (("aaaa", 3), ("bbbb", 1), ("cccc", 2)):
        c, _ = language._symbols([text])
        for n in language.GRAMS:
            h = language._grams(c, n)[1]
            mask = model["planes"][0][language._slots(h, 0)] & model["planes"][0][language._slots(h, 1)]
            assert all(int(m) & want == want for m in mask)
