"""BPE round trip and token store against the library on whole texts."""
import hashlib
import random
import tempfile
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe, queries, tokenstore
from tests.conftest import SF01

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens int, ids string, block int, pid string"
ODD = [None, "", " ", "\n", "  a", "a  ", "a \n b", "a\n\nb", "a\n b", "a\t \nb", "\t x", "x  y", "a  b", "\x1c a\x1db",
       "<|endoftext|>", "foo <|endoftext|> bar\n <|endoftext|>\n", "<|startoftext|> Héllo", "don't I'LL 'S 's", "İstanbul ΑΣ ΑΣ. ς",
       "é ́x", "日本語 テキスト 12½ ²", "😀👍🏽 ok", "a\u0000b \u0001", "x" * 50_000, "ab cd " * 30_000, "İ", "ﬁ ǅ Ǆ ß ẞ", "\u0085 a\u0085b", "a\r\nb \r\n c"]


def _random_texts(n):
    rng = random.Random(5)
    alphabet = " \n\tabzAZ'é09.,-́  ΣςŁ中\x1c<|>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def _rows(texts):
    return [(i if i % 7 else None, t, 1, "x", 3, "y") for i, t in enumerate(texts)] + [(3, "same", 1, "x", 3, "y")] * 3


def _documents(sf):
    return duckdb.sql(f"select doc_id, text from read_parquet('{sf}/documents.parquet')").fetchall()


def test_bpe_query_equals_library(spark):
    t = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in queries.op5_bpe_roundtrip(spark, SF01).collect()}
    docs = _documents(SF01)
    assert len(got) == len(docs)
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(
            t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_texts(spark):
    t = Tokenizer.from_file(BYTE)
    rows = _rows(ODD + _random_texts(1500))
    got = bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), BYTE).collect()
    want = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    key = lambda r: (str(r[0]), r[1], bytes(r[2]), r[3])
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), BYTE).collect() == []


def test_bpe_rows_in_another_order_on_every_reading(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 300)
    texts = [f"word{i} and {i * i} of\n{i % 9}" for i in range(400)] + ["", None] * 5 + ["same text"] * 30

    def shuffled(stream):
        import os
        for b in stream:
            yield b.take(pa.array(np.random.default_rng(int.from_bytes(os.urandom(8), "little")).permutation(b.num_rows)))

    df = spark.createDataFrame([(i // 3 if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = bpe.encode_documents(df.repartition(3).mapInArrow(shuffled, df.schema), BYTE).collect()
    t = Tokenizer.from_file(BYTE)
    want = [(r.doc_id, np.array(t.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes()) for r in df.collect()]
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == sorted((str(i), x) for i, x in want)


def test_word_encoder_equals_library():
    t, enc = Tokenizer.from_file(WORD), tokenstore.WordEncoder(WORD)
    texts = [x or "" for x in ODD] + _random_texts(3000)
    for text, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, enc.width).tolist() == t.encode(text, add_special_tokens=False).ids, repr(text[:60])


def test_token_store_query(spark):
    t = Tokenizer.from_file(WORD)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op10_token_store(spark, SF01).collect()}
    start = 0
    for i, text in sorted(_documents(SF01)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_store_repeats_nulls_lookup(spark, monkeypatch):
    monkeypatch.setattr(tokenstore, "SHARD_IDS", 3000)
    rows = _rows(ODD + _random_texts(1500))
    df = spark.createDataFrame(rows, SCHEMA)
    t = Tokenizer.from_file(WORD)
    path = tokenstore.write_store(df, tempfile.mkdtemp(prefix="ll-store-", dir="/tmp") + "/s", WORD)
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in tokenstore.read_all(spark, path).collect())
    assert len(got) == len(rows)
    at, last = 0, None
    for start, doc, n in got:                      # one unbroken run of ids, ascending, NULL first
        assert start == at and (last is None or doc >= last)
        at, last = at + n, doc
    keys = spark.createDataFrame([(None,), (3,), (10,), (999_999,), (-5,)], "doc_id long")
    found = sorted((str(r.doc_id), tuple(r.ids)) for r in tokenstore.lookup(spark, path, keys).collect())
    want = sorted((str(r[0]), tuple(t.encode(r[1] or "", add_special_tokens=False).ids + [2]))
                  for r in rows if r[0] in (None, 3, 10))
    assert found == want


def test_store_empty(spark):
    path = tokenstore.write_store(spark.createDataFrame([], SCHEMA),
                                  tempfile.mkdtemp(prefix="ll-store-", dir="/tmp") + "/s", WORD)
    assert tokenstore.read_all(spark, path).collect() == []
    keys = spark.createDataFrame([(1,), (None,)], "doc_id long")
    assert tokenstore.lookup(spark, path, keys).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 20_000])
def test_minimal_perfect_hash(n):
    keys = tokenstore.key_hash(random.Random(n).sample(range(-10**12, 10**12), n))
    seeds, slots = tokenstore.build_mph(keys)
    assert sorted(slots.tolist()) == list(range(n))
    assert (tokenstore.find_slots(keys, seeds, n) == slots).all()


def test_stops_and_case_make_no_word_of_their_own():
    """A stop after a word is a piece of its own, so a word is kept once,
    whatever stop follows; ids are the library's also next to odd characters."""
    enc = tokenstore.WordEncoder(P.path("word_bpe_49k.json"))
    texts = ["Elephant. elephant, ELEPHANT; elephant: elephant! elephant?", "\u0130. a_. (b). c...\nd.,\xa0e. 9. \xb2, it's.",
             "\u00c9t\u00e9, \u00e9t\u00e9. \u65e5\u672c. na\u00efve, x.", "a.\x1cb, c.", "", "."]
    want = [enc.full.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, enc.width).tolist() for x in enc.encode(texts)] == want
    assert [w for w in enc.words if "lephant" in w.lower()] == ["elephant"]
