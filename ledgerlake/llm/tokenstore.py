"""Token-id files with a minimal perfect hash index.

A store is a folder of Parquet files whose rows are shards: ``payload`` holds
the raw ids of consecutive documents (fixed width), beside it the shard's
index.  The index is a minimal perfect hash over the shard's keys
(hash-and-displace): a key's bucket gives a seed, the seed its slot, the slot
the key's fingerprint, first document and number of documents; ``offsets``
gives where a document's ids begin.  So a keyed read is a few array reads,
and the fingerprint rejects unknown keys.  Shards are in ascending key order
(NULL first), cut at SHARD_IDS ids or SHARD_DOCS documents.

Defined cases: NULL and empty texts hold the end id only; NULL is a key of
its own; documents that share a key are kept, in the order of their text
hash; very long texts make a shard of their own; an empty table makes an
empty store; other columns are ignored.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import _batch, byte_alphabet, tokenizer
from .common import batches

SHARD_IDS, SHARD_DOCS = 1_000_000, 65_536
#: Words kept by an encoding worker, and characters encoded together (few, so
#: that their words stay in the processor's cache).
KEPT_WORDS, CHARS = 900_000, 250_000
#: FIXED VALUES: the file's word pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Separators that Python's split takes for white space and the file's pattern does not.
_ODD = re.compile("[\x1c-\x1f]")
_WIDE = re.compile("[^\x00-\u024f]")
#: A stop between a letter or number and white space (or the end): a piece of its own.
_STOP = re.compile(r"[.,;:!?](?<=[^\W_].)(?=[ \n]|\Z)")
_NULL_KEY = np.uint64(0xC2B2AE3D27D4EB4F)
#: Constants of the 64-bit mix, and seeds tried together for a bucket.
_STEP, _START, SEEDS = np.array([0x9E3779B97F4A7C15], np.uint64), np.uint64(0x632BE59BD9B4E019), 64


class WordEncoder:
    """Encodes texts word by word with the library's BPE model, each distinct
    word once while it is kept.

    White space separates words before the model sees them, so a text's ids
    are its words' ids in order.  Words below U+0250 are normalised here
    (there NFC changes nothing and lower case is per character); others, and
    texts with special tokens or odd separators, go through the library whole.
    A text below U+0250 is lower-cased at once and the stop after a word
    becomes a word, as in the file's pattern, so fewer distinct words remain.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.full = tokenizer(path)
        self.model = Tokenizer(self.full.model)          # no normaliser: words come prepared
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        added = self.full.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added)) if added else None
        vocab = self.full.get_vocab(with_added_tokens=True)
        self.width = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for p, i in vocab.items() if p.endswith("</w>")]] = True
        self.letters = str.maketrans({chr(b): c for c, b in byte_alphabet().items()})
        self.words: dict[str, bytes] = {}                # a piece of the pattern is a word too

    def _learn(self, words: set[str]) -> None:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        known = self.words
        whole = [w for w in words if _WIDE.search(w)]
        for w, e in zip(whole, self.full.encode_batch_fast(whole, add_special_tokens=False)):
            known[w] = np.array(e.ids, self.width).tobytes()
        lowered = {w: w.lower() for w in words.difference(whole)}
        plain = {w: p for w, p in lowered.items() if p.isalpha()}         # letters alone are one piece
        split = {w: PIECES.findall(p) for w, p in lowered.items() if w not in plain}
        new = list(set(plain.values()).union(*split.values()).difference(known))
        for a in range(0, len(new), 500):
            some = new[a:a + 500]
            mapped = " ".join([p.translate(self.letters) if p.isascii() else
                               p.encode().decode("latin-1").translate(self.letters) for p in some])
            ids = np.array(self.model.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, self.width)
            stops = np.flatnonzero(self.ends[ids]) + 1
            size, raw, a = self.width.itemsize, ids.tobytes(), 0
            for p, b in zip(some, (stops * size).tolist()):
                known[p] = raw[a:b]
                a = b
        known.update([(w, known[p]) for w, p in plain.items() if w != p])
        known.update([(w, b"".join([known[p] for p in ps])) for w, ps in split.items() if ps != [w]])

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = {i for i, t in enumerate(texts) if _ODD.search(t) or self.special and self.special.search(t)}
        words = [[] if i in odd else
                 _STOP.sub(r" \g<0>", t.lower()).split() if not _WIDE.search(t) else t.split()
                 for i, t in enumerate(texts)]
        flat = list(chain.from_iterable(words))
        ids = list(map(self.words.get, flat))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            self._learn({flat[i] for i in new})
            for i in new:
                ids[i] = self.words[flat[i]]
        ends = list(accumulate(map(len, words)))
        return [np.array(self.full.encode(t, add_special_tokens=False).ids, self.width).tobytes() if i in odd
                else b"".join(ids[a:b]) for i, (t, a, b) in enumerate(zip(texts, [0, *ends], ends))]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file; it keeps its words between tasks."""
    return WordEncoder(path)


_TOKENS_T = [("pid", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("ids", pa.binary())]


def encode_rows(path: str, end_id: int) -> Callable:
    def run(stream):
        enc = encoder(path)
        end = np.array([end_id], enc.width).tobytes()
        rows = ((p, d, t, x.as_py() or "") for b in stream for p, d, t, x in zip(
            *(b.column(i).to_pylist() for i in range(3)), b.column(3)))
        for some in batches(rows, lambda r: len(r[3]) + 50, CHARS):
            ids = enc.encode([r[3] for r in some])
            yield _batch(_TOKENS_T, [(*r[:3], i + end) for r, i in zip(some, ids)])
    return run


def mix64(x: np.ndarray, seed) -> np.ndarray:
    """A 64-bit mix of keys (splitmix's finaliser)."""
    x = x + (np.asarray(seed, np.uint64) * _STEP + _START)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: list[int | None]) -> np.ndarray:
    return np.array([_NULL_KEY if k is None else np.uint64(k & (2 ** 64 - 1)) for k in keys], np.uint64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 1) >> np.uint64(32)).astype("<u4")


def build_mph(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slots): a minimal perfect hash of distinct keys onto 0..n-1.

    Buckets of about four keys, largest first, try seeds until all their
    slots are free; a lone key is sent to a free slot directly (a negative
    seed), so the last ones take no search.
    """
    n = len(keys)
    m = max(1, -(-n // 4))
    bucket = (mix64(keys, 2) % np.uint64(m)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(m + 1))
    sizes = np.diff(ends)
    seeds, slots, used = np.zeros(m, "<i4"), np.empty(n, np.int64), np.zeros(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        own, seed = order[ends[b]:ends[b + 1]], 0
        while True:                                   # SEEDS seeds at a time
            at = _slots_of(keys[own][:, None], np.arange(seed, seed + SEEDS)[None, :], n)
            near = np.sort(at, axis=0)
            good = np.flatnonzero(~(used[at].any(axis=0) | (near[1:] == near[:-1]).any(axis=0)))
            if len(good):
                break
            seed += SEEDS
        seeds[b], slots[own] = seed + good[0], at[:, good[0]]
        used[at[:, good[0]]] = True
    free = np.flatnonzero(~used)
    lone = np.flatnonzero(sizes == 1)
    seeds[lone] = -free - 1
    slots[order[ends[lone]]] = free
    return seeds, slots


def _slots_of(keys: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (mix64(keys, 3 + seed) % np.uint64(n)).astype(np.int64)


def find_slots(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(mix64(keys, 2) % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    return np.where(seed < 0, -seed - 1, _slots_of(keys, np.maximum(seed, 0), n))


_SHARD_T = [("pid", pa.int32()), ("seq", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64()),
            ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("keys", pa.list_(pa.int64())),
            ("seeds", pa.binary()), ("slots", pa.binary()), ("offsets", pa.binary()), ("payload", pa.binary())]
_SHARD = ("pid int, seq long, first_key long, last_key long, n_docs int, n_tokens long, width int, "
          "keys array<long>, seeds binary, slots binary, offsets binary, payload binary")


def _shard(pid: int, seq: int, docs: list[tuple[int | None, bytes]], width: int) -> tuple:
    keys = [d for d, _ in docs]
    first = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    count = np.diff([*first, len(keys)])
    hashes = key_hash([keys[i] for i in first])
    seeds, at = build_mph(hashes)
    slots = np.empty((len(first), 3), "<u4")            # fingerprint, first document, documents
    slots[at, 0], slots[at, 1], slots[at, 2] = fingerprint(hashes), first, count
    offsets = np.cumsum([0, *(len(b) // width for _, b in docs)]).astype("<u8")
    return (pid, seq, keys[0], keys[-1], len(docs), int(offsets[-1]), width, keys, seeds.tobytes(), slots.tobytes(),
            offsets.tobytes(), b"".join(b for _, b in docs))


def pack_shards(width: int) -> Callable:
    """Sorted (pid, doc_id, tie, ids) rows to shards, streaming."""

    def run(stream):
        at, seq, docs, size = None, 0, [], 0
        for b in stream:
            for pid, doc, ids in zip(b.column("pid").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids")):
                ids = ids.as_py()
                if docs and (pid != at or size + len(ids) // width > SHARD_IDS or len(docs) >= SHARD_DOCS):
                    yield _batch(_SHARD_T, [_shard(at, seq, docs, width)])
                    seq, docs, size = seq + 1, [], 0
                if pid != at:
                    at, seq = pid, 0
                docs.append((doc, ids))
                size += len(ids) // width
        if docs:
            yield _batch(_SHARD_T, [_shard(at, seq, docs, width)])
    return run


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts below the key: its range, ascending (NULL: 0)."""
    if not cuts:
        return F.lit(0)
    return F.when(key.isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < key)))


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> str:
    """Encode every document, append ``end_id`` and write the store."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # approximate quantiles only balance the ranges; any cuts give the same order
    cuts = sorted({int(c) for c in rows.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.002)})
    width = WordEncoder(tokenizer_path).width.itemsize
    tokens = (rows.select(_range_of(F.col("doc_id"), cuts).cast("int").alias("pid"), "doc_id",
                          F.xxhash64("text").alias("tie"), "text")
                  .mapInArrow(encode_rows(tokenizer_path, end_id), "pid int, doc_id long, tie long, ids binary"))
    (tokens.repartition(n, "pid").sortWithinPartitions("pid", F.col("doc_id").asc_nulls_first(), "tie")
           .mapInArrow(pack_shards(width), _SHARD)
           .write.option("compression", "zstd").parquet(path))
    return path


_READ_T = [("pid", pa.int32()), ("seq", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("offset", pa.int64()),
           ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]


def _open(row: dict) -> tuple[np.ndarray, ...]:
    return (np.frombuffer(row["seeds"], "<i4"), np.frombuffer(row["slots"], "<u4").reshape(-1, 3),
            np.frombuffer(row["offsets"], "<u8").astype(np.int64),
            np.frombuffer(row["payload"], f"<u{row['width']}"))


def find_documents(row: dict, keys: list[int | None]) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """(key, document number, offset, ids) of the shard's documents with those keys."""
    seeds, slots, offsets, payload = _open(row)
    hashes = key_hash(keys)
    at = find_slots(hashes, seeds, len(slots))
    for key, (mark, first, count), want in zip(keys, slots[at].tolist(), fingerprint(hashes).tolist()):
        if mark == want and row["keys"][first] == key:
            for d in range(first, first + count):
                yield key, d, int(offsets[d]), payload[offsets[d]:offsets[d + 1]]


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, found through
    the index of each shard; ``start`` counts the ids of all documents before."""

    def run(stream):
        for b in stream:
            for i in range(b.num_rows):
                row = {k: v[0] for k, v in b.slice(i, 1).to_pydict().items()}
                keys = [k for j, k in enumerate(row["keys"]) if not j or k != row["keys"][j - 1]]
                yield _batch(_READ_T, [(row["pid"], row["seq"], d, key, off, len(ids), zlib.crc32(ids.astype("<u4")))
                                       for key, d, off, ids in find_documents(row, keys)])

    store = spark.read.schema(_SHARD).parquet(path)
    found = store.mapInArrow(run, "pid int, seq long, at int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    shards = store.select("pid", "seq", F.col("n_tokens").alias("size"))
    by_pid = shards.groupBy("pid").agg(F.sum("size").alias("pid_size"))     # one row per range
    earlier = W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    within = W.partitionBy("pid").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    bases = (shards.join(by_pid.select("pid", F.coalesce(F.sum("pid_size").over(earlier), F.lit(0)).alias("pid_base")), "pid")
                   .select("pid", "seq", (F.col("pid_base") + F.coalesce(F.sum("size").over(within), F.lit(0))).alias("base")))
    return (found.join(bases, ["pid", "seq"])
                 .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """doc_id and ids of the stored documents with the given keys.

    A directory of the shards' key ranges routes each key: keys and shards
    meet on the cells of a grid over the key range, then the range is checked;
    only the shards that keys reach are read for their payload.
    """
    store = spark.read.schema(_SHARD).parquet(path)
    ranges = store.select("pid", "seq", "first_key", "last_key")
    low, high, n = ranges.agg(F.min("first_key"), F.max("last_key"), F.count(F.lit(1))).first()
    step = max(1, ((high or 0) - (low or 0)) // max(1, n or 1))
    cell = lambda c: F.coalesce(F.floor((c - F.lit(low or 0)) / step), F.lit(-1))
    cells = ranges.withColumn("cell", F.explode(F.array_distinct(F.concat(
        F.when(F.col("first_key").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.array().cast("array<long>")),
        F.when(F.col("last_key").isNotNull(), F.sequence(
            cell(F.coalesce("first_key", F.lit(low))), cell(F.col("last_key")))).otherwise(F.array().cast("array<long>"))))))
    wanted = keys.select(F.col(key_col).cast("long").alias("key")).distinct().withColumn("cell", cell(F.col("key")))
    routed = (wanted.join(cells, "cell").filter(
        (F.col("key").isNull() & F.col("first_key").isNull())
        | (F.coalesce(F.col("first_key") <= F.col("key"), F.col("first_key").isNull()) & (F.col("key") <= F.col("last_key"))))
        .groupBy("pid", "seq").agg(F.collect_list(F.struct("key")).alias("wanted")))   # at most a shard's keys

    def run(stream):
        for b in stream:
            for i in range(b.num_rows):
                row = {k: v[0] for k, v in b.slice(i, 1).to_pydict().items()}
                got = find_documents(row, [w["key"] for w in row["wanted"]])
                yield _batch([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))],
                             [(key, ids.astype(np.int32).tolist()) for key, _, _, ids in got])

    return store.join(routed, ["pid", "seq"]).mapInArrow(run, "doc_id long, ids array<int>")
