"""BPE encoding and decoding through a distinct-word table.

1. Documents are split into words (a word keeps the space before it) and
   packed into blocks.  A block sends its distinct words, dealt by word hash,
   and (from a second reading, so that they are shuffled once) its documents
   as positions in that block's word list.  Each partition is sorted before,
   so that readings and retried tasks that see its rows in another order make
   the same blocks.
2. The task that owns a word encodes it once, whatever number of blocks hold
   it, and returns the ids to each block in the order of its word list.
3. Per block, ids are joined back by position; decoding joins every id with
   the table id -> piece and concatenates the bytes.

The words' ids concatenate to the text's ids because the splitter cuts only
where the tokenizer's own pattern always cuts: before a space that a
non-space follows, around single line breaks, and around special tokens.

Blocks, word lists and rows between the steps are bounded; no group is
collected.  Defined cases: NULL and empty texts give no ids and decode to the
empty string; a NULL id is kept; repeated rows each get their result; very
long texts make a block of their own; an empty table gives an empty result;
other columns are ignored.
"""
from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, giving_back

#: Characters of a block, distinct words kept by an encoding task at a time,
#: and characters of an output batch.
BLOCK_CHARS, KEPT_WORDS, OUT_CHARS = 24_000_000, 1_500_000, 2_000_000
#: ``part`` of the rows that hold a block's documents; word lists have their hash part.
_DOCS = 1 << 30
_SPACED = re.compile(r" (?=\S)")
_AWKWARD = re.compile(r" (?=\s|$)|\n(?=\s|$)")
_WORD_LISTS = "block long, part int, data binary"
_ENCODED = "block long, part int, ids array<long>, counts array<int>, data binary"
_RESULT = "doc_id long, n_tokens long, ids binary, decoded string"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer of a file, one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def specials(path: str) -> re.Pattern | None:
    words = sorted((t.content for t in tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, words))) if words else None


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the rest follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The table id -> piece: all pieces' bytes, and where each id's begin."""
    t, alphabet = tokenizer(path), byte_alphabet()
    by_id = dict(sorted((i, p) for p, i in t.get_vocab(with_added_tokens=True).items()))
    as_bytes = lambda p: bytes(alphabet[c] for c in p) if all(c in alphabet for c in p) else p.encode()
    table = [as_bytes(by_id[i]) if i in by_id else b"" for i in range(max(by_id) + 1)]
    return (np.frombuffer(b"".join(table), np.uint8),
            np.concatenate([[0], np.cumsum([len(p) for p in table])]))


class _Words(dict):
    """word -> position, giving unseen words the next position; ``spaced`` holds
    words after a space, keyed without it."""

    def __init__(self, words: list[str], lead: str = ""):
        self.words, self.lead = words, lead

    def __missing__(self, word: str) -> int:
        self.words.append(self.lead + word)
        at = self[word] = len(self.words) - 1
        return at


def positions(text: str, special: re.Pattern | None, plain: _Words, spaced: _Words) -> list[int]:
    """Positions of a text's words, in order."""
    if special and special.search(text):
        out, at = [], 0
        for m in special.finditer(text):
            out += positions(text[at:m.start()], None, plain, spaced)
            out.append(plain[m[0]])
            at = m.end()
        return out + positions(text[at:], None, plain, spaced)
    if not text:
        return []
    if _AWKWARD.search(text):                     # runs of white space: cut before " x" alone
        cuts = [0, *(m.start() for m in _SPACED.finditer(text)), len(text)]
        return [plain[text[a:b]] for a, b in zip(cuts, cuts[1:]) if a < b]
    out, line_break = [], "\n"
    for n, line in enumerate(text.split("\n")):
        if n:
            out.append(plain[line_break])
        first, *rest = line.split(" ")
        if first:
            out.append(plain[first])
        out += map(spaced.__getitem__, rest)
    return out


def pack(*parts: bytes) -> bytes:
    head = np.array([len(p) for p in parts], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(parts)]) + head + b"".join(parts))


def unpack(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = raw[0]
    ends = np.cumsum(np.frombuffer(raw, "<u8", n, 1)) + 1 + 8 * n
    return [raw[a:b] for a, b in zip([1 + 8 * n, *ends], ends)]


def planes(x: np.ndarray) -> bytes:
    """Small numbers byte by byte: first all low bytes, and so on."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema)], [n for n, _ in schema])


_WORDS_T = [("block", pa.int64()), ("part", pa.int32()), ("data", pa.binary())]
_ENCODED_T = [("block", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(pa.int64())),
              ("counts", pa.list_(pa.int32())), ("data", pa.binary())]


def _documents(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for b in stream:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            yield i, t.as_py() or ""


def split_blocks(path: str, parts: int, documents: bool) -> Callable:
    """Step 1: the blocks' documents, or else their word lists (key: the part).

    A block is named by its content, so both readings of the table agree on
    the names; blocks of equal content are interchangeable.
    """

    def run(stream):
        special = specials(path)
        for docs in batches(_documents(stream), lambda d: len(d[1]) + 20, BLOCK_CHARS):
            words: list[str] = []
            plain, spaced = _Words(words), _Words(words, " ")
            codes = [np.array(positions(t, special, plain, spaced), np.uint32) for _, t in docs]
            del plain, spaced
            raw = [w.encode() for w in words]
            name = hashlib.blake2b(np.concatenate(codes).tobytes() + b"\0".join(raw), digest_size=8).digest()
            block = int.from_bytes(name, "little", signed=True)
            part = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % parts
            if documents:
                yield _batch(_ENCODED_T, [(block, _DOCS, [i for i, _ in docs], [len(c) for c in codes],
                                           pack(planes(np.concatenate(codes)), planes(part)))])
                continue
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            for p in range(parts):
                own = order[ends[p]:ends[p + 1]]
                if len(own):
                    yield _batch(_WORDS_T, [(block, p, pack(planes(np.array([len(raw[i]) for i in own])),
                                                            b"".join(raw[i] for i in own)))])
    return run


def encode_words(path: str) -> Callable:
    """Step 2: each distinct word of the task's parts is encoded once.  The
    table of words is emptied at KEPT_WORDS."""

    def run(stream):
        t, known = tokenizer(path), {}
        for b in stream:
            for block, part, data in zip(*(b.column(n) for n, _ in _WORDS_T)):
                sizes, raw = unpack(data.as_py())
                ends = np.cumsum(from_planes(sizes)).tolist()
                words = [raw[a:e] for a, e in zip([0, *ends], ends)]
                if len(known) > KEPT_WORDS:
                    known.clear()
                new = [w for w in words if w not in known]
                for some in batches(new, len, 1_000_000):
                    for w, e in zip(some, t.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
                        known[w] = np.array(e.ids, "<u4").tobytes()
                out = [known[w] for w in words]
                yield _batch(_WORDS_T, [(block.as_py(), part.as_py(), pack(
                    planes(np.array([len(o) // 4 for o in out])), planes(np.frombuffer(b"".join(out), "<u4"))))])
    return run


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[start:start + size], one after another."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    return flat[at + np.repeat(starts - (ends - sizes), sizes)]


def decode_ids(ids: np.ndarray, path: str) -> str:
    """Join each id with its piece; the bytes as UTF-8, bad ones replaced."""
    table, starts = pieces(path)
    known = ids[ids < len(starts) - 1]
    return gather(table, starts[known], starts[known + 1] - starts[known]).tobytes().decode("utf-8", "replace")


_RESULT_T = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())]


def join_positions(path: str) -> Callable:
    """Step 3: a block's word parts, then its documents, sorted by part."""

    def run(stream):
        at, lists = None, {}
        for b in stream:
            for row in zip(*(b.column(n) for n, _ in _ENCODED_T)):
                block, part, doc_ids, counts, data = (x.as_py() for x in row)
                if block != at:
                    at, lists = block, {}
                if part != _DOCS:
                    lists[part] = unpack(data)
                    continue
                none = [np.empty(0, "<u4")]
                sizes = np.concatenate(none + [from_planes(x[0]) for x in lists.values()]).astype(np.int64)
                flat = np.concatenate(none + [from_planes(x[1]) for x in lists.values()])
                codes, owner = map(from_planes, unpack(data))
                if len(owner) != len(sizes):
                    raise RuntimeError("a block's word lists are incomplete")
                # word lists stand part by part, each in the order in which the block met the words
                place = np.argsort(np.argsort(owner, kind="stable"), kind="stable")
                starts = (np.cumsum(sizes) - sizes)[place]
                sizes = sizes[place]
                lo = np.cumsum([0, *counts])
                docs = ((i, codes[a:e]) for i, a, e in zip(doc_ids, lo, lo[1:]))
                for some in batches(docs, lambda d: 8 * len(d[1]) + 64, OUT_CHARS):
                    out = []
                    for i, c in some:
                        ids = gather(flat, starts[c], sizes[c])
                        out.append((i, len(ids), ids.tobytes(), decode_ids(ids, path)))
                    yield _batch(_RESULT_T, out)
    return run


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded (the
    text decoded from those ids) of every row."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    lists = (rows.mapInArrow(giving_back(split_blocks(path, 2 * n, documents=False)), _WORD_LISTS).repartition(n, "part")
                 .mapInArrow(giving_back(encode_words(path)), _WORD_LISTS))
    blocks = rows.mapInArrow(giving_back(split_blocks(path, 2 * n, documents=True)), _ENCODED)
    return (blocks.unionByName(lists, allowMissingColumns=True).repartition(n, "block")
                  .sortWithinPartitions("block", "part").mapInArrow(giving_back(join_positions(path)), _RESULT))
