"""Exact n-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set is its distinct word shingles; documents of equal sets form
a class, and classes are the records.  Two records are linked when
100 * intersection >= percent * union, so each shares at least
T = ceil(percent * size / 100) shingles with the other.

* Short and long lists.  One pass counts all shingles of all documents in a
  bounded table of counters; shingles in counters far above the mean have
  long inverted lists.  As in DivideSkip, long lists are not merged as long
  as short ones decide: a record's shingles are ordered short lists first, and
  of a pair that reaches T the first size - T + 1 shingles of both must
  meet.  Only these prefixes are written into inverted lists.  (The counters
  steer cost; any order gives the same links.)
* Merging.  The lists are sorted by shingle and merged as a stream.  In each
  list the record with the fewest short-list shingles stands for the rest
  (its star), so a group of near copies gives a number of candidates linear in
  its size.  A pair met on a long list only cannot share a short one, which
  bounds its overlap by their long-list shingles; most pairs end there.
* Signatures.  A class carries SIGNATURE parity bits: a shingle flips one, so
  two signatures differ in no more bits than the sets in shingles, and a pair
  whose signatures differ in more than a link allows is none.  Candidates are
  held against them before any set is read.
* Probing.  A candidate's shingles are binary-probed in the other's sorted
  set, in blocks, until T is reached or out of reach.
* The rest.  Once stars are tied into components, the members of a list
  outside its main component meet all its members of other components, in
  pairs of bounded blocks; what signatures, then the heads of the sets allow
  is probed.  So no link between components is missed; links inside a
  component add nothing to it.
* All links.  Every link lies inside a component, so the join's full result
  comes from the finished components: a component's records are cut into bands
  of size (a link spans one band or two) and blocks of bounded size, and each
  pair of blocks is counted by a matrix product over the shingles that occur
  twice.  Numbers of links leave a pair of blocks as one row per record; the
  links themselves are made only when they are read.

Shingles and classes are 64-bit hashes.  Defined cases: NULL and empty texts
have no set, size 0 and are their own component; fewer words than a shingle
make one shingle; a component of documents without ids has a NULL id;
repeated rows and ids are separate documents; an empty table gives an empty
result; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import salted_join
from .bpe import _batch
from .common import cut, giving_back
from .components import connected_components

#: Counters of the list-length table, its slices, bits of the filter of wanted
#: texts, rows held of a list, rows in a block of a list, probes in a block.
COUNTERS_LOG2, SLICES, WANTED_LOG2, HELD_ROWS, LIST_ROWS, PROBES = 25, 64, 22, 50_000, 1024, 64
#: Bits of a class's signature, and its columns of 64 bits.
SIGNATURE = 512
SIGNS = [f"sign{i}" for i in range(SIGNATURE // 64)]
#: Records and shingles in a block of a component, columns of a matrix product.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 256, 500_000, 4096
_U = np.uint64
_C1, _C2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _C1
    x = (x ^ (x >> _U(27))) * _C2
    return x ^ (x >> _U(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; A-Z are lower-cased and
    words are cut at ASCII white space."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = min(words, len(a))
    h = a[:len(a) - n + 1] + _U(n)
    for i in range(1, n):
        h = _mix(h) + a[i:len(a) - n + 1 + i]
    return np.unique(_mix(h))


def class_of(s: np.ndarray) -> int:
    """The class of equal sets, as a signed 64-bit number."""
    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0])


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - COUNTERS_LOG2)).astype(np.int64)


def _flags(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the shingles' lists are long, from the packed bits."""
    at = _slot(h)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def signature(s: np.ndarray) -> list[int]:
    """The set's parity bits, 64 to a number."""
    odd = np.bincount((s % _U(SIGNATURE)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


_SEEN_T = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()),
           ("slice", pa.int32()), ("total", pa.int64()), ("data", pa.binary()), *((c, pa.int64()) for c in SIGNS)]
_SEEN = ("doc_id long, text_key long, node long, n int, slice int, total long, data binary, "
         + ", ".join(f"{c} long" for c in SIGNS))


def count_lists(words: int) -> Callable:
    """(doc_id, text_key, text) -> each document's class and size, a class's
    signature where the task meets it first; and, per task, the counters of
    its classes' shingles in slices."""

    def run(stream):
        counters, seen = np.zeros(1 << COUNTERS_LOG2, np.uint16), set()
        none = [None] * len(SIGNS)
        for b in stream:
            out = []
            for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                s = shingles(text.as_py(), words)
                node, signs = class_of(s) if len(s) else None, none
                if len(s) and node not in seen:
                    seen.add(node)
                    at = _slot(s)
                    counters[at] += counters[at] < 65_535       # stays at its most
                    signs = signature(s)
                out.append((doc, key, node, len(s), None, None, None, *signs))
            yield _batch(_SEEN_T, out)
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = counters.reshape(SLICES, -1)
        for i in np.flatnonzero(parts.any(axis=1)):
            yield _batch(_SEEN_T, [(None, None, None, None, int(i), int(parts[i].sum()), pack(parts[i].tobytes()), *none)])
    return run


def long_lists(counts: DataFrame) -> np.ndarray:
    """Packed bit per counter: its lists are long.  ``counts`` has the slices of all
    tasks; a slice is added up as a stream, and the bits (a fixed number) come
    to the driver."""
    total = counts.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    mean = total / (1 << COUNTERS_LOG2)
    limit = mean + 4 * mean ** 0.5 + 2

    def run(stream):
        unpack, at, held = zstandard.ZstdDecompressor().decompress, None, None
        fields = [("slice", pa.int32()), ("bits", pa.binary())]
        done = lambda: _batch(fields, [(at, np.packbits(held > limit).tobytes())])
        for b in stream:
            for i, data in zip(b.column(0).to_pylist(), b.column(1)):
                if i != at:
                    if at is not None:
                        yield done()
                    at, held = i, np.zeros((1 << COUNTERS_LOG2) // SLICES, np.uint64)
                held += np.frombuffer(unpack(data.as_py()), np.uint16)
        if at is not None:
            yield done()

    rows = (counts.select("slice", "data").repartition("slice").sortWithinPartitions("slice")
                  .mapInArrow(run, "slice int, bits binary").collect())
    bits = np.zeros((SLICES, (1 << COUNTERS_LOG2) // SLICES // 8), np.uint8)
    for r in rows:
        bits[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return bits.ravel()


def _least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _ordered(s: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, int]:
    """Shingles in list order (short lists first, then by hash), and how many
    have short lists."""
    is_long = _flags(long, s)
    return np.concatenate([s[~is_long], s[is_long]]), int(len(s) - is_long.sum())


_POSTING_T = [("h", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("short", pa.int32())]


def postings(shared, words: int, percent: int) -> Callable:
    """text -> rows of inverted lists: the prefix of each class's set."""

    def run(stream):
        long, seen = shared.value, set()
        for b in stream:
            hs, rows = [], []
            for text in b.column(0):
                s = shingles(text.as_py(), words)
                if not len(s) or (node := class_of(s)) in seen:
                    continue
                seen.add(node)
                order, short = _ordered(s, long)
                head = order[:len(s) - _least_overlap(len(s), percent) + 1]
                hs.append(head)
                rows.append((node, len(s), short, len(head)))
            if rows:
                node, n, short, size = (np.array(x, np.int64) for x in zip(*rows))
                h = np.concatenate(hs).view(np.int64)
                cols = [h, *(np.repeat(x, size) for x in (node, n, short))]
                for a in range(0, len(h), 500_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 500_000]).cast(t) for c, (_, t) in zip(
                        cols, _POSTING_T)], [f for f, _ in _POSTING_T])
    return run


def _can_reach(na, nb, sa, sb, on_long, percent: int) -> np.ndarray:
    """Whether sizes (and, met on a long list, the long-list shingles) allow a link."""
    need = -(-percent * (na + nb) // (100 + percent))
    bound = np.where(on_long, np.minimum(na - sa, nb - sb), np.minimum(na, nb))
    return bound >= need


_MERGED_T = [("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("short", pa.int32()),
             ("long", pa.bool_())]
_MERGED = "h long, a long, b long, n int, short int, long boolean"


def merge_lists(shared, percent: int) -> Callable:
    """Sorted postings -> star candidates (a, b; h NULL), and the members
    (a; b NULL) of the lists of three and more.

    The last list of a batch is held until its end shows; beyond HELD_ROWS it
    is written out and only its first record kept.
    """

    def rows_of(h, node, n, short, resumed, long):
        """``resumed``: the first list goes on from an earlier flush."""
        new = np.append(True, (h[1:] != h[:-1]))
        keep = new | np.append(True, node[1:] != node[:-1])       # a class from several tasks
        h, node, n, short, new = h[keep], node[keep], n[keep], short[keep], new[keep]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(h)))
        star = np.repeat(first, size)
        other = star != np.arange(len(h))
        on_long = _flags(long, h.view(np.uint64))
        ok = other & _can_reach(n[star], n, short[star], short, on_long, percent)
        pairs = np.unique(np.stack([node[star[ok]], node[ok]], 1), axis=0)
        if resumed:
            size[0] = max(size[0], 3)
        member = np.repeat(size > 2, size)
        if resumed:
            member[0] = False
        none = pa.nulls
        yield pa.RecordBatch.from_arrays(
            [none(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none(len(pairs), pa.int32()),
             none(len(pairs), pa.int32()), none(len(pairs), pa.bool_())], [f for f, _ in _MERGED_T])
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[member]), pa.array(node[member]), none(int(member.sum()), pa.int64()),
             pa.array(n[member], pa.int32()), pa.array(short[member], pa.int32()), pa.array(on_long[member])],
            [f for f, _ in _MERGED_T])

    def run(stream):
        long, held, resumed = shared.value, None, False
        for b in stream:
            cols = [b.column(i).to_numpy() for i in range(4)]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            if not len(cols[0]):
                continue
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            if last:
                yield from rows_of(*(c[:last] for c in cols), resumed, long)
                resumed = False
            held = [c[last:] for c in cols]
            if len(held[0]) > HELD_ROWS:
                yield from rows_of(*held, resumed, long)
                held, resumed = [c[:1] for c in held], True
        if held is not None and len(held[0]):
            yield from rows_of(*held, resumed, long)
    return run


def _wanted(keys: DataFrame) -> np.ndarray:
    """Bits of the wanted text keys (a fixed number of words on the driver)."""
    bit = F.pmod(F.xxhash64("text_key"), F.lit(1 << WANTED_LOG2))
    rows = (keys.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32).alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits")).toArrow())
    words = np.zeros((1 << WANTED_LOG2) // 32, "<u4")
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def sets_of(texts: DataFrame, classes: DataFrame, nodes: DataFrame, words: int, shape: Callable) -> DataFrame:
    """(node, data) of the wanted classes, read anew from one text of each;
    ``shape`` makes the data from the sorted set."""
    keys = nodes.join(classes, "node").select("text_key")
    shared = texts.sparkSession.sparkContext.broadcast(_wanted(keys))

    def run(stream):
        wanted, seen = shared.value, set()
        for b in stream:
            for i in np.flatnonzero(wanted[b.column(2).to_numpy()]):
                key = b.column(0)[int(i)].as_py()
                if key in seen:
                    continue
                seen.add(key)
                s = shingles(b.column(1)[int(i)].as_py(), words)
                if len(s):
                    yield _batch([("node", pa.int64()), ("data", pa.binary())], [(class_of(s), shape(s))])

    rows = texts.select("text_key", "text", F.pmod(F.xxhash64("text_key"), F.lit(1 << WANTED_LOG2)).alias("bit"))
    return (rows.mapInArrow(giving_back(run), "node long, data binary").join(nodes, "node", "left_semi")
                .groupBy("node").agg(F.first("data").alias("data")))


def _nodes(pairs: DataFrame) -> DataFrame:
    ends = (pairs.select(F.col(c).alias("node")).distinct() for c in ("a", "b"))
    return reduce(DataFrame.union, ends).distinct()


def _signs_allow(n, x_n, signs: list, x_signs: list, percent: int) -> Column:
    """Whether the signatures differ in as few bits as a link's sets may in shingles."""
    need = F.ceil(percent * (n + x_n) / (100 + percent))
    return reduce(Column.__add__, (F.bit_count(a.bitwiseXOR(b)) for a, b in zip(signs, x_signs))) <= n + x_n - 2 * need


def _signed(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and signatures allow."""
    end = lambda c: signs.select(F.col("node").alias(c), *(F.col(k).alias(f"{c}_{k}") for k in ["n", *SIGNS]))
    both = pairs.join(end("b"), "b").join(end("a"), "a")
    return both.filter(_signs_allow(F.col("a_n"), F.col("b_n"), [F.col(f"a_{c}") for c in SIGNS],
                                    [F.col(f"b_{c}") for c in SIGNS], percent)).select("a", "b")


def _paired(pairs: DataFrame, sets: DataFrame, test: Callable) -> DataFrame:
    """Pairs that pass ``test(data of a, data of b)``.  Both joins have a
    unique side, so Spark can split a record with many pairs."""

    def run(stream):
        for b in stream:
            yield _batch([("a", pa.int64()), ("b", pa.int64())],
                         [(x, y) for x, y, p, q in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3))
                          if test(p.as_py(), q.as_py())])

    right = pairs.join(sets.select(F.col("node").alias("b"), F.col("data").alias("q")), "b")
    both = right.join(sets.select(F.col("node").alias("a"), F.col("data").alias("p")), "a")
    return both.select("a", "b", "p", "q").mapInArrow(run, "a long, b long")


def reaches(p: bytes, q: bytes, percent: int) -> bool:
    """Binary-probe the smaller set in the larger, a block at a time, until
    the overlap is decided."""
    x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    need, hits = -(-percent * (len(x) + len(y)) // (100 + percent)), 0
    step = max(PROBES, len(x) // 8)
    for a in range(0, len(x), step):
        if hits + len(x) - a < need:
            return False
        at = np.searchsorted(y, x[a:a + step])
        at[at == len(y)] = 0
        hits += int((y[at] == x[a:a + step]).sum())
    return hits >= need


def head(s: np.ndarray, long: np.ndarray, percent: int) -> bytes:
    """Size, and the first part of a set in list order as 32-bit keys: twice
    the prefix, so an unlike pair shows more misses than a link allows."""
    order, short = _ordered(s, long)
    key = (order >> _U(33)).astype(np.uint32)
    key[short:] |= np.uint32(1 << 31)
    cut_at = min(len(s), 2 * (len(s) - _least_overlap(len(s), percent) + 1))
    return np.append(np.array([len(s), cut_at == len(s)], np.uint32), key[:cut_at]).tobytes()


def heads_allow(p: bytes, q: bytes, percent: int) -> bool:
    """Whether the misses among the shingles that both heads cover leave T in reach."""
    x, y = np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32)
    (nx, all_x), (ny, all_y), x, y = x[:2].tolist(), y[:2].tolist(), x[2:], y[2:]
    end = min(np.inf if all_x else x[-1], np.inf if all_y else y[-1])
    x, y = x[x <= end], y[y <= end]
    need = -(-percent * (nx + ny) // (100 + percent))
    return (nx - int((~np.isin(x, y)).sum()) >= need) and (ny - int((~np.isin(y, x)).sum()) >= need)


def overlaps(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Shingles in common of each of the ``first`` sets with each of all."""
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    column = np.cumsum(n > 1) - 1
    row, at = row[n[at] > 1], column[at[n[at] > 1]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((first, len(sets)), np.int64)
    for c in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        lo, hi = np.searchsorted(at, (c, c + COLUMNS))
        m = np.zeros((len(sets), COLUMNS), np.float32)             # sums below 2^24 are exact
        m[row[lo:hi], at[lo:hi] - c] = 1
        out += (m[:first] @ m.T).astype(np.int64)
    return out


_KEY = ["component", "band", "i", "j", "spans"]
_COUNTED_T = [("node", pa.int64()), ("n_links", pa.int64())]
_PAIRS_T = [("a", pa.int64()), ("b", pa.int64())]


def link_blocks(percent: int, pairs: bool) -> Callable:
    """Sorted rows of pairs of blocks -> each record's weight of linked
    records (node, n_links), or the links (a, b)."""

    def linked(rows):
        node, weight, side = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2))
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        first = int((side == 0).sum())
        alone = first == len(rows)                    # one block against itself
        if not first or len(rows) < 2:
            return
        n = np.array([len(x) for x in sets], np.int64)
        need = -(-percent * (n[:first, None] + n[None, :]) // (100 + percent))
        ok = overlaps(sets, first) >= need
        ok[:, :first] = np.triu(ok[:, :first], 1) if alone else False
        x, y = np.nonzero(ok)
        if pairs:
            for a in range(0, len(x), 100_000):
                ends = node[x[a:a + 100_000]], node[y[a:a + 100_000]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))], ["a", "b"])
            return
        total = np.zeros(len(rows), np.int64)
        np.add.at(total, x, weight[y])
        np.add.at(total, y, weight[x])
        yield pa.RecordBatch.from_arrays([pa.array(node[total > 0]), pa.array(total[total > 0])], ["node", "n_links"])

    def run(stream):
        at, held = None, []
        for b in stream:
            keys = zip(*(b.column(k).to_pylist() for k in range(5)))
            rows = zip(*(b.column(k).to_pylist() for k in (5, 6, 7)), b.column(8))
            for key, (node, weight, side, data) in zip(keys, rows):
                if key != at:
                    yield from linked(held) if held else ()
                    at, held = key, []
                held.append((node, weight, side, data.as_py()))
        yield from linked(held) if held else ()
        yield _batch(_PAIRS_T if pairs else _COUNTED_T, [])
    return run


def block_pairs(records: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (key, node, texts, side, data) of all pairs of blocks whose records
    can be linked, sorted by key.  ``records``: node, n, texts and component; one
    that fits one block is one, whatever its sizes."""
    wide = math.log(100 / percent) + 1e-4             # a little more than a link allows
    c = records.withColumn("own", F.floor(F.log(F.col("n").cast("double")) / F.lit(wide)).cast("int"))
    blocks = F.ceil(F.greatest(F.sum("c") / BLOCK_ROWS, F.sum("s") / BLOCK_SHINGLES)).cast("int")
    bands = (c.groupBy("component", "own").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
              .groupBy("component").agg(blocks.alias("all"), F.map_from_entries(F.collect_list(F.struct(
                  "own", F.ceil(F.greatest(F.col("c") / BLOCK_ROWS, F.col("s") / BLOCK_SHINGLES)).cast("int")))).alias("bands")))
    c = c.join(bands, "component")
    c = (c.withColumn("own", F.when(F.col("all") == 1, 0).otherwise(F.col("own")))
          .withColumn("bands", F.when(F.col("all") == 1, F.create_map(F.lit(0), F.lit(1))).otherwise(F.col("bands")))
          .withColumn("block", F.pmod(F.xxhash64("node"), F.element_at("bands", F.col("own"))).cast("int")))

    def copies(step, part):
        n = F.coalesce(F.try_element_at("bands", F.col("own") + step), F.lit(0))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), part)).otherwise(F.array())

    def key(band, i, j, spans, side):
        return F.struct(band.cast("int").alias("band"), i.alias("i"), j.alias("j"), F.lit(spans).alias("spans"),
                        side.cast("int").alias("side"))

    own, block = F.col("own"), F.col("block")
    inside = copies(0, lambda x: key(own, F.least(x, block), F.greatest(x, block), False, F.when(block > x, 1).otherwise(0)))
    up = copies(1, lambda x: key(own, block, x, True, F.lit(0)))
    down = copies(-1, lambda x: key(own - 1, x, block, True, F.lit(1)))
    rows = (c.join(sets, "node")
             .select("component", "node", "texts", "data", F.explode(F.concat(inside, up, down)).alias("k"))
             .select("component", "k.band", "k.i", "k.j", "k.spans", "node", "texts", "k.side", "data"))
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *_KEY).sortWithinPartitions(*_KEY, "side")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    percent: int = 85, complete: bool = True) -> tuple[DataFrame, DataFrame]:
    """(members, links).  members: doc_id, text_key (hash of the text), node
    (class, NULL without a set), group (the component's least class),
    n_shingles, component_id and n_links of every row, the number of other
    texts that its text is linked with (texts of equal sets are); links: all
    linked pairs of classes (a < b).  Not ``complete``: no n_links, and only
    links that tie the components."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                        ).withColumn("text_key", F.xxhash64("text"))
    seen = cut(texts.select("doc_id", "text_key", "text").mapInArrow(giving_back(count_lists(words)), _SEEN))
    rows = seen.filter("slice IS NULL").select("doc_id", "text_key", "node", "n")
    classes = cut(seen.filter("node IS NOT NULL").groupBy("node")      # read by several jobs
                      .agg(F.min("text_key").alias("text_key"), *(F.first(c, True).alias(c) for c in ["n", *SIGNS])))
    signs = classes.select("node", "n", *SIGNS)
    long = spark.sparkContext.broadcast(long_lists(seen.filter("slice IS NOT NULL")))   # 2^COUNTERS_LOG2 flags

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = (texts.select("text").mapInArrow(giving_back(postings(long, words, percent)), "h long, node long, n int, short int")
                  .repartition(parts, "h").sortWithinPartitions("h", "short", "n", "node"))
    merged = cut(lists.mapInArrow(giving_back(merge_lists(long, percent)), _MERGED))
    full = lambda s: s.tobytes()

    stars = cut(_signed(merged.filter("h IS NULL").select("a", "b").distinct(), signs, percent))
    star_sets = sets_of(texts, classes, _nodes(stars), words, full)
    star_links = cut(_paired(stars, star_sets, lambda p, q: reaches(p, q, percent)))
    tied = cut(connected_components(star_links))

    rest = cut(_rest(merged.filter("h IS NOT NULL"), tied, signs, percent))
    rest_heads = sets_of(texts, classes, _nodes(rest), words, lambda s: head(s, long.value, percent))
    rest = cut(_paired(rest, rest_heads, lambda p, q: heads_allow(p, q, percent)))
    rest_sets = sets_of(texts, classes, _nodes(rest), words, full)
    rest_links = cut(_paired(rest, rest_sets, lambda p, q: reaches(p, q, percent)))
    links = star_links.unionByName(rest_links)

    tied = cut(connected_components(links))
    records = (rows.filter("node IS NOT NULL").groupBy("node", "text_key").agg(F.first("n").alias("n"), F.min("doc_id").alias("least"))
                   .groupBy("node").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("texts"), F.min("least").alias("least")))
    grouped = cut(records.join(tied, "node", "left").withColumn("group", F.coalesce("component", "node")))
    least = grouped.groupBy(F.col("group").alias("_group")).agg(F.min("least").alias("component_id"))
    named = salted_join(grouped.select("node", "texts", "group"), least, "group", "_group", salt_cols=["node"]).drop("_group")
    if complete:
        sets = sets_of(texts, classes, tied.select("node"), words, full)
        paired = block_pairs(grouped.filter("component IS NOT NULL").select("node", "n", "texts", "component"), sets, percent)
        counted = (paired.mapInArrow(giving_back(link_blocks(percent, False)), "node long, n_links long")
                         .groupBy("node").agg(F.sum("n_links").alias("linked")))
        named = (named.join(counted, "node", "left")
                      .withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("texts") - 1).drop("linked"))
    named = cut(named.drop("texts").withColumnRenamed("node", "_node"))
    members = salted_join(rows, named, "node", "_node", salt_cols=["doc_id", "text_key"])
    members = members.select("doc_id", "text_key", "node", "group", F.col("n").cast("long").alias("n_shingles"),
                             F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                             *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if complete else []))
    return members, paired.mapInArrow(link_blocks(percent, True), "a long, b long") if complete else links


def _rest(members: DataFrame, tied: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Candidates between components: in each list of three and more, the
    members outside its main component against all members of others.  A
    list's rows are dealt into blocks of bounded size, by node, and each block
    of the one side meets each of the other."""
    m = (members.withColumnRenamed("a", "node").drop("b").join(tied, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
    blocks = lambda c: F.ceil(c / LIST_ROWS).cast("int")
    main = (m.groupBy("h", "component").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("h").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("k"),
                               blocks(F.sum("c") - F.max("c")).alias("odd"), blocks(F.sum("c")).alias("all"))
             .filter("k > 1").drop("k"))
    m = m.join(main, "h").join(signs.drop("n"), "node")
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    values = ["node", "n", "short", "component", *SIGNS]
    odd = (m.filter("component != main").withColumn("i", own("odd")).withColumn("j", each("all"))
            .select("h", "i", "j", *[F.col(c).alias(f"x_{c}") for c in values]))
    all_ = m.withColumn("j", own("all")).withColumn("i", each("odd")).select("h", "i", "j", "main", "long", *values)
    need = F.ceil(percent * (F.col("n") + F.col("x_n")) / (100 + percent))
    reach = F.least("n", "x_n") >= need
    both_long = F.least(F.col("n") - F.col("short"), F.col("x_n") - F.col("x_short")) >= need
    return (odd.join(all_, ["h", "i", "j"])
               .filter((F.col("component") != F.col("x_component"))
                       & ((F.col("component") == F.col("main")) | (F.col("node") < F.col("x_node")))
                       & F.when(F.col("long"), both_long).otherwise(reach)
                       & _signs_allow(F.col("n"), F.col("x_n"), [F.col(c) for c in SIGNS], [F.col(f"x_{c}") for c in SIGNS], percent))
               .select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct())


def keep_one(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (NULL last),
    then the smallest text hash.  Rows without a set all stay."""
    members, _ = near_duplicates(docs, words=words, percent=percent, complete=False)
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_key")
    rows = (members.groupBy("group", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies")))
    least = rows.filter("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("least"))
    kept = rows.join(least, "group", "left").filter(
        F.col("group").isNull() | (F.col("text_key").eqNullSafe(F.col("least.text_key"))
                                   & F.col("doc_id").eqNullSafe(F.col("least.doc_id"))))
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
                       ((F.col("copies") > 1) & F.col("group").isNotNull()).alias("_repeated"))
    named = docs.withColumn("_own", F.xxhash64(F.col("text").cast("string")))
    joined = named.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key")))
    once = joined.filter("_repeated").dropDuplicates(["_id", "_key"])
    return joined.filter("NOT _repeated").unionByName(once).select(*docs.columns)
