"""Toxic spans by a linear-chain conditional random field.

Labels mark documents, the field tags words.  Training (on a bounded,
documented sample of labelled rows): words whose share of toxic documents
stands out label the tokens of toxic documents; the field learns word,
prefix, suffix and shape features and the transitions between outside and
toxic; its own tags replace the first labels once, so variants that the word
list missed are learned too.  Scoring: forward-backward gives every word's
marginal; a document's expected number and share of toxic words and its
highest marginal enter a logistic score, and words with a marginal of at
least one half give the offending offsets.  A sequence is a run of SEQUENCE
words of one document.

Defined cases: NULL text counts as empty and gets the score of a text
without toxic words; a missing label teaches nothing; a document labelled
more than once is toxic if any label says so; without toxic or without clean
labelled documents every score is the share of toxic ones; an empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import _batch
from .common import batches, giving_back, held_out

SEQUENCE, HASH_BITS, CHARS, KEPT_WORDS = 64, 18, 1_000_000, 400_000
_EDGE = re.compile(r"^\W+|\W+$")
_WORD = re.compile(r"\S+")


def features(word: str) -> list[int]:
    """Hashed features of a white-space delimited word."""
    w = _EDGE.sub("", word).lower()
    names = ["bias", f"w={w}", f"s3={w[-3:]}", f"n={min(len(w), 12)}",
             f"c={'u' if word.isupper() else 't' if word.istitle() else 'l'}{'d' if any(x.isdigit() for x in w) else ''}"]
    names += [f"p{n}={w[:n]}" for n in (3, 4, 5, 6, 7, 8) if len(w) >= n]
    return [zlib.crc32(x.encode()) & ((1 << HASH_BITS) - 1) for x in names]


class Field:
    """Two-state chain: weights of the toxic state's features and the
    log-potentials of staying, entering and leaving it."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves          # moves: O-O, O-T, T-O, T-T


def sequences(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(cell, mask): where each token goes in a SEQUENCE x sequences grid."""
    rows = np.array([-(-n // SEQUENCE) for n in sizes], int)
    first = np.cumsum(rows) - rows
    total = int(rows.sum())
    nth = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.empty(0, int)
    row = np.repeat(first, sizes) + nth // SEQUENCE
    cell = (nth % SEQUENCE) * total + row
    mask = np.zeros(total * SEQUENCE, bool)
    mask[cell] = True
    return cell, mask.reshape(SEQUENCE, total)


def marginals(emission: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all sequences at once.

    ``emission`` (length x sequences) is the toxic state's score against the
    outside state's 0; of two states only the odds need to be carried.
    Returns the toxic marginals and the pair marginals summed by move.
    """
    oo, ot, to, tt = np.exp(moves)
    e = np.exp(np.clip(emission, -30, 30))
    fwd, back = np.empty_like(e), np.ones_like(e)
    for t in range(len(e)):
        fwd[t] = e[t] * ((ot + tt * fwd[t - 1]) / (oo + to * fwd[t - 1]) if t else 1.0)
    for t in range(len(e) - 1, 0, -1):
        right = e[t] * back[t]
        back[t - 1] = np.where(mask[t], (to + tt * right) / (oo + ot * right), 1.0)
    odds = fwd * back
    left, right, on = fwd[:-1], (e * back)[1:], mask[1:]
    joint = np.stack([np.full_like(left, oo), ot * right, to * left, tt * left * right])
    pairs = ((joint / joint.sum(0)) * on).sum((1, 2))
    return np.where(mask, odds / (1 + odds), 0.0), pairs


def train_field(docs: list[list[str]], tags: list[np.ndarray], start: Field | None = None, rounds: int = 40,
                rate: float = 0.2, decay: float = 1e-5) -> Field:
    """Maximum likelihood by Adam over the distinct words' feature table."""
    words = sorted({w for d in docs for w in d})
    number = {w: i for i, w in enumerate(words)}
    table = [features(w) for w in words]
    row = np.repeat(np.arange(len(table)), [len(f) for f in table])
    col = np.concatenate([np.array(f) for f in table])
    token = np.concatenate([np.fromiter((number[w] for w in d), int, len(d)) for d in docs])
    gold = np.concatenate(tags).astype(float)
    cell, mask = sequences([len(d) for d in docs])
    grid = lambda x: np.bincount(cell, x, mask.size).reshape(mask.shape)
    y = grid(gold).astype(int)
    gold_moves = np.bincount((2 * y[:-1] + y[1:])[mask[1:]], minlength=4).astype(float)
    theta = np.append(start.weights, start.moves) if start else np.zeros((1 << HASH_BITS) + 4)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        score = np.bincount(row, theta[col], len(words))
        p, pairs = marginals(grid(score[token]), mask, theta[-4:])
        diff = np.bincount(token, gold - p.ravel()[cell], len(words))
        grad = np.append(np.bincount(col, diff[row], 1 << HASH_BITS), gold_moves - pairs) / len(docs) - decay * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        theta = theta + rate * (m1 / (1 - 0.9 ** k)) / (np.sqrt(m2 / (1 - 0.99 ** k)) + 1e-6)
    return Field(theta[:-4], theta[-4:])


class _Emissions(dict):
    """word -> emission, computed when first met."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        out = self[word] = float(self.weights[features(word)].sum())
        return out


class Scorer:
    """The field and the logistic that turns marginals into a score."""

    def __init__(self, field: Field | None, logistic: np.ndarray, prior: float):
        self.field, self.logistic, self.prior, self.known = field, logistic, prior, None

    def tag(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Each document's toxic marginals."""
        if self.known is None or len(self.known) > KEPT_WORDS:
            self.known = _Emissions(self.field.weights)
        cell, mask = sequences([len(d) for d in docs])
        flat = np.full(mask.size, -30.0)
        flat[cell] = np.fromiter((x for d in docs for x in map(self.known.__getitem__, d)), float, len(cell))
        p, _ = marginals(flat.reshape(mask.shape), mask, self.field.moves)
        return np.split(p.ravel()[cell], np.cumsum([len(d) for d in docs])[:-1])

    @staticmethod
    def summary(p: np.ndarray) -> list[float]:
        total = p.sum()
        return [1.0, np.log1p(total), np.log1p(100 * total / max(1, len(p))), p.max(initial=0.0)]

    def score(self, docs: list[list[str]]) -> tuple[list[float], list[np.ndarray]]:
        if self.field is None:
            return [self.prior] * len(docs), [np.zeros(len(d)) for d in docs]
        tagged = self.tag(docs)
        x = np.array([self.summary(p) for p in tagged])
        return (1 / (1 + np.exp(-np.clip(x @ self.logistic, -30, 30)))).tolist(), tagged


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Newton steps with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        beta = beta + np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * beta)
    return beta


def _sample(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled rows outside the held-out fifth, one per text, at most
    ``per_class`` of each label; and the numbers of such rows by label."""
    lab = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
                 .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & (F.length("text") <= max_chars)) \
                 .withColumn("h", F.xxhash64("text"))
    # only ids and hashes are joined and ranked; the texts of the chosen few are fetched at the end
    rows = usable.select("doc_id", "h").join(lab, "doc_id").groupBy("h", "toxic").agg(F.min("doc_id").alias("doc_id"))
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = F.coalesce(*[F.when(F.col("toxic") == k, F.lit(n)) for k, n in counts.items()], F.lit(0))
    thin = (F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) * size < 1.25 * per_class
    best = W.partitionBy("toxic").orderBy("h")
    chosen = (rows.filter(thin).withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= per_class)
                  .select("doc_id", "h", "toxic"))
    texts = usable.join(F.broadcast(chosen), ["doc_id", "h"])            # per_class rows a label
    return texts.groupBy("h", "toxic").agg(F.first("text").alias("text")).select("text", "toxic"), counts


def toxic_words(docs: list[set[str]], y: np.ndarray, min_share: float, odds: float, enough: int = 6) -> set[str]:
    """Words that mark toxic documents, by greedy cover.

    Of the words whose odds stand out, the one in most toxic documents that
    do not yet hold ``enough`` chosen words is chosen, until none is in
    ``min_share`` of them; so what near copies of one toxic document share by
    chance is not chosen, its real toxic words being chosen before.
    """
    nt, nc = int(y.sum()), int(len(y) - y.sum())
    clean, left = Counter(), Counter()
    for d, x in zip(docs, y):
        (left if x else clean).update(d - {""})
    least = min(max(3, min_share * nt), nt)
    left = {w: t for w, t in left.items()
            if t >= least and ((t + 0.5) / (nt + 1)) / ((clean[w] + 0.5) / (nc + 1)) >= odds}
    holders: dict[str, list[int]] = {w: [] for w in left}
    toxic = [d & left.keys() for d, x in zip(docs, y) if x]
    for i, d in enumerate(toxic):
        for w in d:
            holders[w].append(i)
    held, chosen = [0] * len(toxic), set()
    while left:
        best = max(left, key=lambda w: (left[w], w))
        if left.pop(best) < least:
            break
        chosen.add(best)
        for i in holders[best]:
            held[i] += 1
            if held[i] == enough:
                for w in toxic[i] & left.keys():
                    left[w] -= 1
    return chosen


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 1200, max_chars: int = 20_000,
          min_share: float = 0.01, odds: float = 8.0) -> Scorer:
    """Learn from at most ``per_class`` labelled documents of each class of at
    most ``max_chars`` code points.  One task trains on that sample; the driver
    receives the scorer (2^HASH_BITS weights) only."""
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sample, counts = _sample(d, labels.select("doc_id", "toxic"), per_class, max_chars)

    def train(stream):
        rows = [r for b in stream for r in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(sorted(rows), counts, min_share, odds))],
                                                   pa.binary())], ["scorer"])

    trained = sample.repartition(1).mapInArrow(giving_back(train), "scorer binary").first()
    return pickle.loads(trained.scorer) if trained else fit([], counts, min_share, odds)


def fit(rows: list[tuple[str, int]], counts: dict[int, int], min_share: float = 0.01, odds: float = 8.0) -> Scorer:
    """The scorer of a labelled sample; ``counts`` are the labels' full numbers."""
    words = [t.split() for t, _ in rows]
    y = np.array([float(x > 0) for _, x in rows])
    total = sum(counts.values())
    prior = sum(n for k, n in counts.items() if k > 0) / total if total else 0.0
    if y.sum() < 1 or y.sum() == len(y):
        return Scorer(None, np.zeros(4), prior)
    plain = [[_EDGE.sub("", w).lower() for w in d] for d in words]
    toxic = toxic_words([set(d) for d in plain], y, min_share, odds)
    tags = [np.array([x > 0 and w in toxic for w in d], bool) for d, x in zip(plain, y)]
    keep = [i for i, d in enumerate(words) if d]
    words, tags, y = [words[i] for i in keep], [tags[i] for i in keep], y[keep]
    scorer = Scorer(train_field(words, tags), np.zeros(4), prior)
    p = scorer.tag(words)
    tags = [(q >= 0.5) & (x > 0) for q, x in zip(p, y)]
    scorer = Scorer(train_field(words, tags, scorer.field, rounds=25), np.zeros(4), prior)
    x = np.array([scorer.summary(q) for q in scorer.tag(words)])
    share = {k: n / total for k, n in ((0.0, total * (1 - prior)), (1.0, total * prior))}
    weight = np.where(y > 0, share[1.0] / y.sum(), share[0.0] / (len(y) - y.sum())) * len(y)
    scorer.logistic = fit_logistic(x, y, weight)
    scorer.known = None
    return scorer


_RESULT_T = [("doc_id", pa.int64()), ("score", pa.float64()), ("n_toxic", pa.int32()),
             ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
_RESULT = "score double, n_toxic int, spans array<struct<start:int,end:int>>"


def _spans(text: str, p: np.ndarray) -> list[dict]:
    if not (p >= 0.5).any():
        return []
    return [{"start": m.start(), "end": m.end()} for m, x in zip(_WORD.finditer(text), p) if x >= 0.5]


def score_texts(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, number of toxic words and their offsets (code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)     # 2^HASH_BITS weights

    def run(stream):
        own = shared.value
        rows = ((i, t.as_py() or "") for b in stream for i, t in zip(b.column(0).to_pylist(), b.column(1)))
        for some in batches(rows, lambda r: len(r[1]) + 20, CHARS):
            score, tagged = own.score([t.split() for _, t in some])
            yield _batch(_RESULT_T, [(i, s, int((p >= 0.5).sum()), _spans(t, p))
                                     for (i, t), s, p in zip(some, score, tagged)])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(giving_back(run), f"doc_id long, {_RESULT}"))


def append_scores(docs: DataFrame, scorer: Scorer, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each row in ``score_col``."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)     # 2^HASH_BITS weights
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(stream):
        for b in stream:
            texts, scores = b.column(b.schema.get_field_index(text_col)), []
            for some in batches(range(b.num_rows), lambda i: len(texts[i].as_py() or "") + 20, CHARS):
                scores += shared.value.score([(texts[i].as_py() or "").split() for i in some])[0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, score_col])

    return docs.mapInArrow(giving_back(run), schema)
