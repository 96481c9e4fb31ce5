"""Corpus pipeline over ``documents``: toxic documents go, one document of
each near-duplicate group stays, secrets are masked, sources are mixed to
their target weights, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return
the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, jaccard, mixing, secrets, toxicity
from ledgerlake.llm.common import shared_path, table
from ledgerlake.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.5 go; the scorer learns from labels of
    documents of this input that are not held out."""
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.append_scores(docs, scorer, score_col="_toxicity").filter("_toxicity < 0.5").drop("_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join stays
    (five-word shingles, similarity of at least 0.8)."""
    return jaccard.keep_one(docs, words=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; no document goes."""
    return secrets.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.take_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every document."""
    return bpe.encode_documents(docs, tokenizer_path("byte_bpe_50k.json")).drop("decoded")


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_duplicates), ("secrets", mask_secrets),
          ("mixing", mix), ("bpe", encode)]

#: A trained tagger and a tokenizer file are not SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
