"""The corpus pipeline: judge, deduplicate, redact, mix and encode documents.

Each stage is written as Parquet to the shared folder and read again as the next one's input, so a
lost executor repeats work of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.llm import bpe, jaccard, mixing, quality, secrets
from stridelake.llm.common import table
from stridelake.session import configure, materialize

VOCABULARY = "byte_bpe_50k.tiktoken"
BATCH = "2m"  # of Arrow data; workers of five stages share an executor's memory


def prepare(spark: SparkSession) -> None:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    prepare(spark)
    return quality.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    prepare(spark)
    return jaccard.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced and ``n_chars`` counted anew."""
    prepare(spark)
    clean = secrets.redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.char_length("text").cast(kind))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics meet their target weights."""
    prepare(spark)
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``: the token ids of each document's text."""
    prepare(spark)
    encoded = bpe.encode(
        docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN,
        keep=("doc_id", "lang", "source"))
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", judge),
    ("ngram_jaccard_join", deduplicate),
    ("secret_scan", redact),
    ("target_weight_mixing", mix),
    ("byte_bpe_encoding", encode),
]

ORACLE_SQL = None  # the classifier's training cannot be said in SQL; tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
