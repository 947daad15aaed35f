"""The registered queries of this subpackage, with their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import (
    ann, bpe, collocations, jaccard, language, mixing, packing, quality, resampling, secrets,
    sharding, sql, topk, urls,
)
from stridelake.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 16)


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), k=10, every=100)


def highest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), k=5, every=50)


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def found_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "decided_by")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


CHECKS = {
    "op1_karmarkar_karp_shards": (shards, None),
    "op2_permutation_index_search": (neighbours, None),
    "op3_dual_tree_topk": (highest_scores, sql.HIGHEST_SCORES),
    "op4_raked_mixture": (mixture, sql.MIXTURE),
    "op5_ngram_jaccard_join": (components, sql.COMPONENTS),
    "op6_byte_bpe_round_trip": (round_trip, None),
    "op7_weak_label_quality": (judged, None),
    "op8_blob_ledger_secrets": (found_secrets, sql.SECRETS),
    "op9_string_kernel_language": (languages, None),
    "op10_link_graph_urls": (url_verdicts, sql.URL_VERDICTS),
    "op11_bin_completion_packing": (packed, None),
    "op12_head_tail_resampling": (resampled, None),
    "op13_prefix_free_collocations": (phrases, sql.COLLOCATIONS),
}
