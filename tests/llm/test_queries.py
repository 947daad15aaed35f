import base64
import importlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from checks.compare import difference, duck
from stridelake.llm import mixing, quality, queries, secrets
from stridelake.llm.common import connected, id_bitmap, in_bitmap
from stridelake.session import materialize
from tests.llm.data import documents, empty, rows_of
from tests.llm.test_jaccard import brute

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.CHECKS.items() if sql])
def test_query_equals_its_sql(spark, name):
    query, sql = queries.CHECKS[name]
    assert not difference(query(spark, SMALL), duck(SMALL), sql)


#: The test that holds each query without SQL against a plain model.
WITHOUT_SQL = {
    "op1_karmarkar_karp_shards": "test_sharding.test_query",
    "op2_permutation_index_search": "test_vectors.test_ann_recall_and_scores",
    "op6_byte_bpe_round_trip": "test_bpe.test_round_trip_digests",
    "op7_weak_label_quality": "test_classifiers.test_scores_against_a_plain_model",
    "op9_string_kernel_language": "test_classifiers.test_held_out_languages",
    "op11_bin_completion_packing": "test_packing.test_query",
    "op12_head_tail_resampling": "test_resampling.test_query",
}


def test_queries_without_sql_have_a_test():
    assert set(WITHOUT_SQL) == {n for n, (_, sql) in queries.CHECKS.items() if not sql}
    for name in WITHOUT_SQL.values():
        module, test = name.split(".")
        assert callable(getattr(importlib.import_module(f"tests.llm.{module}"), test))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert connected(df.where("false")).count() == 0


def test_bitmap_holds_every_id(spark):
    ids = spark.createDataFrame([(i * 37,) for i in range(500)] + [(None,)], "id long")
    from pyspark.sql import functions as F

    bits = ids.where("id IS NOT NULL").select(
        F.pmod(F.xxhash64("id"), F.lit(1 << 12)).alias("b")).toPandas()["b"].to_numpy()
    assert in_bitmap(id_bitmap(ids, 1 << 12), bits).all()


def test_pipeline_stage_by_stage(spark):
    """Each stage against a plain model of it, on what its predecessor kept."""
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, ""), "stage")
        kept[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out

    before, after = kept["quality_classifier"]
    good = {(r.doc_id, r.accept) for r in quality.classify(before).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, ok in good if ok}

    before, after = kept["ngram_jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {c for i, _, c in brute([r for r in rows if r[0] != 110]) if i is not None}
    assert {r.doc_id for r in after.collect() if r.doc_id not in (None, 110)} == want
    # Different texts of one id are no copies of each other.
    assert {r.text for r in after.where("doc_id = 110").collect()} == {
        t for i, t in rows if i == 110}

    before, after = kept["secret_scan"]
    assert after.count() == before.count()
    assert secrets.report(after).where("spans <> ''").count() == 0
    assert after.where("n_chars <> char_length(text)").count() == 0

    before, after = kept["target_weight_mixing"]
    chosen = mixing.mix(before).where("kept")
    assert rows_of(after, "doc_id") == rows_of(chosen, "doc_id") and 0 < after.count()
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}

    before, after = kept["byte_bpe_encoding"]
    ranks = {base64.b64decode(a): int(b) for a, b in map(
        bytes.split, open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb"))}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(((r.doc_id is None, r.doc_id, r.lang, r.source, library.encode_ordinary(r.text or ""))
                   for r in before.collect()), key=str)
    got = sorted(((r.doc_id is None, r.doc_id, r.lang, r.source, r.ids) for r in after.collect()),
                 key=str)
    assert got == want and after.where("size(ids) <> n_tokens").count() == 0


def test_pipeline_of_an_empty_table(spark):
    docs = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), "stage")
    assert docs.count() == 0
