import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stridelake.llm import queries, resampling
from tests.llm.data import documents, empty

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(docs, target):
    s, t = Counter(), Counter()
    for counter, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counter.update(map(bucket, features(text)[0]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / (
        (s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        found, words = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, words >= 20))
    most = 25 * sum(r[4] for r in rows) // 100
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (
        -r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i for i, r in enumerate(drawn[:most], 1)}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def same(got, want):
    # Rows with one id and one score may share out their ranks either way.
    assert sorted((r[0] is None, r[0] or 0, r[3]) for r in got) == sorted(
        (r[0] is None, r[0] or 0, r[3]) for r in want)
    assert sorted((tuple(r[:4]) for r in got), key=key) == sorted(
        (tuple(r[:4]) for r in want), key=key)
    assert sorted((r[4], r[3], str(r[0])) for r in got if r[4]) == sorted(
        (r[4], r[3], str(r[0])) for r in want if r[4])


def test_awkward_rows_against_brute_force(spark):
    df = documents(spark)
    target = spark.createDataFrame(
        [("alphaa betab gammac",), (None,), ("",), ("Few WORDS few words 中文",)], "text string")
    got = resampling.resample(df.repartition(6), target).collect()
    same(got, brute([(r.doc_id, r.text) for r in df.collect()], [r.text for r in target.collect()]))


@pytest.mark.parametrize("words, pairs", [(1, 1), (5, 3), (20_000, 60_000)])
def test_the_head_changes_nothing(spark, monkeypatch, words, pairs):
    df = documents(spark)
    vocabulary = resampling.head(df.select("text"), 10_000, words, pairs)
    assert len(vocabulary.words) <= words and len(vocabulary.pairs) <= pairs
    totals = resampling.bucket_totals(
        resampling.features(df.select("doc_id", "text"), vocabulary))
    want = Counter()
    for r in df.collect():
        want.update(map(bucket, features(r.text)[0]))
    assert {b: n for b, n in enumerate(totals.tolist()) if n} == want


def test_long_texts_in_parts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 40)
    df = documents(spark, 5)
    vocabulary = resampling.Vocabulary([b"alphaa"], [], 10_000)
    rows = []
    for n, r in enumerate(df.collect()):
        parts = [p.tolist() for p in vocabulary.features((r.text or "").encode())]
        rows += [(n, r.doc_id, p) for p in parts or [[]]]
    assert len(rows) > df.count()
    found = spark.createDataFrame(rows, "row long, doc_id long, buckets array<int>")
    gains = resampling.np.arange(10_000)
    got = {r.row: (r.doc_id, r.n_features, r.weight) for r in resampling.weigh(
        found, gains).collect()}
    for n, r in enumerate(df.collect()):
        mine = list(map(bucket, features(r.text)[0]))
        assert got[n] == (r.doc_id, len(mine), sum(mine) // len(mine) if mine else 0)


def test_slices_of_a_text_join_up(monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 7)
    text = "One two, three four-five six seven eight nine ten eleven".encode()
    vocabulary = resampling.Vocabulary([b"two"], [(b"two", b"three")], 10_000)
    got = Counter(int(b) for part in vocabulary.features(text) for b in part)
    assert got == Counter(map(bucket, features(text.decode())[0]))


def test_many_equal_rows_get_every_rank(spark):
    text = " ".join(f"word{i}" for i in range(30))
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"),
        F.lit(text).alias("text"))
    rows = resampling.resample(df, df.limit(1).select("text")).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 751))


def test_empty_tables(spark):
    docs = documents(spark)
    nothing = empty(spark)
    assert resampling.resample(nothing, docs).count() == 0
    rows = resampling.resample(docs, nothing).collect()
    same(rows, brute([(r.doc_id, r.text) for r in docs.collect()], []))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    same(queries.resampled(spark, sf_dir).collect(),
         brute([(r.doc_id, r.text) for r in docs], [r.text for r in target]))
