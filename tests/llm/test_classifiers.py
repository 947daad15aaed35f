import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from stridelake.llm import language, quality
from stridelake.llm.common import table
from tests.llm.data import documents, empty

SF = "/root/testdata/sf0.01"


def test_em_finds_the_good_and_the_bad_labeller():
    rng = random.Random(1)
    accuracy = [0.95, 0.9, 0.9, 0.85, 0.8, 0.55, 0.9, 0.9]
    counts, right = {}, {}
    for _ in range(4000):
        good = rng.random() < 0.75
        pattern = []
        for a in accuracy:
            vote = (1 if good else -1) * (1 if rng.random() < a else -1)
            pattern.append(vote if rng.random() < 0.8 else 0)
        code = quality._code(pattern)
        counts[code] = counts.get(code, 0) + 1
        right.setdefault(code, []).append(good)
    model = quality.estimate(counts)
    found = list(model.accuracies().values())
    assert all(abs(f - a) < 0.05 for f, a in zip(found, accuracy)) and abs(model.prior - 0.75) < 0.05
    hits = sum((model.posterior[c] >= 0.5) == g for c, gs in right.items() for g in gs)
    assert hits / 4000 > 0.95


def test_quality_against_labels(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    scored = quality.classify(docs).join(labels, "doc_id").select("accept", "quality").collect()
    good = [r.accept for r in scored if r.quality == 1]
    junk = [r.accept for r in scored if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(junk) / len(junk) < 0.2


def test_quality_of_awkward_documents(spark):
    docs = documents(spark)
    rows = quality.classify(docs).collect()
    assert len(rows) == docs.count()
    score = {r.doc_id: r for r in rows}
    assert not score[105].accept and not score[106].accept and score[107].score == 0
    assert quality.classify(empty(spark)).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in rows if r.accept)


def test_signals_do_not_depend_on_slices(monkeypatch):
    text = ("Some Words, here | %%% 12 12 end. " * 50).encode()
    whole = quality.signals(text)
    monkeypatch.setattr(quality, "SLICE", 97)
    parts = quality.signals(text)
    assert whole[1] == parts[1] and abs(whole[0] - parts[0]).max() < 1e-12


def test_features_are_those_of_the_definition(monkeypatch):
    values = quality.signals(b"Some words here.")[0]
    for text in (b"", b"a", b"ab", b"abc", b"Some Words, here | %%% 12 12 end. " * 40):
        want = Counter((int.from_bytes(text[i:i + 3]) * 0x9E3779B1 & 0xFFFFFFFF) >> 17
                       for i in range(len(text) - 2))
        for size in (1 << 20, 7, 1):
            monkeypatch.setattr(quality, "SLICE", size)
            hit, shares, bins = quality.features(text, values)
            assert {int(h): round(s * max(1, len(text) - 2)) for h, s in zip(hit, shares)} == want
            assert len(bins) == len(values) and bins.max() < quality.FEATURES


def test_scores_against_a_plain_model(spark):
    """Votes, posteriors and the scorer's sums, stated once more without arrays."""
    docs = documents(spark).select("doc_id", "text")
    model = quality.fit(docs)
    got = {(r.doc_id, r.text): (r.p_label, r.score, r.accept) for r in quality.score(
        docs, model, "text", ("doc_id", "text")).collect()}
    for r in docs.collect():
        data = (r.text or "").encode()
        if not data.strip():
            assert got[r.doc_id, r.text] == (0.0, 0.0, False)
            continue
        values, words = quality.signals(data)
        label = model.labels.posterior.get(quality._code(quality.votes(values, words)),
                                           model.labels.prior)
        grams = [(int.from_bytes(data[i:i + 3]) * 0x9E3779B1 & 0xFFFFFFFF) >> 17
                 for i in range(len(data) - 2)]
        total = sum(model.weights[g] for g in grams) * quality.TEXT_SCALE / max(1, len(grams))
        total += sum(model.weights[quality.FEATURES + b] for b in quality.features(data, values)[2])
        total += model.weights[-1]
        want = 1 / (1 + math.exp(-max(-30, min(30, total))))
        assert got[r.doc_id, r.text][0] == label
        assert abs(got[r.doc_id, r.text][1] - want) < 1e-9
        assert got[r.doc_id, r.text][2] == (got[r.doc_id, r.text][1] >= 0.5)


def test_clashing_names_are_kept(spark):
    docs = documents(spark).withColumns({
        "_text": F.lit("t"), "_quality_accept": F.lit("a"), "score": F.lit("s")})
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() > 0
    assert kept.where("_text <> 't' OR _quality_accept <> 'a' OR score <> 's'").count() == 0


def test_held_out_languages(spark):
    docs = table(spark, SF, "documents")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_languages_of_held_out_rows_are_never_read(spark):
    docs = table(spark, SF, "documents").limit(300)
    held = language.is_training(F.col("doc_id")) == F.lit(False)
    swapped = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, language.identify(docs).collect())) == sorted(
        map(tuple, language.identify(swapped).collect()))


def test_awkward_languages(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in language.identify(docs).collect()}
    assert rows[105].lang_pred == rows[106].lang_pred == rows[107].lang_pred == "und"
    assert rows[105].score == 0 and language.identify(docs).count() == docs.count()
    assert language.identify(empty(spark)).count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(none).collect()} == {"und"}


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Ein Satz über Grüße, 中文 and more. " * 40
    whole = language.present(text)
    monkeypatch.setattr(language, "SLICE", 50)
    assert (language.present(text) == whole).all()


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    monkeypatch.setattr(language, "LEARNED", 2, raising=False)
    docs = table(spark, SF, "documents").where("doc_id % 2 = 0")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count()
    assert {r.lang_pred for r in held} == {r.lang for r in held}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_more_languages_than_fit_one_pass(spark):
    rng = random.Random(4)
    rows = []
    for i in range(420):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
                 for _ in range(4)]
        rows += [(i * 10 + j, f"l{i:03}", " ".join(words)) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(8)
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.98
