import random

import pytest

from stridelake.llm import jaccard
from tests.llm.data import documents, empty, rows_of


def brute(docs, percent=80, words=5):
    """Components by comparing all pairs of documents."""
    sets = []
    for doc_id, text in docs:
        w = text.encode().lower().split() if text else []
        sets.append((doc_id, {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}
                     if len(w) >= words else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i is None or j is None or i <= j or not a or not b:
                continue
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def near_copies(n, seed, edits=(0, 14)):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            at = rng.randrange(len(words))
            kind = rng.random()
            if kind < 0.4:
                words[at] = f"e{rng.randint(0, 50)}"
            elif kind < 0.7:
                del words[at]
            else:
                words = words[:max(60, at)]
        texts.append(" ".join(words))
    return texts


def test_awkward_documents(spark):
    docs = documents(spark).where("doc_id IS NULL OR doc_id <> 110")
    got = rows_of(jaccard.components(docs))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_ids_are_one_document(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame(
        [(5, text), (5, "quite another text of seven words here"), (9, text),
         (7, "quite another text of seven words here")], "doc_id long, text string")
    assert {r.component_id for r in jaccard.components(docs).collect()} == {5}


def test_empty_table(spark):
    assert jaccard.components(empty(spark)).count() == 0


@pytest.mark.parametrize(("seed", "block"), [(1, 1024), (2, 16)])
def test_graded_near_copies_lose_no_link(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = near_copies(130, seed) + near_copies(60, seed + 10, (0, 40)) + near_copies(
        40, seed, (8, 30))
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(jaccard.components(df)) == brute(docs)


def test_words_and_slices(monkeypatch):
    text = ("A b\tc  D\x0be " * 400 + "x" * 300 + " y").encode()
    whole = jaccard.shingles(text)
    words = text.lower().split()
    assert len(whole) == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})
    monkeypatch.setattr(jaccard, "SLICE", 100)
    assert (jaccard.shingles(text) == whole).all()
    assert (jaccard.shingles(b"a B c") == jaccard.shingles(b" A\nb C ")).all()


def test_keep_one(spark):
    docs = documents(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 100 in ids and 101 not in ids and 104 not in ids
    assert ids.count(3) == 1 and ids.count(None) == 2 and {105, 106, 107} <= set(ids)


def test_keep_one_goes_by_text_not_by_id(spark):
    def words(seed):
        rng = random.Random(seed)
        return " ".join(f"v{rng.randint(0, 10_000)}" for _ in range(40))

    many = [(50, words(i)) for i in range(30)]  # one id, thirty texts that resemble nothing
    rows = many + [
        (1, words(0)),                           # leads the first of them
        (60, words(100)), (60, words(100)), (60, words(100).upper()), (60, words(101)),
        (70, words(102)), (70, ""), (70, None), (70, None), (None, words(102))]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                                 "doc_id long, text string, other long")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text.lower() if r.text else r.text) for r in kept.collect()), key=str)
    assert got == sorted(many[1:] + [
        (1, words(0)), (60, words(100)), (60, words(101)), (70, words(102)), (70, ""),
        (70, None), (70, None), (None, words(102))], key=str)
    ids = [r.doc_id for r in jaccard.keep_one(documents(spark)).collect()]
    assert ids.count(110) == 2


def test_members_meet_their_components_once(spark):
    members = spark.createDataFrame(
        [(1, 5, 1, 5), (2, 5, 1, 4), (3, 5, 3, 5)], "node long, n long, grp long, overlap long")
    answered = spark.createDataFrame([(1, 3, 3)], "a long, b long, overlap long")
    found = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    sets = spark.createDataFrame(
        [(1, [1, 2, 3, 4, 5]), (2, [1, 2, 3, 4, 6]), (3, [1, 2, 3, 6, 7])],
        "node long, items array<long>")
    links = jaccard.open_links(members, answered, found, sets, 60)
    assert "LeftOuter" not in links._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(sorted(r)) for r in links.collect()} == {(2, 3)}


def one_task_in_batches(spark, texts, rows):
    """``texts`` with ids from 0, read by one task that hands ``rows`` of them to Python at a time."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return docs.selectExpr("doc_id", "cast(text AS binary) AS text")


def test_small_batches_add_no_rows(spark):
    """Shingle counts and postings are those of a task, so that batches may be as small as memory
    wants them."""
    texts = near_copies(12, 3) + near_copies(12, 3)
    default = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        docs = one_task_in_batches(spark, texts, 2)
        counts = jaccard.describe_sets(docs, 5).where("bucket IS NOT NULL")
        assert 0 < counts.count() == counts.select("bucket").distinct().count()
        described = jaccard.describe_sets(docs, 5).where("bucket IS NULL")
        assert described.count() == len(texts)
        members = described.selectExpr("sig", "doc_id AS grp").groupBy("sig").agg({"grp": "min"})
        order = jaccard.bucket_counts(jaccard.describe_sets(docs, 5))
        assert order.sum() == described.agg({"n": "sum"}).first()[0]
        index = jaccard.postings(
            docs, members.withColumnRenamed("min(grp)", "grp"), order, 5, 80)
        assert 0 < index.count() == index.distinct().count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", default)


def test_forgotten_sets_are_posted_again(spark, monkeypatch):
    """What a task remembers of copies decides the length of lists, never the result."""
    texts = near_copies(12, 5) * 2
    default = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(jaccard, "POSTED", 3)
    try:
        docs = one_task_in_batches(spark, texts, 4)
        assert rows_of(jaccard.components(docs)) == brute(list(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", default)
