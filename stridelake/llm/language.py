"""Language identification by string kernels.

Two texts are compared by the character n-grams they share: the blended spectrum kernel counts the
n-grams of several lengths that are present in both, divided by the root of the product of their
numbers. Landmark texts stand for the whole kernel (Nyström): kernel ridge regression, one language
against the rest, is solved for coefficients ``a`` of the landmarks in

    (K'K + lambda n W) a = K'Y

with K between training texts and landmarks, W among landmarks. K'K and K'Y are sums over training
texts, so tasks add them up. As presence vectors are 0/1 rows P, the kernel with all landmarks L is
the product P L' over norms, and scores of a batch are P (L' a): one matrix product with a table of
n-gram buckets by languages, which is all that the executors get. Languages are learned in blocks,
each with landmarks of its own, some of other languages and all training texts, and texts are scored in passes of at most
``LANGUAGES`` languages that hand on the best one so far, so no table grows with their number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.llm.common import lists, map_batches
from stridelake.session import discard, materialize

LENGTHS = (1, 2, 3, 4)
BUCKETS = 1 << 16
LANDMARKS = 128
LEAST_LANDMARKS = 4  # of a language, however many there are
PER_LANGUAGE = 600  # expected number of training texts of a language
LEARNED = 64  # languages that are solved for at once
LANGUAGES = 400  # whose scores are computed in one pass over the texts
RIDGE = 1e-4
UNDETERMINED = "und"
SLICE = 1 << 20


def present(text: str) -> np.ndarray:
    """The buckets of all n-grams of a whole text, each once. Letters are lowered."""
    seen = np.zeros(BUCKETS, bool)
    text = text.lower()
    for at in range(0, max(1, len(text)), SLICE):
        part = text[at:at + SLICE + max(LENGTHS) - 1]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        grams = np.zeros(len(points), np.uint32)
        for length in range(1, max(LENGTHS) + 1):
            if len(points) < length:
                break
            grams = grams[:len(points) - length + 1] * np.uint32(0x01000193) + points[length - 1:]
            if length in LENGTHS:
                mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * length)
                seen[mixed >> np.uint32(16)] = True
    return np.flatnonzero(seen)


def is_training(doc_id: Column) -> Column:
    """Whether a document may be learned from; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def _draw(docs: DataFrame, per_language: int) -> tuple[list[str], DataFrame | None]:
    """All languages by name, and a sample of their training texts as sets of n-grams."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        is_training(F.col("doc_id")))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("rows")).collect()
    if not counts:
        return [], None
    languages = sorted(row["lang"] for row in counts)
    shares = docs.sparkSession.createDataFrame(
        [(row["lang"], min(1.0, per_language / row["rows"])) for row in counts],
        "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    chosen = (
        labelled.withColumn("draw", draw).join(F.broadcast(shares), "lang")
        .where(F.col("draw") < F.col("share") * (1 << 30)).select("doc_id", "lang", "draw", "text"))

    def grams(columns):
        found = [present(t) for t in columns["text"].to_pylist()]
        ends = np.cumsum([0, *map(len, found)])
        return {"doc_id": columns["doc_id"], "lang": columns["lang"], "draw": columns["draw"],
                "grams": lists(ends, np.concatenate([*found, np.empty(0, np.int64)]).astype("i4"))}

    # The sample is bounded for each language, so their number alone tells the parts.
    sample = materialize(
        map_batches(chosen, grams, "doc_id long, lang string, draw long, grams array<int>")
        .repartition(max(8, -(-len(languages) // 8)), "draw"), "language-sample")
    return languages, sample


def _learn(
    sample: DataFrame, languages: list[str], each: int, others: int
) -> np.ndarray | None:
    """The table of scores by n-gram bucket of some of the languages, from ``each`` landmarks of
    each, at most ``others`` of the other languages and all texts of the sample; nothing if none of
    them has a text with an n-gram."""
    first = W.partitionBy("lang").orderBy("draw", "doc_id")
    own = F.col("lang").isin(languages)
    usable = sample.where(F.size("grams") > 0)
    marks = (
        usable.where(own).withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= each).orderBy("lang", "nth").select("grams").collect())
    if not marks:
        return None
    # What a text of a language outside the block looks like must be told apart, too.
    marks += usable.where(~own).orderBy("draw", "doc_id").limit(others).select("grams").collect()
    table = np.zeros((len(marks), BUCKETS), np.float32)
    for row, mark in zip(table, marks, strict=True):
        row[mark["grams"]] = 1 / np.sqrt(len(mark["grams"]))
    shared = sample.sparkSession.sparkContext.broadcast(table)

    def sums(columns):
        by_gram, m = shared.value.T, len(shared.value)
        target = {name: i for i, name in enumerate(languages)}
        kk, ky, n = np.zeros((m, m)), np.zeros((m, len(languages))), 0
        for lang, own in zip(columns["lang"].to_pylist(), columns["grams"], strict=True):
            own = own.values.to_numpy()
            if len(own):
                k = by_gram[own].sum(axis=0, dtype=np.float64) / np.sqrt(len(own))
                y = np.full(len(languages), -1.0)
                if lang in target:
                    y[target[lang]] = 1
                kk += np.outer(k, k)
                ky += np.outer(k, y)
                n += 1
        return {"kk": [kk.tobytes()], "ky": [ky.tobytes()], "n": [n]}

    parts = map_batches(sample, sums, "kk binary, ky binary, n long").collect()
    m = len(marks)
    kk = sum(np.frombuffer(p["kk"]).reshape(m, m) for p in parts)
    ky = sum(np.frombuffer(p["ky"]).reshape(m, len(languages)) for p in parts)
    n = sum(p["n"] for p in parts)
    among = table.astype(np.float64) @ table.T.astype(np.float64)
    left = kk + RIDGE * max(1, n) * among + 1e-9 * np.trace(kk) / m * np.eye(m)
    shared.unpersist()
    return (table.T @ np.linalg.solve(left, ky)).astype(np.float32)


def _better(rows: DataFrame, names: list[str], weights: np.ndarray, last: bool) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score`` of the best of ``names`` where it beats them."""
    table = rows.sparkSession.sparkContext.broadcast(weights)

    def predict(columns):
        langs, scores = columns["lang_pred"].to_pylist(), columns["score"].to_pylist()
        for i, text in enumerate(columns["text"].to_pylist()):
            if not text or not any(map(str.isalpha, text)):
                continue
            own = present(text)
            score = table.value[own].sum(axis=0, dtype=np.float64) / np.sqrt(len(own))
            at = int(score.argmax())
            if scores[i] is None or score[at] > scores[i]:
                langs[i], scores[i] = names[at], float(score[at])
        return {**columns, "lang_pred": langs, "score": scores}

    return map_batches(
        rows, predict, "doc_id long, held_out boolean, lang_pred string, score double"
                       + ("" if last else ", text string"))


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``, from its whole text.

    Learned from at most about ``per_language`` texts of every non-null value of ``lang``, drawn by a hash of the id among rows that :func:`is_training`.
    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing
    could be learned. Ties go to the first language by name. ``held_out`` is false for a row
    without an id, from which nothing is learned either. Repeated rows are answered each; other
    columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.col(lang).alias("lang"))
    languages, sample = _draw(rows, per_language)
    each = max(LEAST_LANDMARKS, landmarks // max(1, len(languages)))
    held_out = F.coalesce(~is_training(F.col("doc_id")), F.lit(False)).alias("held_out")
    best = rows.select(
        "doc_id", held_out, F.lit(UNDETERMINED).alias("lang_pred"),
        F.lit(None).cast("double").alias("score"), "text")
    stored = None
    for start in range(0, len(languages), LANGUAGES):
        names, tables = [], []
        for at in range(start, min(start + LANGUAGES, len(languages)), LEARNED):
            block = languages[at:min(at + LEARNED, start + LANGUAGES)]
            weights = _learn(sample, block, each, landmarks)
            if weights is not None:
                names += block
                tables.append(weights)
        if not names:
            continue
        last = start + LANGUAGES >= len(languages)
        best = _better(best, names, np.hstack(tables), last)
        if not last:
            earlier, stored = stored, materialize(best, "languages-so-far")
            best = stored
            if earlier is not None:
                discard(earlier)
    # Scores lie about -1 and 1; a text without a letter, or with nothing learned, has none.
    return best.select(
        "doc_id", "held_out", "lang_pred",
        F.when(F.col("score").isNull(), 0.0)
        .otherwise(F.least(F.greatest((F.col("score") + 1) / 2, F.lit(0.0)), F.lit(1.0)))
        .alias("score"))
