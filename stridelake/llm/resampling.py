"""Importance resampling of documents towards a target, with a vocabulary of head and tail.

Features are the words of a text and its pairs of neighbouring words, each hashed to one of a fixed
number of buckets by its CRC. A bucket gains by how much more often the target's texts fill it than
the corpus does, a document weighs the mean gain of its features, and a draw without replacement
follows from the weights and a number per document (the largest of weight plus Gumbel noise).

Few words and pairs make up most of all features. A first pass over all texts finds these: the CRC
state of each frequent word and the bucket of each frequent pair are computed once and broadcast, as
two tables of fixed size. A pair outside the head takes the state of its first word and adds the
second; a word outside the head takes its CRC directly. Both are exact, so the totals by bucket are,
and the head decides nothing but speed. The buckets of all features are stored once, for the totals
and for the weights that follow from them.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stridelake.llm.common import lists, map_batches
from stridelake.session import discard, materialize

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS = 20_000, 60_000  # entries broadcast
HEAD_BYTES = 48  # longest of them, so the broadcast is below 10 MB
COUNTED = 200_000  # words or pairs that a task counts at a time to find the head
PERCENT = 25
MIN_WORDS = 20
SEED = "7"
SLICE = 1 << 20  # bytes of a text that are split into words at a time
HELD = 1 << 20  # features handed on at a time

# Digits, letters and all bytes beyond ASCII make words, A-Z count as lower case.
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; each list begins with the last word before."""
    text = text.translate(_TABLE)
    begin, last = 0, []
    while begin < len(text):
        end = text.find(b" ", begin + SLICE)
        words = text[begin:end if end >= 0 else len(text)].split()
        if words:
            yield last + words
            last = words[-1:]
        if end < 0:
            return
        begin = end


class Vocabulary:
    """The head: CRC states of frequent words, buckets of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> None:
        self.buckets = buckets
        self.words = {w: zlib.crc32(w) for w in words}
        self.pairs = {(a, b): zlib.crc32(a + b" " + b) % buckets for a, b in pairs}

    def __reduce__(self) -> tuple:
        return Vocabulary, (list(self.words), list(self.pairs), self.buckets)

    def features(self, text: bytes) -> Iterator[np.ndarray]:
        """The buckets of all features of a text, in parts."""
        crc, fresh = zlib.crc32, 0  # the first word of later lists has been counted
        for words in words_of(text):
            states = [crc(word) if state is None else state
                      for word, state in zip(words, map(self.words.get, words))]
            # A pair outside the head goes on from the state of its first word.
            found = map(self.pairs.get, zip(words, words[1:]))
            pairs = [crc(b" " + word, state) if bucket is None else bucket
                     for word, state, bucket in zip(words[1:], states, found)]
            yield np.array(states[fresh:] + pairs, np.int64) % self.buckets
            fresh = 1


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def head(
    texts: DataFrame, buckets: int = BUCKETS, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS
) -> Vocabulary:
    """The frequent words and pairs of all ``texts`` (one string column).

    Tasks count in tables of bounded size and hand on what they saw most; rare entries may be
    undercounted, which only moves them to the tail.
    """
    schema = "first binary, second binary, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        pairs: Counter = Counter()
        for batch in batches:
            for text in _texts(batch.column(0)):
                fresh = 0
                for part in words_of(text):
                    words.update(part[fresh:])
                    pairs.update(zip(part, part[1:]))
                    fresh = 1
                for counter, most in ((words, n_words), (pairs, n_pairs)):
                    if len(counter) > COUNTED:
                        kept = counter.most_common(most)
                        counter.clear()
                        counter.update(dict(kept))
        made = [(w, None, n) for w, n in words.most_common(n_words) if len(w) <= HEAD_BYTES]
        made += [(*p, n) for p, n in pairs.most_common(n_pairs) if len(p[0] + p[1]) <= HEAD_BYTES]
        first, second, n = zip(*made) if made else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(n, pa.int64())],
            names=["first", "second", "n"])

    counts = materialize(
        texts.mapInArrow(run, schema).groupBy("first", "second").agg(F.sum("n").alias("n"))
        .where("n > 1"), "head-counts")

    def top(condition: str, most: int) -> pa.Table:
        ordered = counts.where(condition).orderBy(F.desc("n"), "first", "second").limit(most)
        return ordered.toArrow()  # ``most`` rows

    words = top("second IS NULL", n_words)["first"].to_pylist()
    pairs = top("second IS NOT NULL", n_pairs)
    return Vocabulary(
        words, list(zip(pairs["first"].to_pylist(), pairs["second"].to_pylist())), buckets)


def features(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``row, doc_id, buckets`` of ``texts`` (``doc_id`` and ``text``), stored.

    ``row`` tells the rows of ``texts`` apart. A long text has several rows here, one without
    features has one.
    """
    sent = texts.sparkSession.sparkContext.broadcast(vocabulary)
    schema = to_arrow_schema(StructType.fromDDL("row long, doc_id long, buckets array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            rows, ids, parts = zip(*held) if held else ((), (), ())
            offsets = np.cumsum([0, *map(len, parts)])
            values = np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int32)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), lists(offsets, values)],
                schema=schema)

        for given in batches:
            for doc_id, text in zip(given.column(0).to_pylist(), _texts(given.column(1))):
                row += 1
                for part in (*sent.value.features(text),) or (np.zeros(0, np.int64),):
                    held.append((row, doc_id, part))
                    size += len(part) + 1
                    if size > HELD:
                        yield batch()
                        size = 0
        yield batch()

    return materialize(
        texts.mapInArrow(run, "row long, doc_id long, buckets array<int>"), "features")


def bucket_totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The number of features in each bucket, from :func:`features`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(values, minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int64()), pa.array(total[filled])], names=["bucket", "n"])

    sums = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()  # one row per bucket
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of how much denser the target is in a bucket, rounded down."""
    buckets, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(
            (t + 1.0) * (all_corpus + float(buckets)) / ((s + 1.0) * (all_target + float(buckets)))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """1000 times a standard Gumbel number that id and seed decide, rounded down."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(found: DataFrame, gains: np.ndarray, seed: str = SEED) -> DataFrame:
    """``row, doc_id, n_words, n_features, weight, score`` of every row, from :func:`features`."""
    sent = found.sparkSession.sparkContext.broadcast(gains)

    def sums(columns: dict[str, pa.Array]) -> dict:
        buckets = columns["buckets"]
        offsets = buckets.offsets.to_numpy() - buckets.offsets[0].as_py()
        total = np.concatenate(
            [[0], np.cumsum(sent.value[buckets.flatten().to_numpy(zero_copy_only=False)])])
        return {"row": columns["row"], "doc_id": columns["doc_id"],
                "size": np.diff(offsets).astype(np.int64),
                "total": total[offsets[1:]] - total[offsets[:-1]]}

    def scores(columns: dict[str, pa.Array]) -> dict:
        ids, sizes = columns["doc_id"].to_pylist(), columns["size"].to_pylist()
        weights = [t // n if n else 0 for t, n in zip(columns["total"].to_pylist(), sizes)]
        return {
            "row": columns["row"], "doc_id": ids, "n_words": [(n + 1) // 2 for n in sizes],
            "n_features": sizes, "weight": weights,
            "score": [w + noise(i, seed) for w, i in zip(weights, ids)]}

    rows = map_batches(found, sums, "row long, doc_id long, size long, total long").groupBy(
        "row", "doc_id").agg(F.sum("size").alias("size"), F.sum("total").alias("total"))
    return map_batches(rows, scores, "row long, doc_id long, n_words long, n_features long, "
                                     "weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
    target_text: str = "text", buckets: int = BUCKETS, percent: int = PERCENT,
    min_words: int = MIN_WORDS, seed: str = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null for
    rows that are not drawn.

    ``percent`` of the rows with at least ``min_words`` words are drawn, rounded down: the highest
    scores, ties to the smaller id, a null id last. Repeated rows are drawn one by one. Null and
    empty texts have no features, weight 0 and are never drawn; long texts are read in parts. An
    empty table gives no rows, an empty target a target without features. Other columns are not
    read.
    """
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    aims = target.select(
        F.lit(None).cast("long").alias("doc_id"), F.col(target_text).alias("text"))
    vocabulary = head(texts.select("text"), buckets)
    found, aimed = features(texts, vocabulary), features(aims, vocabulary)
    gains = bucket_gains(bucket_totals(found, buckets), bucket_totals(aimed, buckets))
    weighed = materialize(weigh(found, gains, seed), "weighed")
    discard(found, aimed)
    eligible = weighed.where(F.col("n_words") >= min_words)
    drawn = eligible.count() * percent // 100
    # Rows in order over all partitions: a row's place is its place in its partition and the number
    # of rows in the partitions before. The row number lets equal rows be told apart and parted.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ordered = materialize(
        eligible.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).toArrow()
    by_part = sorted(zip(sizes["part"].to_pylist(), sizes["n"].to_pylist()))  # one per partition
    before = np.concatenate([[0], np.cumsum([n for _, n in by_part], dtype=np.int64)]).tolist()
    starts = docs.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(by_part, before)], "part long, before long")
    result = ["doc_id", "n_features", "weight", "score"]
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    ranked = ordered.withColumn("part", part).join(starts, "part").select(
        *result, F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionByName(
        weighed.where(F.col("n_words") < min_words)
        .select(*result, F.lit(None).cast("long").alias("rank")))
