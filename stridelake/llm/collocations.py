"""Collocations by prefix-free parsing of the texts.

A piece of text is cut into chunks where a window of two words has a certain hash, so equal passages
are cut alike wherever they stand. A chunk ends with the window that begins the next one; the phrases
that begin with these last two words belong to the next chunk, so each phrase is counted in one chunk
only. The distinct chunks with their frequencies are the dictionary, and phrases are counted in its
entries, each for as many times as the entry occurs: a passage that many documents share is counted
once.

Words come first, then pairs of words that are frequent themselves, then triples of two frequent
pairs, since no phrase is more frequent than a part of it. A bitmap of fixed size tells which words
and pairs may be frequent; what it lets through is counted exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stridelake.llm.common import in_bitmap, map_batches
from stridelake.llm.words import MIX, word_hashes
from stridelake.operators import scan
from stridelake.session import discard, materialize

ABSENT = "und"  # the language of a null
LEAST = 10  # occurrences of a candidate
LONGEST = 3  # words of a candidate
INSIDE_PERCENT = 50
TOP = 2000
WINDOW = LONGEST - 1  # words that neighbouring chunks share
ONE_IN = 8  # windows that cut
FARTHEST = 64  # words after which a chunk ends in any case
SLICE = 1 << 21  # bytes that are parsed at a time
BITMAP_BITS = 1 << 25

# A-Z count as lower case, tabs as spaces, these characters end a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else 0x0A if b in _ENDS else b
    for b in range(256))
_SPACES, _EDGES = re.compile(rb" {2,}"), re.compile(rb" ?\n[ \n]*")
_SPACE, _LINE = 0x20, 0x0A


def normal(text: bytes) -> bytes:
    """A text with one line per piece that has words, and one space between words."""
    return _EDGES.sub(b"\n", _SPACES.sub(b" ", text.translate(_TABLE))).strip(b" \n")


def slices(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """Parts of a normal text, and whether a part ends inside a piece.

    Such a part ends with the first two words of the next one.
    """
    begin = 0
    while len(text) - begin > SLICE:
        end = begin + SLICE
        line, space = text.find(b"\n", end), text.find(b" ", end)
        shared = space
        for _ in range(WINDOW):
            shared = text.find(b" ", shared + 1) if shared >= 0 else -1
        if 0 <= shared and (line < 0 or shared < line):
            yield text[begin:shared], True
            begin = space + 1
        elif line >= 0:
            yield text[begin:line], False
            begin = line + 1
        else:
            break
    yield text[begin:], False


class Parsed:
    """Words of lines in one buffer: where they begin and end, and which end a line."""

    def __init__(self, lines: bytes) -> None:
        self.raw = np.frombuffer(lines, np.uint8)
        gaps = np.flatnonzero((self.raw == _SPACE) | (self.raw == _LINE))
        self.begin = np.concatenate([[0], gaps + 1])
        self.end = np.append(gaps, len(self.raw))
        self.lines = lines
        self.closes = np.append(self.raw[gaps] == _LINE, True)
        line = np.cumsum(self.closes) - self.closes
        self.line_end = np.flatnonzero(self.closes)[line] + 1  # the word after the line's last
        self.line = line

    @cached_property
    def hash(self) -> np.ndarray:
        return word_hashes(self.lines)

    def joined(self) -> np.ndarray:
        """A hash of each word and the next."""
        with np.errstate(over="ignore"):
            return self.hash[:-1] * MIX ^ (self.hash[1:] + (self.hash[1:] >> np.uint64(29)))

    def cutouts(self, first: np.ndarray, after: np.ndarray) -> pa.Array:
        """The words from ``first`` to before ``after``, as they stand in the buffer."""
        begin, length = self.begin[first], self.end[after - 1] - self.begin[first]
        ends = np.cumsum(length)
        size = int(ends[-1]) if len(ends) else 0
        at = np.arange(size, dtype=np.int32) + np.repeat(
            (begin - ends + length).astype(np.int32), length)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(
            len(first), pa.py_buffer(offsets), pa.py_buffer(self.raw[at]))


def _chunks(lines: bytes, is_open: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Chunks of lines, the line of each, and whether it is the last of its piece.

    ``is_open`` tells which lines end with two words of a next part.
    """
    words = Parsed(lines)
    n, closes = len(words.begin), words.closes
    opens = np.concatenate([[True], closes[:-1]])
    trigger = np.zeros(n, bool)
    trigger[:-1] = (words.joined() >> np.uint64(40)) % np.uint64(ONE_IN) == 0
    place = np.arange(n)
    cuts = opens | trigger & ~closes
    cuts |= (place - np.maximum.accumulate(np.where(cuts, place, 0))) % FARTHEST == 0
    cuts &= opens | ~closes  # a window that would reach beyond the piece cuts nothing
    cuts &= opens | ~(is_open[words.line] & (place >= words.line_end - WINDOW))
    first = np.flatnonzero(cuts)
    following = np.append(first[1:], n)
    line_end = words.line_end[first]
    last = following >= line_end
    after = np.where(last, line_end, following + WINDOW)
    line = words.line[first]
    return words.cutouts(first, after), line, last & ~is_open[line]


def dictionary(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, chunk, last, n``: every distinct chunk with its frequency."""
    schema = "lang string, chunk string, last boolean"

    def made(parts: list[tuple[bytes, bool]], langs: list[str]) -> pa.RecordBatch:
        lines = [part.count(b"\n") + 1 for part, _ in parts]
        is_open = np.zeros(sum(lines), bool)
        is_open[np.cumsum(lines) - 1] = [o for _, o in parts]
        chunk, line, last = _chunks(b"\n".join(part for part, _ in parts), is_open)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs).take(pa.array(np.repeat(np.arange(len(lines)), lines)[line])),
             chunk, pa.array(last)], names=["lang", "chunk", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, langs, held = [], [], 0
            values = zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist())
            for value, language in values:
                for part, is_open in slices(normal(value.as_py() or b"")):
                    if part:
                        parts.append((part, is_open))
                        langs.append(language)
                        held += len(part)
                    if held >= SLICE:
                        yield made(parts, langs)
                        parts, langs, held = [], [], 0
            if parts:
                yield made(parts, langs)

    language = F.coalesce(F.col(lang).cast("string"), F.lit(ABSENT))
    return docs.select(F.col(text), language).mapInArrow(run, schema).groupBy(
        "lang", "chunk", "last").agg(F.count("*").alias("n"))


def packed(chunks: DataFrame) -> DataFrame:
    """``lang, chunks, last, n``: the rows of a dictionary many at a time, which are read several
    times. A row has chunks of one language, one a line, and their flags and frequencies as bytes.
    """
    schema = "lang string, chunks string, last binary, n binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        sizes: dict[str, int] = {}

        def row(lang: str) -> pa.RecordBatch:
            table = pa.Table.from_batches(held.pop(lang)).combine_chunks()
            del sizes[lang]
            lines = pa.ListArray.from_arrays(
                pa.array([0, table.num_rows], pa.int32()), table["chunk"].combine_chunks())
            last = np.packbits(table["last"].to_numpy())
            n = table["n"].to_numpy().astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pc.binary_join(lines, "\n"),
                 pa.array([last.tobytes()]), pa.array([n.tobytes()])],
                names=["lang", "chunks", "last", "n"])

        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                part = batch.filter(pc.equal(langs, lang))
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + pc.sum(
                    pc.binary_length(part.column("chunk"))).as_py() + part.num_rows
                if sizes[lang] >= SLICE:
                    yield row(lang)
            if sum(sizes.values()) >= 8 * SLICE:  # of many languages
                yield row(max(sizes, key=sizes.get))
        for lang in list(held):
            yield row(lang)

    return chunks.select("lang", F.col("chunk"), "last", "n").mapInArrow(run, schema)


def counts(chunks: DataFrame, size: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """``lang, phrase, f``: how often phrases of ``size`` words occur in ``packed`` chunks.

    With a ``bitmap`` only phrases whose parts of one word less may be frequent. For single words
    there is also the empty phrase with the number of all words.
    """
    def some(lines: bytes, last: np.ndarray, n: np.ndarray) -> pa.Table:
        words = Parsed(lines)
        place, line = np.arange(len(words.begin)), words.line
        mine = (last[line] | (place < words.line_end - WINDOW)) & (place + size <= words.line_end)
        if bitmap is not None:
            known = _may_hold(bitmap, words.hash if size == 2 else words.joined())
            both = np.zeros(len(place), bool)
            both[:max(0, len(known) - 1)] = known[:-1] & known[1:]
            mine &= both
        first = np.flatnonzero(mine)
        times = n[line[first]]
        phrase = words.cutouts(first, first + size)
        if size == 1:
            phrase = pa.concat_arrays([phrase, pa.array([""])])
            times = np.append(times, times.sum())
        grouped = pa.table([phrase, pa.array(times)], names=["phrase", "f"]).group_by(
            "phrase").aggregate([("f", "sum")])
        return grouped.rename_columns(["phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, lines, last, n in zip(*batch.columns):
                times = np.frombuffer(n.as_buffer(), np.int64)
                ends = np.unpackbits(
                    np.frombuffer(last.as_buffer(), np.uint8), count=len(times)).astype(bool)
                found = some(lines.as_buffer().to_pybytes(), ends, times)
                for part in found.to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, part.num_rows), *part.columns],
                        names=["lang", "phrase", "f"])

    return chunks.mapInArrow(run, "lang string, phrase string, f long").groupBy(
        "lang", "phrase").agg(F.sum("f").alias("f"))


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS.bit_length() + 1)).astype(np.int64)


def _may_hold(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return in_bitmap(bitmap, _bits(hashes))


def frequent_bitmap(grams: DataFrame, size: int) -> np.ndarray:
    """A bitmap with the bit of every phrase of ``grams``, which has ``size`` words (1 or 2)."""
    def function(columns: dict[str, pa.Array]) -> dict:
        phrases = columns["phrase"].cast(pa.binary()).to_pylist()
        if not phrases:
            return {"word": [], "bit": []}
        words = Parsed(b"\n".join(phrases))
        hashes = words.hash if size == 1 else words.joined()[::2]
        bits = _bits(hashes[:len(phrases)])
        return {"word": bits >> 5, "bit": np.int64(1) << (bits & 31)}

    found = map_batches(grams.select("phrase"), function, "word long, bit long").groupBy(
        "word").agg(F.bit_or("bit").alias("bits")).toArrow()  # BITMAP_BITS / 32 rows at most
    bitmap = np.zeros(BITMAP_BITS // 32, np.uint32)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bitmap


def frequent_grams(chunks: DataFrame, least: int = LEAST) -> dict[int, DataFrame]:
    """From packed chunks: stored phrases of 1, 2 and 3 words with at least ``least`` occurrences; the first frame also
    has the empty phrase of every language."""
    words = materialize(counts(chunks, 1).where((F.col("f") >= least) | (F.col("phrase") == "")),
                        "frequent-1")
    grams, bitmap = {1: words}, frequent_bitmap(words.where("phrase <> ''"), 1)
    for size in range(2, LONGEST + 1):
        grams[size] = materialize(
            counts(chunks, size, bitmap).where(F.col("f") >= least), f"frequent-{size}")
        if size < LONGEST:
            bitmap = frequent_bitmap(grams[size], size)
    return grams


def _part(words: Column, begin: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def scored(grams: dict[int, DataFrame], inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer one covers."""
    every = grams[1].unionByName(grams[2]).unionByName(grams[3])
    candidates = grams[2].unionByName(grams[3]).select("lang", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    covering = (
        grams[3].select("lang", F.explode(F.array(_part(words, 1, 2), _part(words, 2, 2)))
                        .alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = candidates.join(covering, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent))
    cuts = kept.select(
        "lang", "phrase", "a",
        F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")).select(
        "*", _part(words, F.lit(1), F.col("k")).alias("left"),
        _part(words, F.col("k") + 1, F.size(words)).alias("right"))

    def looked_up(df: DataFrame, side: str, name: str) -> DataFrame:
        found = every.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        return df.join(found, ["lang", side])

    both = looked_up(looked_up(cuts, "left", "l"), "right", "r")
    wide = "CAST({} AS DECIMAL(38, 0))"
    score = F.expr("CAST(1000000 AS DECIMAL(38, 0)) * {a} * {a} DIV ({l} * {r})".format(
        **{c: wide.format(c) for c in "alr"}))
    return both.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score")


def mine(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
    inside_percent: int = INSIDE_PERCENT, top: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` collocations of each language.

    A null language is ``und``. Null and empty texts hold nothing, long ones are parsed in parts.
    Repeated rows count each time. Ties go to the more frequent phrase, then to the smaller one by
    bytes. An empty table gives no rows; other columns are not read.
    """
    chunks = materialize(packed(dictionary(docs, text, lang)), "chunks")
    grams = frequent_grams(chunks, least)
    # The order within a language is that of these ranges, so no language is ever in one task.
    order = ["down", "rare", "phrase"]
    found = scan.segments(
        scored(grams, inside_percent).withColumns({"down": -F.col("score"), "rare": -F.col("a")}),
        ["lang"], order)
    discard(chunks, grams[2], grams[3])
    sizes = found.groupBy(scan.PART, "lang").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(scan.before(["lang"])), F.lit(0))
    starts = sizes.select(scan.PART, "lang", before.alias("before"))
    nth = F.row_number().over(scan.within(["lang"], order))
    ranked = found.withColumn("nth", nth).join(starts, [scan.PART, "lang"]).withColumn(
        "rank", F.col("before") + F.col("nth")).where(F.col("rank") <= top)
    totals = grams[1].where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
