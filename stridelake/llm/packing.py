"""Packing documents into few sequences of bounded length by bin completion.

Three steps. Tasks turn texts into token ids and cut what is longer than a sequence; a piece keeps its
length and its number among the pieces of that length in its task. The lengths then form a histogram,
which has at most ``limit`` entries however many documents there are, and :func:`solve` packs that
histogram. Last, each piece finds its sequence and its place there from its number among all pieces of
its length; no piece meets another one in a task.

:func:`solve` fills bins around the largest remaining length (bin completion). Of the fillings of the
room beside it only undominated ones are tried, and a filling is used for as many bins as the counts
allow at once. A branch ends when its bins, with a lower bound for the rest, reach the incumbent, or
when the space it has wasted leaves the incumbent out of reach. The first incumbent is best-fit
decreasing; a search that runs out of nodes has its open branch completed by best fit. Both budgets
of the search are parameters, and the result is a whole packing whatever they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from stridelake.llm.common import map_batches
from stridelake.session import materialize

LIMIT = 4096
END_ID = 1
NODES = 20_000  # bins (or blocks of equal bins) that the search may try
STEPS = 2_000_000  # choices of an item that it may take to list fillings
AHEAD = 32  # fillings listed before the fullest of them is tried

Pattern = tuple[tuple[int, int], ...]  # (length, copies) of one bin, in the order of their places
Blocks = list[tuple[Pattern, int]]  # equal bins

TOGETHER = 1 << 20  # characters tokenised at a time, of one text or many
CACHED_WORDS, CACHED_CHARS = 600_000, 1 << 25  # what a worker remembers of tokenised words


# --- token ids ---------------------------------------------------------------------------------

# In texts of these characters lower case and the boundaries of pre-tokens can be told here.
# Others go through the tokenizer as they are.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_PRE_TOKENS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")  # fixed by the vocabulary's file
_SPACE = re.compile(r"[\t-\r ]")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others take the letters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(own))
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Token ids of texts, with a bounded memory of words."""

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of all ``words``."""
        if len(self.known) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self._forget()
        tokenize = self.tokenizer.model.tokenize
        new = list(words.difference(self.known))
        made = [[t.id for t in tokenize(
            w.encode().decode("latin-1").translate(self.letters))] for w in new]
        length = np.fromiter(map(len, made), np.int64, len(made))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.chars += sum(map(len, new))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, np.fromiter(
            chain.from_iterable(made), np.uint32, int(length.sum()))])

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of several texts of plain characters."""
        split = [_PRE_TOKENS.findall(text.lower()) for text in texts]
        self._learn(set().union(*split))
        sizes = list(map(len, split))
        at = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(sizes))
        length = self.length[at]
        ends = np.cumsum(length)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            self.begin[at] - ends + length, length)]
        after = np.concatenate([[0], ends])[np.cumsum(sizes)]
        return np.split(ids, after[:-1])

    def _whole(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, np.uint32)

    def _is_plain(self, text: str) -> bool:
        return bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each whole text. Short texts are taken together, long ones in slices between
        white space, which no token crosses."""
        held: list[str] = []
        size = 0
        for text in texts:
            if held and (size + len(text) > TOGETHER or not self._is_plain(text)):
                yield from self._plain(held)
                held, size = [], 0
            if self._is_plain(text) and len(text) <= TOGETHER:
                held.append(text)
                size += len(text)
            else:
                yield self._long(text)
        if held:
            yield from self._plain(held)

    def _long(self, text: str) -> np.ndarray:
        plain, out, begin = self._is_plain(text), [], 0
        while begin < len(text):
            space = _SPACE.search(text, begin + TOGETHER)
            end = space.start() if space else len(text)
            part = text[begin:end]
            out.append(self._plain([part])[0] if plain else self._whole(part))
            begin = end
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


@cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def cut(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
    limit: int = LIMIT, end_id: int = END_ID, ids: bool = False,
) -> DataFrame:
    """The pieces of every document, not yet placed.

    ``doc_id, piece, start, length, ids_crc32``, with ``ids`` also the token ids, and ``task`` and
    ``nth``: the task that cut the piece and the piece's number among those of its length there.
    """
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
              + (", ids array<int>" if ids else ""))
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            rows: dict[str, list] = {f.name: [] for f in arrow}

            def flush() -> pa.RecordBatch:
                made = pa.RecordBatch.from_arrays(
                    [pa.array(rows[f.name], f.type) for f in arrow], schema=arrow)
                for column in rows.values():
                    column.clear()
                return made

            held = 0
            texts = (value.as_py() or "" for value in batch.column(1))
            for key, found in zip(batch.column(0).to_pylist(), tokenizer.encode(texts)):
                tokens = np.append(found, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(tokens), limit)):
                    part = tokens[start:start + limit]
                    rows["doc_id"].append(key)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(len(part))
                    rows["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    rows["task"].append(task)
                    rows["nth"].append(int(seen[len(part)]))
                    if ids:
                        rows["ids"].append(part.astype(np.int32))
                    seen[len(part)] += 1
                    held += len(part) if ids else 1
                    if held > 1 << 20:
                        yield flush()
                        held = 0
            yield flush()

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, schema)


# --- the packing of a histogram -----------------------------------------------------------------


def lower_bound(counts: np.ndarray, limit: int) -> int:
    """Bins that any packing needs at least.

    For each size a: pieces over ``limit - a`` stand alone with respect to those of a and more,
    pieces over half a bin never share one, and the rest fills what these leave at best.
    """
    sizes = np.arange(limit + 1, dtype=np.int64)
    number = np.concatenate([[0], np.cumsum(counts)])  # of pieces below a size
    space = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = limit // 2
    a = sizes[:half + 1]
    alone = number[-1] - number[limit - a + 1]
    paired = number[limit - a + 1] - number[half + 1]
    room = paired * limit - (space[limit - a + 1] - space[half + 1])
    small = space[half + 1] - space[a]
    more = np.maximum(0, -((room - small) // limit))
    return int((alone + paired + more).max())


def best_fit(counts: list[int], limit: int) -> Blocks:
    """Best-fit decreasing: each piece goes where it leaves least room. Equal bins stay together."""
    by_room: dict[int, list[tuple[Pattern, int]]] = {}
    rooms = 0  # bit r: there are bins with room r

    def put(pattern: Pattern, bins: int, room: int) -> None:
        nonlocal rooms
        by_room.setdefault(room, []).append((pattern, bins))
        rooms |= 1 << room

    for size in range(limit, 0, -1):
        left = counts[size]
        while left:
            fits = rooms >> size
            room = size + (fits & -fits).bit_length() - 1 if fits else limit
            fit = room // size  # the bin with least room keeps it until it is full
            if fits:
                pattern, bins = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                pattern, bins = (), -(-left // fit)
            full = min(bins, left // fit)
            left -= full * fit
            if full:
                put((*pattern, (size, fit)), full, room - fit * size)
            if full < bins:  # no piece is left for all of them
                if left:
                    put((*pattern, (size, left)), 1, room - left * size)
                    full, left = full + 1, 0
                if pattern and full < bins:
                    put(pattern, bins - full, room)
    return [block for blocks in by_room.values() for block in blocks]


class _Search:
    """Depth-first bin completion over a histogram."""

    def __init__(self, counts: list[int], limit: int, nodes: int, steps: int) -> None:
        self.limit, self.nodes, self.steps = limit, nodes, steps
        self.counts, self.array = list(counts), np.array(counts, np.int64)
        self.there = sum(1 << size for size, n in enumerate(counts) if n)
        self.total = sum(size * n for size, n in enumerate(counts))
        self.best = best_fit(counts, limit)
        self.best_bins = sum(bins for _, bins in self.best)
        self.least = lower_bound(self.array, limit)
        self.bins = self.wasted = 0
        self.path: Blocks = []

    def _most(self, size: int) -> int:
        """The largest remaining size up to ``size``, or 0."""
        return max(0, (self.there & ((2 << size) - 1)).bit_length() - 1)

    def _allowance(self) -> int:
        """Space that may still be wasted if fewer bins than the incumbent's are to do."""
        return (self.best_bins - 1) * self.limit - self.total - self.wasted

    def _change(self, pattern: Pattern, bins: int, sign: int) -> None:
        for size, copies in pattern:
            self.counts[size] -= sign * copies * bins
            self.array[size] = self.counts[size]
            if self.counts[size]:
                self.there |= 1 << size
            else:
                self.there &= ~(1 << size)
        self.bins += sign * bins
        self.wasted += sign * bins * (self.limit - sum(s * c for s, c in pattern))

    def _dominated(self, chosen: list[int], room: int) -> bool:
        """Whether a remaining piece could replace some chosen ones (or none) and fill the bin
        better or with fewer pieces."""
        sums = {0}
        for size in chosen[1:] if len(chosen) <= 12 else chosen[-11:]:
            sums |= {s + size for s in sums}
        held = set(chosen)
        for s in sums:
            single = s in held
            low = max(1, s + single)  # in place of one piece only a larger one counts
            if low <= s + room:
                window = (self.there >> low) & ((1 << (s + room - low + 1)) - 1)
                while window:
                    size = low + (window & -window).bit_length() - 1
                    if self.counts[size] > chosen.count(size):
                        return True
                    window &= window - 1
        return False

    def _fillings(self) -> Iterator[tuple[list[int], int]]:
        """Undominated fillings of a bin around the largest size, as sizes and room left."""
        first = self._most(self.limit)
        room = self.limit - first
        if room and self.counts[room] > (room == first):
            yield [first, room], 0
            return
        chosen, stack = [first], [min(first, room)]
        while stack:
            self.steps -= 1
            if self.steps < 0:
                return
            size = self._most(min(stack[-1], room))
            while size and self.counts[size] <= chosen.count(size):
                size = self._most(size - 1)
            if size:
                chosen.append(size)
                stack[-1] = size - 1  # next time here: a smaller one
                stack.append(size)
                room -= size
                continue
            # Nothing more fits below what was chosen last; a branch that skipped all is a leaf too.
            if room <= self._allowance() and not self._dominated(chosen, room):
                yield list(chosen), room
            stack.pop()
            if stack:
                room += chosen.pop()

    def _choices(self) -> Iterator[tuple[Pattern, int]]:
        """Fillings with a number of bins, fuller ones first among each ``AHEAD``."""
        fillings = self._fillings()
        while ahead := list(islice(fillings, AHEAD)):
            for chosen, room in sorted(ahead, key=lambda f: f[1]):
                sizes = sorted(set(chosen), reverse=True)
                pattern = tuple((s, chosen.count(s)) for s in sizes)
                most = min(self.counts[s] // c for s, c in pattern)
                if room:
                    most = min(most, self._allowance() // room)
                if most > 0:
                    yield pattern, most
                if most > 1:
                    yield pattern, 1

    def run(self) -> Blocks:
        if self.best_bins == self.least:
            return self.best
        frames = [self._choices()]
        while frames:
            choice = next(frames[-1], None)
            if choice is None:
                if self.steps < 0:
                    break
                frames.pop()
                if self.path:
                    self._change(*self.path.pop(), -1)
                continue
            self.nodes -= 1
            if self.nodes < 0:
                break
            self._change(*choice, 1)
            if not self.there:
                if self.bins < self.best_bins:
                    self.best, self.best_bins = [*self.path, choice], self.bins
                    if self.bins == self.least:
                        return self.best
            elif self.bins + lower_bound(self.array, self.limit) < self.best_bins:
                self.path.append(choice)
                frames.append(self._choices())
                continue
            self._change(*choice, -1)
        rest = best_fit(self.counts, self.limit)
        if frames and self.bins + sum(bins for _, bins in rest) < self.best_bins:
            return self.path + rest
        return self.best


def solve(counts: list[int], limit: int, nodes: int = NODES, steps: int = STEPS) -> Blocks:
    """A packing of ``counts[size]`` pieces of every size up to ``limit`` into few bins.

    With enough nodes and steps no packing has fewer bins.
    """
    return _Search([0, *counts[1:]], limit, nodes, steps).run()


# --- places -------------------------------------------------------------------------------------


def _runs(blocks: Blocks, limit: int) -> dict[str, np.ndarray]:
    """Runs of pieces of one length that go to consecutive sequences, by length and first number.

    Their number depends on the lengths and the pattern count of the search, not on the pieces.
    """
    used = [0] * (limit + 1)
    rows, sequence = [], 0
    for pattern, bins in blocks:
        offset = 0
        for size, copies in pattern:
            rows.append((size, used[size], sequence, copies, offset))
            used[size] += copies * bins
            offset += copies * size
        sequence += bins
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("size", "first", "sequence", "copies", "offset"), columns, strict=True))


def place(
    pieces: DataFrame, limit: int = LIMIT, nodes: int = NODES, steps: int = STEPS
) -> DataFrame:
    """Stored ``pieces`` with ``sequence_id`` and ``offset`` in place of ``task`` and ``nth``."""
    counts = materialize(
        pieces.groupBy("task", "length").agg(F.count("*").alias("pieces")), "piece-counts")
    histogram = [0] * (limit + 1)
    for row in counts.groupBy("length").agg(F.sum("pieces").alias("n")).collect():  # ``limit`` rows
        histogram[row.length] = row.n
    runs = _runs(solve(histogram, limit, nodes, steps), limit)
    before = F.coalesce(F.sum("pieces").over(
        W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("task", "length", before.alias("before"))
    kept = [c for c in pieces.columns if c not in ("task", "nth")]
    kinds = dict(pieces.dtypes)
    schema = ", ".join(
        [*(f"{c} {kinds[c]}" for c in kept), "sequence_id bigint", "offset bigint"])
    begins = runs["size"] << 48 | runs["first"]

    def function(columns: dict[str, pa.Array]) -> dict:
        length, number = (columns[c].to_numpy() for c in ("length", "number"))
        run = np.searchsorted(begins, length << 48 | number, "right") - 1
        nth = number - runs["first"][run]
        copies = runs["copies"][run]
        return {c: columns[c] for c in kept} | {
            "sequence_id": runs["sequence"][run] + nth // copies,
            "offset": runs["offset"][run] + nth % copies * length}

    numbered = pieces.join(offsets, ["task", "length"]).select(
        *kept, (F.col("before") + F.col("nth")).alias("number"))
    return map_batches(numbered, function, schema)


def pack(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
    limit: int = LIMIT, end_id: int = END_ID, ids: bool = False,
    nodes: int = NODES, steps: int = STEPS,
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32``, with ``ids``
    the token ids themselves, ``sequence_id`` and ``offset``.

    A document's ids are followed by ``end_id``; only what is longer than ``limit`` is cut. Null and
    empty texts are a piece of one id. Repeated rows and null ids are documents of their own, ties
    among equal lengths are broken by the order of cutting, an empty table gives no rows, and
    other columns are not read.
    """
    pieces = materialize(cut(docs, vocabulary, doc_id, text, limit, end_id, ids), "pieces")
    return place(pieces, limit, nodes, steps)
