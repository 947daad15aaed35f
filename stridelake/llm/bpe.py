"""Byte-level BPE through a sentencepiece model made of a rank table.

The vocabulary of a byte-level BPE (bytes and their rank) is written as a sentencepiece model
without training: every byte becomes one printable character, a piece's score is its negative rank,
and normalisation is the identity. Such a model merges the adjacent pair of lowest rank first, the
leftmost of equals, which is the encoder's rule. Texts are cut into pre-tokens by the vocabulary's
pattern, each pre-token is encoded on its own, and ids are turned back by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice
from unicodedata import category

import numpy as np
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame

from stridelake.llm.common import lists, map_batches

UNKNOWN = "<unk>"
CACHED = 200_000  # pre-tokens whose ids a worker keeps, also between its tasks
LONG = 64  # characters; longer pre-tokens are rare and not kept
SLICE = 250_000  # characters (or pre-tokens of one long text) that are encoded together
OTHER = re.compile("[^\x00-\u024f\u2010-\u2027]")


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank of each byte sequence in a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _field(number: int, kind: int) -> bytes:
    return _varint(number << 3 | kind)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _block(number: int, content: bytes) -> bytes:
    return _field(number, 2) + _varint(len(content)) + content


def _number(number: int, value: int) -> bytes:
    return _field(number, 0) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a rank table; its id 0 is unknown, id ``r + 1`` has rank ``r``.

    Ranks must be 0, 1, 2 ... without gaps, and every single byte must have one.
    """
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[token] for token in by_rank] != list(range(len(ranks))):
        raise ValueError("ranks must be gapless from 0")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must be a token")
    char = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _field(2, 5) + struct.pack("<f", score)
                      + _number(3, kind))

    # Field numbers and codes of the public model format.
    normal, unknown, bpe = 1, 2, 2
    pieces = [piece(UNKNOWN, 0.0, unknown)]
    for rank, token in enumerate(by_rank):
        pieces.append(piece("".join(char[b] for b in token), -float(rank), normal))
    trainer = (
        _number(3, bpe) + _number(4, len(pieces)) + _number(40, 0)
        + b"".join(_number(n, (1 << 64) - 1) for n in (41, 42, 43)))  # no begin, end, padding
    normalizer = (
        _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


def narrow(pattern: str) -> str:
    """``pattern`` for Python's own faster matcher, valid for texts without :data:`OTHER`.

    The classes for letters, numbers and white space become plain lists of characters.
    """
    known = [chr(c) for c in range(0x250)] + [chr(c) for c in range(0x2010, 0x2028)]
    named = {
        "\\p{L}": [c for c in known if category(c)[0] == "L"],
        "\\p{N}": [c for c in known if category(c)[0] == "N"],
        "\\s": list("\t\n\v\f\r \x85\xa0"),
    }
    listed = {name: "".join(map(re.escape, chars)) for name, chars in named.items()}

    def plain(match: re.Match) -> str:
        found = match.group()
        if found[0] == "[":
            return re.sub(r"\\p\{[LN]\}|\\s", lambda m: listed[m.group()], found)
        if found == "\\S":
            return f"[^{listed['\\s']}]"
        return f"[{listed[found]}]"

    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\s|\\S", plain, pattern)


class Codec:
    """Encodes and decodes with a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.narrow = re.compile(narrow(pattern))
        self.characters = dict(enumerate(byte_characters()))
        back = {ord(c): b for b, c in self.characters.items()}
        self.token = [
            bytes(back[ord(c)] for c in self.processor.id_to_piece(i))
            for i in range(1, self.processor.get_piece_size())]
        self.ids: dict[str, bytes] = {}
        # A pre-token that is a token as a whole stays whole, also if merges don't lead to it.
        merged = self._merge(self.token)
        self.whole = {
            token: struct.pack("<I", rank) for rank, token in enumerate(self.token)
            if merged[rank] != struct.pack("<I", rank)}

    def _merge(self, raw: list[bytes]) -> list[bytes]:
        found = self.processor.encode(
            [token.decode("latin-1").translate(self.characters) for token in raw], num_threads=1)
        flat = np.fromiter(chain.from_iterable(found), np.uint32) - np.uint32(1)
        data, ends = flat.tobytes(), np.cumsum([4 * len(ids) for ids in found]).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _match(self, text: str) -> list[str]:
        return (self.pattern if OTHER.search(text) else self.narrow).findall(text)

    def _join(self, many: list[list[str]]) -> list[bytes]:
        """The ids of several lists of pre-tokens; those without ids yet are encoded in one call."""
        new = list(set().union(*many).difference(self.ids))
        if len(self.ids) + len(new) > CACHED:
            self.ids.clear()
            new = list(set().union(*many))
        raw = [word.encode() for word in new]
        self.ids.update(zip(new, self._merge(raw)))
        if self.whole:
            self.ids.update((w, self.whole[t]) for w, t in zip(new, raw) if t in self.whole)
        joined = [b"".join(map(self.ids.__getitem__, words)) for words in many]
        for word in new:
            if len(word) > LONG:
                del self.ids[word]
        return joined

    def encode(self, texts: list[str | None]) -> Iterator[Iterable[bytes]]:
        """For each text its ids as little-endian unsigned 32-bit integers, in slices.

        Short texts are encoded together. One of over ``SLICE`` characters is matched lazily, so
        that it never stands in memory as a list of pre-tokens.
        """
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            text = text or ""
            if size + len(text) > SLICE:
                yield from ([data] for data in self._join(waiting))
                waiting, size = [], 0
            if len(text) > SLICE:
                found = (match.group() for match in self.pattern.finditer(text))
                yield iter(lambda: self._join([list(islice(found, SLICE))])[0], b"")
            else:
                waiting.append(self._match(text))
                size += len(text)
        yield from ([data] for data in self._join(waiting))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def model_of(df: DataFrame, path: str) -> Broadcast:
    """The model, sent to the executors. Its size is that of the vocabulary."""
    return df.sparkSession.sparkContext.broadcast(serialise(read_ranks(path)))


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns and ``ids`` (array of int) of every row's whole text.

    A null or empty text has no ids.
    """
    model = model_of(df, path)

    def run(columns):
        codec = _codec(model.value, pattern)
        ids = [b"".join(parts) for parts in codec.encode(columns["_text"].to_pylist())]
        ends = np.cumsum([0, *(len(data) // 4 for data in ids)])
        return {**columns, "ids": lists(ends, np.frombuffer(b"".join(ids), np.int32))}

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return map_batches(
        df.select(*keep, df[text].alias("_text")), run, ", ".join([*fields, "ids array<int>"]))


def decode(
    df: DataFrame, path: str, pattern: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns and ``content``, the bytes that ``ids`` stand for (null: none)."""
    model = model_of(df, path)

    def run(columns):
        codec = _codec(model.value, pattern)
        return {**columns, "content": [codec.decode(x or ()) for x in columns["_ids"].to_pylist()]}

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return map_batches(
        df.select(*keep, df[ids].alias("_ids")), run, ", ".join([*fields, "content binary"]))


def round_trip(
    df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of the ids and of the decoded bytes of every text.

    The text is encoded, and its ids decoded, in slices, so a very long text needs little more
    than its own memory. A null text counts as empty: no tokens, digests of nothing. Rows keep
    their number, repeated or not; other columns are not read.
    """
    model = model_of(df, path)

    def run(columns):
        codec = _codec(model.value, pattern)
        count, of_ids, of_text = [], [], []
        for parts in codec.encode(columns["text"].to_pylist()):
            ids, content, n = hashlib.sha256(), hashlib.sha256(), 0
            for data in parts:
                ids.update(data)
                content.update(codec.decode(memoryview(data).cast("I")))
                n += len(data) // 4
            count.append(n)
            of_ids.append(ids.hexdigest())
            of_text.append(content.hexdigest())
        return {"doc_id": columns["doc_id"], "n_tokens": count, "ids_sha256": of_ids,
                "decoded_sha256": of_text}

    return map_batches(
        df.select(df[doc_id].alias("doc_id"), df[text].alias("text")), run,
        f"doc_id {df.schema[doc_id].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
        "decoded_sha256 string")
