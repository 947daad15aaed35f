import hashlib
import struct
from itertools import product

import public_tokenizers as P
import pytest
import tiktoken

from stridelake.llm import bpe
from tests.llm.data import documents, empty

PATH = P.path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "\n\n\n q", "a\x1cb", "a \x1c b", "x\u3000 y", "it's 'S ''s  \n z", "\xad\u0120A", "a\t b\x85c",
    "<|endoftext|> <unk> \u2581\u2581 a\u2581b", "12345 ½² Ⅷ", "中文字 \U0001f600\U0001f600", "w" * 3000,
    "ﬁ ǅ ʰ ͅ", "\u200b\u2028\u2014—’s",
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.serialise(bpe.read_ranks(PATH)), P.PATTERN)


def test_ids_are_those_of_the_library(codec, reference, monkeypatch):
    for slice_size in (bpe.SLICE, 50):
        monkeypatch.setattr(bpe, "SLICE", slice_size)
        for text, parts in zip(ODD, codec.encode(ODD), strict=True):
            data = b"".join(parts)
            ids = list(struct.unpack(f"<{len(data) // 4}I", data))
            assert ids == reference.encode_ordinary(text), text[:30]
            assert codec.decode(ids) == text.encode()


def test_full_cache_changes_nothing(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 3)
    texts = ["one two three four five", "six seven eight"]
    for text, parts in zip(texts, codec.encode(texts), strict=True):
        assert list(struct.unpack(f"<{len(b''.join(q := list(parts))) // 4}I", b"".join(q))) == (
            reference.encode_ordinary(text))


def test_what_a_worker_keeps_is_bounded(codec, reference):
    """A worker outlives its tasks, so neither many nor long pre-tokens may pile up in it."""
    words = list(map("".join, product("abcdefgh", repeat=6)))
    many = [" ".join(words[at:at + 2_000]) for at in range(0, len(words), 2_000)]
    long = [f"{'word' * 20_000}{'x' * i}" for i in range(20)]
    for text, parts in zip([*many, *long], codec.encode([*many, *long]), strict=True):
        if text in (many[-1], long[-1]):
            data = b"".join(parts)
            assert list(memoryview(data).cast("I")) == reference.encode_ordinary(text)
    # A pre-token's text, its ids and their place in the table take some 200 bytes.
    assert len(codec.ids) <= 250_000 and max(map(len, codec.ids)) < 100


def test_vocabulary_must_be_whole():
    with pytest.raises(ValueError, match="gapless"):
        bpe.serialise({b"a": 0, b"b": 2})
    with pytest.raises(ValueError, match="single byte"):
        bpe.serialise({b"a": 0})


def test_round_trip_digests(spark, reference):
    docs = documents(spark)
    got = sorted(map(tuple, bpe.round_trip(docs, PATH, P.PATTERN).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((
            r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(empty(spark), PATH, P.PATTERN).count() == 0


def test_encode_then_decode(spark):
    docs = documents(spark).where("doc_id < 120")
    ids = bpe.encode(docs, PATH, P.PATTERN)
    content = {(r.doc_id, bytes(r.content)) for r in bpe.decode(ids, PATH, P.PATTERN).collect()}
    assert content == {(r.doc_id, (r.text or "").encode()) for r in docs.collect()}
