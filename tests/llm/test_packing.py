import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stridelake.llm import packing, queries
from stridelake.session import materialize
from tests.llm.data import documents, empty

PATH = public_tokenizers.path(queries.WORD_VOCABULARY)


def fewest(sizes, limit):
    """The least number of bins, by trying everything."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= sizes[i] and room not in rooms[:j]:
                go(i + 1, [*rooms[:j], room - sizes[i], *rooms[j + 1:]])
        go(i + 1, [*rooms, limit - sizes[i]])

    go(0, [])
    return best[0]


def counted(sizes, limit):
    return np.bincount(np.array(sizes, int), minlength=limit + 1).tolist()


def bins_of(blocks, counts, limit):
    used = [0] * (limit + 1)
    for pattern, bins in blocks:
        assert bins > 0 and sum(s * c for s, c in pattern) <= limit
        for size, copies in pattern:
            used[size] += copies * bins
    assert used == counts
    return sum(bins for _, bins in blocks)


def test_fewest_bins_of_small_sets():
    rng = random.Random(4)
    for case in range(300):
        limit = rng.randint(5, 40)
        low = max(1, limit // 5) if case % 2 else 1
        sizes = [rng.randint(low, limit // 2 if case % 2 else limit)
                 for _ in range(rng.randint(0, 10))]
        counts, want = counted(sizes, limit), fewest(sizes, limit)
        assert bins_of(packing.solve(counts, limit), counts, limit) == want, (sizes, limit)
        assert packing.lower_bound(np.array(counts), limit) <= want
        assert bins_of(packing.best_fit(counts, limit), counts, limit) >= want


def test_a_search_without_budget_still_packs_everything():
    rng = np.random.default_rng(2)
    counts = counted(rng.integers(300, 1400, 5000), 4096)
    plain = bins_of(packing.best_fit(counts, 4096), counts, 4096)
    for nodes, steps in ((0, 0), (5, 1000), (500, 10), (3000, 100_000)):
        assert bins_of(packing.solve(counts, 4096, nodes, steps), counts, 4096) <= plain


def test_beats_best_fit_where_it_errs():
    counts = counted([4, 4, 5, 5, 6, 6] * 40, 15)  # 4 + 5 + 6 fill a bin
    assert bins_of(packing.best_fit(counts, 15), counts, 15) > 80
    assert bins_of(packing.solve(counts, 15), counts, 15) == 80


def test_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    texts = [
        "", "It's a TEST, isn't it?\nYes\t42 don't", "Çà et là, ÜBER groß; s'il",
        "a <|endoftext|> b", "x²½µª İΣς 中文 😀 é    ", "w" * 300 + " " + "é" * 70,
        "many words, " * 30_000, "one\x00two\x1fthree", "́start à"]
    encoder = packing.Encoder(PATH)
    for found, text in zip(encoder.encode([*texts, *texts]), [*texts, *texts], strict=True):
        assert found.tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("words, together", [(3, 1 << 20), (600_000, 9), (2, 15)])
def test_encoder_forgets_and_slices(monkeypatch, words, together):
    monkeypatch.setattr(packing, "CACHED_WORDS", words)
    monkeypatch.setattr(packing, "TOGETHER", together)
    plain, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    texts = ["one two three four five", "five six", "", "中 é one  two", "seven one eight two",
             "nineteenhundredandeightyfour one"] * 2
    for found, text in zip(encoder.encode(texts), texts, strict=True):
        assert found.tolist() == plain.encode(text).ids


def check_pieces(rows, docs, limit):
    """Pieces against the ids of their documents, and the layout of the sequences."""
    plain = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in docs:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(str(doc_id), i // limit, i, len(ids[i:i + limit]),
                  zlib.crc32(ids[i:i + limit].tobytes())) for i in range(0, len(ids), limit)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == (
        sorted(want))
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= limit
    return len(places)


@pytest.mark.parametrize("limit", [64, 4096])
def test_pack_of_awkward_rows(spark, limit):
    df = documents(spark)
    rows = packing.pack(df.repartition(5), PATH, limit=limit).collect()
    used = check_pieces(rows, [(r.doc_id, r.text) for r in df.collect()], limit)
    assert -(-sum(r.length for r in rows) // limit) <= used
    assert used <= sum(b for _, b in packing.best_fit(
        counted([r.length for r in rows], limit), limit))


def test_ids_fill_the_sequences(spark):
    df = documents(spark)
    rows = packing.pack(df, PATH, limit=64, ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert all(len(r.ids) == r.length for r in rows)


def test_pack_of_an_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0


def test_stored_pieces_may_be_read_in_other_parts(spark):
    pieces = materialize(packing.cut(documents(spark).repartition(3), PATH), "pieces")
    a = packing.place(pieces.repartition(7)).count()
    assert a == pieces.count()


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.packed(spark, sf_dir).collect()
    used = check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1
