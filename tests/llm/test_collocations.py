import random
import re
from collections import Counter

import pytest

from stridelake.llm import collocations as C
from tests.llm.data import documents, empty, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(rows):
    """All phrases of up to three words by language, and the number of words."""
    found, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    found[lang, " ".join(words[i:i + n])] += 1
    return found, total


def brute(rows, least, top):
    found, total = grams(rows)
    ranked = {}
    for (lang, phrase), a in found.items():
        words = phrase.split(" ")
        if len(words) < 2 or a < least:
            continue
        longer = [f for (other, p), f in found.items()
                  if other == lang and f >= least and p.count(" ") > len(words) - 1
                  and f" {phrase} " in f" {p} "]
        if any(100 * f >= 50 * a for f in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = found[lang, " ".join(words[:k])], found[lang, " ".join(words[k:])]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        ranked.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return [(lang, i, p.decode(), -a, l, r, total[lang], -score)
            for lang, held in ranked.items()
            for i, (score, a, p, l, r) in enumerate(sorted(held)[:top], 1)]


def texts(n=120):
    rng = random.Random(8)
    words = ["on", "the", "Hill", "über", "x-y", "中文", "a", "b", "c", "\x1c", "\x00z"]
    rows = []
    for i in range(n):
        text = "".join(
            rng.choice(words) + rng.choice([" "] * 12 + ["  ", "\t", ", ", ".\n", " ;", "\r\n", "!"])
            for _ in range(rng.randint(0, 90)))
        rows.append((rng.choice(["en", "de", None]), text))
    shared = "once upon a time in the old town on the hill there was nothing left to say"
    return rows + [("en", shared)] * 25 + [(None, None), ("fr", ""), ("fr", " ,. ")] + [
        ("en", "a " * 500), ("de", "over and " * 300 + ". over and out")]


SCHEMA = "lang string, text string, n string, phrase string, `last` string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("size", [40, 1 << 21])
def test_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(C, "SLICE", size)
    got = rows_of(C.mine(frame(spark, texts()), least=3, top=40))
    assert got == sorted(brute(texts(), 3, 40), key=lambda t: tuple((False, str(x)) for x in t))


def test_awkward_rows(spark):
    df = documents(spark)
    want = brute([(r.lang, r.text) for r in df.collect()], 10, 2000)
    assert rows_of(C.mine(df)) == sorted(want, key=lambda t: tuple((False, str(x)) for x in t))


@pytest.mark.parametrize("size", [24, 100, 1 << 21])
def test_chunks_hold_each_phrase_once(spark, monkeypatch, size):
    monkeypatch.setattr(C, "SLICE", size)
    rows = texts(40)
    found, total = Counter(), Counter()
    for r in C.dictionary(frame(spark, rows), "text", "lang").collect():
        words = r.chunk.split(" ")
        assert len(words) <= C.FARTHEST + C.WINDOW
        begins = len(words) if r.last else len(words) - C.WINDOW
        total[r.lang] += r.n * begins
        for n in (1, 2, 3):
            for i in range(min(begins, len(words) - n + 1)):
                found[r.lang, " ".join(words[i:i + n])] += r.n
    want, words = grams(rows)
    assert found == want and +total == +words


def test_copies_add_no_chunk(spark):
    one = [r for r in texts() if r[0] == "en"]
    few = C.dictionary(frame(spark, one), "text", "lang").count()
    assert C.dictionary(frame(spark, one * 4), "text", "lang").count() == few


def test_a_passage_is_cut_alike_anywhere(spark):
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randint(0, 99)}" for _ in range(200))
    alone = {r.chunk for r in C.dictionary(frame(spark, [("en", passage)]), "text", "lang").collect()}
    inside = {r.chunk for r in C.dictionary(
        frame(spark, [("en", f"some other words {passage} and more")]), "text", "lang").collect()}
    assert len(alone) > 10 and len(alone - inside) <= 4


def test_large_products_are_exact(spark):
    one = spark.createDataFrame([
        ("en", "a", 10**10 + 7), ("en", "b", 10**10 + 9), ("en", "", 10**11)],
        "lang string, phrase string, f long")
    two = spark.createDataFrame([("en", "a b", 10**10 - 3)], one.schema)
    row = C.scored({1: one, 2: two, 3: two.where("false")}).first()
    assert row.score == 1_000_000 * (10**10 - 3) ** 2 // ((10**10 + 7) * (10**10 + 9))


def test_empty_table(spark):
    assert C.mine(empty(spark)).count() == 0
