"""A quality classifier from weak labels.

Heuristic labellers look at signals of a text (symbols, capitals, repetition, punctuation ...) and
vote good, junk or not at all. None is right always. Expectation-maximisation finds, without any
true label, how each votes on good and on junk texts, hence its accuracy, and the posterior of every
vote pattern. Posteriors of a bounded sample are the targets of a linear scorer over hashed
features, which also learns what no labeller looks at, and which scores every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stridelake.llm.common import map_batches, unused
from stridelake.llm.words import MIX, word_hashes
from stridelake.session import materialize

FEATURES = 1 << 15
BINS = 8  # of each signal
TRAINED_ON = 16_000  # expected number of documents in the training sample
PARTS = 8
ROUNDS = 4
RATE = 0.5
SLICE = 1 << 20
TEXT_SCALE = 30.0  # of the n-gram shares of a text, which are small numbers

_KIND = np.full(256, 4, np.int64)  # 0 white, 1 other letter, 2 capital, 3 digit, 4 symbol, 5 mark
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[range(0x41, 0x5B)] = 2
_KIND[range(0x30, 0x3A)] = 3
_KIND[[*b".,;:?!'\"()-"]] = 5
_ENDING = np.isin(np.arange(256), [*b".,;:?!"])


class Labeller(NamedTuple):
    """Votes junk outside ``junk`` bounds, good inside ``good`` bounds, else nothing.

    It looks at texts of ``words`` words and more only.
    """

    signal: str
    junk: tuple[float, float]
    good: tuple[float, float]
    words: int = 1


SIGNALS = ("symbols", "capitals", "repeats", "wordless", "endings", "length", "top_word", "digits")
LABELLERS = (
    Labeller("symbols", (-1, 0.08), (-1, 0.02)),
    Labeller("capitals", (-1, 0.5), (-1, 0.2)),
    Labeller("repeats", (-1, 0.3), (-1, 0.05), 5),
    Labeller("wordless", (-1, 0.15), (-1, 0.05)),
    Labeller("endings", (0.005, 0.6), (0.02, 0.35), 20),
    Labeller("length", (2, 15), (3, 10)),
    Labeller("top_word", (-1, 0.3), (-1, 0.15), 30),
    Labeller("digits", (-1, 0.3), (-1, 0.1)),
)


def signals(text: bytes) -> tuple[np.ndarray, int]:
    """The :data:`SIGNALS` of a whole text with at least one word, and its number of words."""
    kinds, hashes, endings, wordless = np.zeros(6, np.int64), [], 0, 0
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        while end < len(text) and _KIND[text[end]]:  # cut no word
            end += 1
        raw = np.frombuffer(b" " + text[at:end] + b" ", np.uint8)
        kind = _KIND[raw]
        kinds += np.bincount(kind, minlength=6)
        inside = kind > 0
        last = inside[:-1] & ~inside[1:]
        endings += int(_ENDING[raw[:-1][last]].sum())
        name = (kind >= 1) & (kind <= 3)
        begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        if len(begins):
            wordless += int((np.add.reduceat(name, begins) == 0).sum())
        hashes.append(word_hashes(text[at:end]))
        at = end
    words = np.concatenate(hashes)
    solid = max(1, kinds[1:].sum())
    letters = max(1, kinds[1] + kinds[2])
    ordered = np.sort(words)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    n = len(words)
    values = (
        kinds[4] / solid, kinds[2] / letters,
        (words[1:] == words[:-1]).sum() / max(1, n - 1), wordless / n, endings / n, solid / n,
        np.diff(edges).max() / n, kinds[3] / solid)
    return np.array(values, np.float64), n


def votes(values: np.ndarray, words: int) -> list[int]:
    """One vote of each labeller: 1 good, -1 junk, 0 none."""
    out = []
    for labeller in LABELLERS:
        value = values[SIGNALS.index(labeller.signal)]
        if words < labeller.words:
            out.append(0)
        elif not labeller.junk[0] <= value <= labeller.junk[1]:
            out.append(-1)
        else:
            out.append(int(labeller.good[0] <= value <= labeller.good[1]))
    return out


def features(text: bytes, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features: the buckets of all byte trigrams with their shares, and one bucket for each
    signal's bin (each counts one). The text is read in slices, however long it is."""
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, max(0, len(text) - 2), SLICE):
        raw = np.frombuffer(text[at:at + SLICE + 2], np.uint8).astype(np.uint32)
        grams = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(0x9E3779B1)
        counts += np.bincount(grams >> np.uint32(17), minlength=FEATURES)
    hit = np.flatnonzero(counts)
    bins = np.minimum(BINS - 1, (np.sqrt(np.clip(values / (1, 1, 1, 1, 1, 20, 1, 1), 0, 1))
                                 * BINS).astype(np.int64))
    with np.errstate(over="ignore"):
        mixed = (np.arange(len(values)) * BINS + bins).astype(np.uint64) * MIX
    return hit, counts[hit] / max(1, len(text) - 2), (mixed >> np.uint64(49)).astype(np.int64)


def _code(pattern: list[int]) -> int:
    return int(sum((vote + 1) * 3 ** i for i, vote in enumerate(pattern)))


def _pattern(code: int) -> list[int]:
    return [code // 3 ** i % 3 - 1 for i in range(len(LABELLERS))]


@dataclass
class LabelModel:
    """What expectation-maximisation found: the share of good texts, ``tables[j, c, v]`` the
    probability that labeller j casts vote v - 1 on class c (0 junk, 1 good), and the posterior
    probability of good for each vote pattern."""

    prior: float
    tables: np.ndarray
    posterior: dict[int, float]

    def accuracies(self) -> dict[str, float]:
        """Of each labeller, the share of its votes that are right."""
        right = self.prior * self.tables[:, 1, 2] + (1 - self.prior) * self.tables[:, 0, 0]
        wrong = self.prior * self.tables[:, 1, 0] + (1 - self.prior) * self.tables[:, 0, 2]
        return {b.signal: float(r / (r + w)) for b, r, w in zip(LABELLERS, right, wrong)}


def estimate(counts: dict[int, int], steps: int = 100) -> LabelModel:
    """Expectation-maximisation over the numbers of documents with each vote pattern.

    There are at most ``3 ** len(LABELLERS)`` patterns, however many documents.
    """
    codes = sorted(counts)
    cast = np.array([_pattern(c) for c in codes]).reshape(len(codes), len(LABELLERS)) + 1
    rows = np.array([counts[c] for c in codes], np.float64)
    # To begin with, half of a text's votes against it make it junk.
    junk, good = (cast == 0).sum(1), (cast == 2).sum(1)
    posterior = (good + 1) / (good + 1.5 * junk + 2)
    one_hot = np.eye(3)[cast]  # pattern, labeller, vote
    prior, tables = 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)
    for _ in range(steps):
        weight = np.stack([rows * (1 - posterior), rows * posterior])
        tables = np.einsum("cp,pjv->jcv", weight, one_hot) + 0.1
        tables /= tables.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + 1) / (rows.sum() + 2)
        log = np.einsum("pjv,jcv->pc", one_hot, np.log(tables)) + np.log([1 - prior, prior])
        posterior = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return LabelModel(prior, tables, dict(zip(codes, posterior.tolist())))


def _margin(
    weights: np.ndarray, hit: np.ndarray, shares: np.ndarray, bins: np.ndarray
) -> float:
    text = float(weights[hit] @ shares) * TEXT_SCALE
    return float(text + weights[FEATURES:][bins].sum() + weights[-1])


def train(sample: DataFrame, model: LabelModel, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of a logistic scorer, by gradient steps in parallel and averaging after each round.

    ``sample`` has ``part``, ``draw``, ``text`` (binary) and ``code``. Each part walks through its
    texts in a fixed order from the shared weights.
    """
    context = sample.sparkSession.sparkContext
    weights = np.zeros(2 * FEATURES + 1)
    for number in range(rounds):
        state = context.broadcast((weights, model.posterior, RATE / (1 + number)))

        def run(key, rows):
            own, posterior, rate = state.value
            own = own.copy()
            order = np.argsort(rows["draw"].to_numpy(), kind="stable")
            texts, codes = rows["text"], rows["code"]
            for i in order.tolist():
                text = texts[i].as_py()
                hit, shares, bins = features(text, signals(text)[0])
                p = 1 / (1 + np.exp(-np.clip(_margin(own, hit, shares, bins), -30, 30)))
                step = rate * (posterior[codes[i].as_py()] - p)
                own[hit] += step * TEXT_SCALE * shares
                own[FEATURES + bins] += step
                own[-1] += step
            return pa.table({"rows": pa.array([len(order)], pa.int64()),
                             "weights": pa.array([own.tobytes()], pa.binary())})

        parts = sample.groupBy("part").applyInArrow(run, "rows long, weights binary").collect()
        if not parts:
            break
        total = sum(p["rows"] for p in parts)
        weights = sum(np.frombuffer(p["weights"]) * p["rows"] / total for p in parts)
        state.unpersist()
    return weights


@dataclass
class Classifier:
    labels: LabelModel
    weights: np.ndarray


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trained_on: int = TRAINED_ON
) -> Classifier:
    """Count the votes on all documents, then train on a sample of expected size ``trained_on``.

    The sample is drawn by a hash of id and text. Texts without a word have no votes.
    """
    source = docs.select(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("draw"),
        F.col(text).cast("binary").alias("text"))

    def vote(columns):
        codes = []
        for value in columns["text"].to_pylist():
            codes.append(_code(votes(*signals(value))) if value and value.strip() else None)
        return {"draw": columns["draw"], "code": codes}

    cast = materialize(map_batches(source, vote, "draw long, code int"), "votes").where(
        "code IS NOT NULL")
    counts = {r["code"]: r["n"] for r in cast.groupBy("code").agg(F.count("*").alias("n")).collect()}
    model = estimate(counts) if counts else LabelModel(
        0.5, np.full((len(LABELLERS), 2, 3), 1 / 3), {})
    share = min(1.0, trained_on / max(1, sum(counts.values())))
    chosen = source.where(
        F.pmod(F.xxhash64("draw"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))

    def code(columns):
        found = [(d, v, _code(votes(*signals(v)))) for d, v in zip(
            columns["draw"].to_pylist(), columns["text"].to_pylist(), strict=True)
            if v and v.strip()]
        return {"part": [d % PARTS for d, _, _ in found], "draw": [d for d, _, _ in found],
                "text": [v for _, v, _ in found], "code": [c for _, _, c in found]}

    sample = materialize(
        map_batches(chosen, code, "part int, draw long, text binary, code int"), "training-sample")
    return Classifier(model, train(sample, model))


def score(
    docs: DataFrame, classifier: Classifier, text: str = "text",
    keep: tuple[str, ...] = ("doc_id",), prefix: str = "",
) -> DataFrame:
    """The ``keep`` columns with ``p_label`` (posterior of the votes), ``score`` (of the scorer,
    both the probability of a good text) and ``accept`` (score of a half or more)."""
    state = docs.sparkSession.sparkContext.broadcast(
        (classifier.labels.posterior, classifier.labels.prior, classifier.weights))
    content_of, = unused(docs, "text")

    def run(columns):
        posterior, prior, weights = state.value
        label, value = [], []
        for content in columns[content_of].to_pylist():
            if not content or not content.strip():
                label.append(0.0)
                value.append(0.0)
                continue
            found, words = signals(content)
            given = features(content, found)
            label.append(posterior.get(_code(votes(found, words)), prior))
            value.append(float(1 / (1 + np.exp(-np.clip(_margin(weights, *given), -30, 30)))))
        return {**columns, f"{prefix}p_label": label, f"{prefix}score": value,
                f"{prefix}accept": [v >= 0.5 for v in value]}

    kept = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_batches(
        docs.select(*[f"`{c}`" for c in keep],
                    F.col(text).cast("binary").alias(content_of)), run,
        ", ".join([*kept, f"{prefix}p_label double, {prefix}score double, "
                          f"{prefix}accept boolean"]))


def classify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trained_on: int = TRAINED_ON
) -> DataFrame:
    """``doc_id, p_label, score, accept`` of every row of ``docs``.

    A null text, or one without a word, has no votes and is rejected with score 0. Repeated rows
    are scored each, null ids stay null, other columns are not read, and an empty table gives no
    rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return score(rows, fit(rows, trained_on=trained_on))


def keep_good(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trained_on: int = TRAINED_ON
) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns, whatever their names."""
    classifier = fit(docs, doc_id, text, trained_on)
    prefix = "_quality_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    marked = score(docs, classifier, text, tuple(docs.columns), prefix)
    return marked.where(f"{prefix}accept").select(*[f"`{c}`" for c in docs.columns])
