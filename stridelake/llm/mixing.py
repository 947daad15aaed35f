"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic, and a cell weighs as many tokens as its
documents have. Raking scales the cells in turn so that the sums by source, by language and by topic
meet their targets, over and over; each cell's weight is never raised above its tokens, since no
document is used twice. A cell's share of its tokens is then the probability with which each of its
documents is kept, decided by a hash of the document, so a repeated task decides alike.

Wishes flatten what is there: a category with a share p of the tokens wishes for p ** flatness
(flatness 1: as it is; 0: all alike). Explicit wishes may be given instead. A wish becomes a target
that can be met in two ways. No category aims at more than ``AT_MOST`` of its tokens; what it cannot
give is shared out among the others in proportion to their wishes. And as targets of several margins
may still contradict each other, they are eased towards the shares that are there anyway, which can
always be met: all rungs of ``EASINGS`` are raked at once, and the first whose largest relative
error over all categories is within ``TOLERANCE`` is taken. :func:`margins` reports wishes, targets
and what was reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.llm.common import WORD, n_blocks, unused
from stridelake.session import discard, materialize

MARGINS = ("source", "lang", "topic")
ABSENT = "(none)"  # the category of a null
KEEP = 0.6  # share of all tokens to keep
FLATNESS = {"source": 0.7, "lang": 0.8, "topic": 0.8}
SWEEPS = 12
AT_MOST = 0.9  # share of its tokens that a category's target may ask for
FILLS = 8  # rounds in which what categories cannot give is shared out
EASINGS = (0.0, 0.25, 0.5, 0.75, 1.0)
TOLERANCE = 0.01
CELLS_PER_FILE = 200_000
SEED = "mixture"


def tokens_of(text: Column) -> Column:
    """The number of words of a whole text, and one for the document itself."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


def topic_of(text: Column) -> Column:
    """A coarse topic from a text's form, for tables without one.

    ``list`` has under 40 characters a line, ``figures`` over 5 % digits, else ``note``,
    ``article`` or ``report`` by length; ``empty`` has no characters.
    """
    length = F.coalesce(F.char_length(text), F.lit(0))
    lines = length - F.char_length(F.translate(text, "\n", "")) + 1
    digits = length - F.char_length(F.translate(text, "0123456789", ""))
    return (
        F.when(length == 0, "empty").when((lines > 1) & (length < 40 * lines), "list")
        .when(digits * 20 > length, "figures").when(length < 500, "note")
        .when(length < 4000, "article").otherwise("report"))


def draw_of(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from a hash of id and text, the same wherever it is computed."""
    mark = F.concat_ws(":", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("")),
                       F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("")))
    digits = F.substring(F.sha2(mark.cast("binary"), 256), 1, 12)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 48))


def wishes(cells: DataFrame, margin: str, flatness: float) -> DataFrame:
    """``margin`` and ``target``, the flattened tokens of each category (in any scale)."""
    return cells.groupBy(margin).agg(
        F.pow(F.sum("tokens").cast("double"), flatness).alias("target"))


def attainable(sums: DataFrame, limit: float) -> DataFrame:
    """``sums`` (``own`` and ``wish`` of each category) with ``target``, its share of all.

    No target is above ``limit`` times the category's own share.
    """
    total = sums.agg(F.sum("own")).first()[0] or 1.0
    most = F.lit(limit) * F.col("own") / F.lit(total)
    scale = 0.0
    for _ in range(FILLS):
        full = F.col("wish") * scale > most
        held, open_ = sums.agg(
            F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("wish")))).first()
        before, scale = scale, (1.0 - (held or 0.0)) / open_ if open_ else scale
        if scale == before:
            break
    raised = sums.withColumn("target", F.least(F.col("wish") * scale, most))
    all_targets = raised.agg(F.sum("target")).first()[0] or 1.0
    return raised.withColumn("target", F.col("target") / all_targets).withColumn(
        "own", F.col("own") / total)


def rake(
    cells: DataFrame, wished: dict[str, DataFrame], keep: float = KEEP, sweeps: int = SWEEPS
) -> DataFrame:
    """``cells`` (margins and ``tokens``) at every easing, with ``weight``, the tokens to keep.

    ``wished`` holds a frame of category and ``target`` per margin, in any scale; cells of a
    category without one get nothing. The result also has, for each margin, ``aim_<margin>`` and
    ``off_<margin>``: the target in tokens and the relative error that is left. Each sweep is a few
    small aggregations and joins in Spark, since sources may be many, each written to the shared
    folder.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    for margin, wish in wished.items():
        cells = cells.join(
            wish.where("target > 0").select(margin, F.col("target").alias(f"wish_{margin}")), margin)
    cells = materialize(cells, "cells")
    live, n = cells.agg(F.sum("tokens"), F.count("*")).first()
    live = float(live or 0)
    # Cells are few beside the documents, so they are kept in as few files as hold them.
    files = n_blocks(n * len(EASINGS), CELLS_PER_FILE)
    most = max(AT_MOST, keep) * live
    budget = min(keep * total, most)
    easings = F.array(*map(F.lit, EASINGS))
    rungs = cells.withColumn("weight", F.col("tokens").cast("double")).withColumn(
        "easing", F.explode(easings))
    for margin in wished:
        sums = cells.groupBy(margin).agg(
            F.sum("tokens").cast("double").alias("own"), F.first(f"wish_{margin}").alias("wish"))
        aims = attainable(sums, most / budget if budget else 1.0)
        eased = F.col("target") + (F.col("own") - F.col("target")) * F.col("easing")
        rungs = rungs.join(aims.select(margin, "own", "target"), margin).withColumn(
            f"aim_{margin}", F.lit(budget) * eased).drop("own", "target")
    raked = materialize(rungs.coalesce(files), "raked")

    def sums_of(margin: str) -> DataFrame:
        return raked.groupBy(margin, "easing").agg(F.sum("weight").alias("sum"))

    for _ in range(sweeps):
        for margin in wished:  # written one by one, so no plan holds more than one join
            before = raked
            raked = materialize(
                raked.join(sums_of(margin), [margin, "easing"]).withColumn(
                    "weight", F.least(
                        F.col("weight") * (F.col(f"aim_{margin}") / F.col("sum")),
                        F.col("tokens").cast("double"))).drop("sum").coalesce(files), "raked")
            discard(before)
    for margin in wished:
        raked = raked.join(sums_of(margin), [margin, "easing"]).withColumn(
            f"off_{margin}", F.abs(F.col("sum") / F.col(f"aim_{margin}") - 1)).drop("sum")
    return raked


def calibrated(
    rows: DataFrame, keep: float = KEEP, flatness: dict[str, float] | None = None,
    wished: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS,
) -> DataFrame:
    """The raked cells at the least easing that is within tolerance, stored; cells that get nothing
    are left out.

    ``rows`` has the margins (without nulls) and ``tokens``. ``error`` is the largest relative
    error of all categories.
    """
    cells = materialize(
        rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mixture-cells")
    flat = FLATNESS | (flatness or {})
    raked = materialize(rake(
        cells, {m: wishes(cells, m, flat[m]) for m in MARGINS} | (wished or {}), keep, sweeps),
        "raked")
    worst = F.max(F.greatest(*[F.col(f"off_{m}") for m in MARGINS]))
    errors = raked.groupBy("easing").agg(worst.alias("error")).orderBy("easing").collect()
    chosen = next((e for e in errors if e.error <= TOLERANCE), errors[-1] if errors else None)
    return raked.where(F.col("easing") == (chosen.easing if chosen else 0.0)).withColumn(
        "error", F.lit(chosen.error if chosen else 0.0))


def margins(cells: DataFrame) -> DataFrame:
    """``margin, category, wished, target, reached, error`` from calibrated cells: tokens wished for
    (scaled to the whole), aimed at and reached, and the relative error of the last two."""
    parts = []
    for margin in MARGINS:
        sums = cells.groupBy(F.lit(margin).alias("margin"), F.col(margin).alias("category")).agg(
            F.first(f"wish_{margin}").alias("wished"), F.first(f"aim_{margin}").alias("target"),
            F.sum("weight").alias("reached"), F.first(f"off_{margin}").alias("error"))
        scale = sums.agg(F.try_divide(F.sum("target"), F.sum("wished"))).first()[0] or 0.0
        parts.append(sums.withColumn("wished", F.col("wished") * scale))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _cells_of(
    docs: DataFrame, doc_id: str, text: str, source: str, lang: str, topic: Column | None
) -> dict[str, Column]:
    value = F.col(text)
    return {
        "source": F.coalesce(F.col(source), F.lit(ABSENT)),
        "lang": F.coalesce(F.col(lang), F.lit(ABSENT)),
        "topic": F.coalesce(topic_of(value) if topic is None else topic, F.lit(ABSENT)),
        "tokens": tokens_of(value), "draw": draw_of(F.col(doc_id), value)}


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    lang: str = "lang", topic: Column | None = None, keep: float = KEEP,
    flatness: dict[str, float] | None = None, wished: dict[str, DataFrame] | None = None,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, p, kept, easing, error`` of every row of ``docs``.

    ``p`` is the calibrated probability, rounded to nine digits, and ``kept`` whether the row's
    draw falls below it. ``easing`` and ``error`` (rounded to four digits) are those of the whole
    mixture. Without a ``topic`` the coarse stand-in of :func:`topic_of` is used. A null source,
    language or topic is a category of its own. Null and empty texts weigh one token. Repeated rows
    have one draw, so they stay or go together. Rows of a category that is not wished for have
    ``p`` 0. An empty table gives no rows; other columns are not read.
    """
    made = _cells_of(docs, doc_id, text, source, lang, topic)
    rows = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in made.items()]),
        "mixture-rows")
    cells = calibrated(rows, keep, flatness, wished, sweeps)
    shares = cells.select(
        *MARGINS, (F.col("weight") / F.col("tokens")).alias("share"), "easing", "error")
    p = F.round(F.coalesce("share", F.lit(0.0)), 9)
    return rows.join(shares, list(MARGINS), "left").select(
        "doc_id", *MARGINS, "tokens", p.alias("p"), (F.col("draw") < p).alias("kept"),
        "easing", F.round("error", 4).alias("error"))


def sample(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    lang: str = "lang", topic: Column | None = None, keep: float = KEEP,
    flatness: dict[str, float] | None = None, wished: dict[str, DataFrame] | None = None,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """The rows of ``docs`` that :func:`mix` keeps, with their columns, whatever their names."""
    made = _cells_of(docs, doc_id, text, source, lang, topic)
    rows = docs.select(*[made[c].alias(c) for c in (*MARGINS, "tokens")])
    cells = calibrated(rows, keep, flatness, wished, sweeps)
    own = dict(zip((*MARGINS, "draw", "p"), unused(docs, "source", "lang", "topic", "draw", "p")))
    share = F.round(F.col("weight") / F.col("tokens"), 9)
    shares = cells.select(*[F.col(m).alias(own[m]) for m in MARGINS], share.alias(own["p"]))
    marked = docs.withColumns({own[c]: made[c] for c in (*MARGINS, "draw")})
    kept = marked.join(shares, [own[m] for m in MARGINS]).where(
        F.col(own["draw"]) < F.col(own["p"]))
    return kept.select(*[marked[f"`{c}`"] for c in docs.columns])
