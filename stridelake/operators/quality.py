"""Rule tables, duplicate and reference checks, quarantine, batch accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions import numeric as N
from stridelake.sources import listing

# Fixed values.
PLAUSIBLE_KG = (30, 250)
LB_TOLERANCE = 0.2
CATEGORIES = ("health", "life-event", "equipment", "training", "other")

Rule = tuple[str, Column]


def apply_rules(df: DataFrame, *stages: list[Rule], out: str = "violations") -> DataFrame:
    """Add the names of the broken rules. A condition that is null counts as kept.

    Rules of a later stage are only looked at when all earlier stages are clean.
    """
    def broken(rules: list[Rule]) -> Column:
        return F.array_compact(F.array(*[
            F.when(~condition, F.lit(name)) for name, condition in rules]))

    result = broken(stages[0])
    for rules in stages[1:]:
        result = F.when(F.size(result) > 0, result).otherwise(broken(rules))
    return df.withColumn(out, result)


def split_ok(df: DataFrame, column: str = "violations") -> tuple[DataFrame, DataFrame]:
    return df.where(F.size(column) == 0).drop(column), df.where(F.size(column) > 0)


def required(*columns: str) -> list[Rule]:
    return [(f"{c} is required", F.col(c).isNotNull()) for c in columns]


def duplicate_ids(df: DataFrame, key: str, position: str) -> DataFrame:
    """Rows whose id was already used, with ``first_position``, where it was used first."""
    repeated = (
        df.where(F.col(key).isNotNull()).groupBy(key)
        .agg(F.min(position).alias("first_position"), F.count("*").alias("uses"))
        .where(F.col("uses") > 1).drop("uses")
    )
    return df.join(repeated, key).where(F.col(position) > F.col("first_position"))


def dangling_refs(
    df: DataFrame, refs: str, known: DataFrame, keep: list[str]
) -> DataFrame:
    """The ``keep`` columns and ``ref`` for every reference to an id that does not exist.

    ``known`` has one column ``ref`` with the existing ids.
    """
    used = df.select(*keep, F.explode(refs).alias("ref"))
    missing = used.select("ref").distinct().join(known.distinct(), "ref", "left_anti")
    return used.join(missing, "ref")


def _label() -> Column:
    return F.coalesce("id", F.concat(F.lit("entry #"), F.col("entry").cast("string")))


def _messages(df: DataFrame) -> DataFrame:
    return df.select("entry", _label().alias("label"), F.explode("violations").alias("message"))


def _duplicate_messages(valid: DataFrame) -> DataFrame:
    message = F.concat(
        F.lit("id is taken already by entry #"), F.col("first_position").cast("string"))
    return duplicate_ids(valid, "id", "entry").select(
        "entry", _label().alias("label"), message.alias("message"))


def validate_weight(readings: DataFrame) -> DataFrame:
    """Violations of weight readings (``entry`` is the position in the file).

    Duplicates, range and unit consistency are only checked where the shape is valid.
    """
    low, high = PLAUSIBLE_KG
    kg, lb = F.col("weight_kg"), F.col("weight_lb")
    expected = N.round_half_even(N.kg_to_lb(kg), 1)
    shape = required("id", "source", "original_source", "recorded_at", "weight_kg")
    checked = apply_rules(
        readings, shape,
        [
            (f"weight_kg is outside {low} to {high}", kg.between(low, high)),
            ("weight_lb does not match weight_kg", F.abs(lb - expected) <= LB_TOLERANCE),
        ],
    )
    valid = apply_rules(readings, shape).where(F.size("violations") == 0)
    return _messages(checked).unionByName(_duplicate_messages(valid))


def validate_life_events(events: DataFrame) -> DataFrame:
    """Violations of life events. Ids of malformed events do not count as existing, yet the
    references such events make are checked."""
    shape = [
        *required("id", "date", "category", "title", "description"),
        ("category is unknown", F.col("category").isin(*CATEGORIES)),
    ]
    ordered = [("date_end is before date", F.col("date_end") >= F.col("date"))]
    checked = apply_rules(events, shape, ordered)
    valid = apply_rules(events, shape).where(F.size("violations") == 0)
    dangling = dangling_refs(
        events.where(F.col("id").isNotNull()), "related_event_ids",
        valid.select(F.col("id").alias("ref")), keep=["entry", "id"])
    messages = dangling.select(
        "entry", F.col("id").alias("label"),
        F.concat(F.lit("references unknown id "), F.col("ref")).alias("message"))
    return (
        _messages(checked)
        .unionByName(_duplicate_messages(valid))
        .unionByName(messages)
    )


def violations_report(violations: DataFrame) -> DataFrame:
    """How often each kind of message occurs; no rows means that everything is valid."""
    kind = F.regexp_replace("message", r"(entry #|unknown id ).*", "$1")
    return violations.groupBy(F.trim(kind).alias("kind")).agg(F.count("*").alias("n"))


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """Counts per batch: attempted, succeeded, failed, skipped."""
    def count(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(status)

    return outcomes.groupBy("batch_id").agg(
        F.count("*").alias("attempted"),
        count(listing.SUCCEEDED), count(listing.FAILED), count(listing.SKIPPED))


def quarantine(outcomes: DataFrame) -> DataFrame:
    """The entries that did not succeed, with the reason."""
    return outcomes.where(F.col("status") != listing.SUCCEEDED).select(
        "batch_id", "entry", "status", "reason")
