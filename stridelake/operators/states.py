"""Partial states of activities: what all rollups are made of, and can be added up.

A state is one row per key, kind of activity and measure: the number of values, their sum in parts
that do not depend on order, the largest value, and the first and last start. States of any parts of
the activities may be merged, so a rollup reads either the activities or a stored daily table of
states (:class:`Daily`), with the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stridelake.functions import numeric as N, text as X, times
from stridelake.session import materialize

OUTDOOR, CLASS = "outdoor", "class"
RIDE = "ride"  # the measure that every activity has
DEALT = 50_000  # activities of a task that makes daily states


def _measures() -> dict[str, Column]:
    return {
        RIDE: F.lit(0.0),
        "distance": F.col("endurance_metrics.distance_m"),
        "elapsed": F.col("elapsed_time_s"),
        "elevation": F.col("endurance_metrics.elevation_gain_m"),
        "calories": F.col("calories"),
        "hr": F.col("average_heart_rate"),
        "cadence": F.col("endurance_metrics.average_cadence"),
        "speed": F.col("endurance_metrics.average_speed_mps"),
        "output": F.col("class_metrics.output_kj").try_cast("double"),
    }


_LIMB = T.DecimalType(28, 0)
STATE = T.StructType([
    T.StructField("athlete_id", T.LongType()), T.StructField("day", T.DateType()),
    T.StructField("hour", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("measure", T.StringType()), T.StructField("n", T.LongType()),
    *[T.StructField(limb, T.DoubleType() if limb == "fine" else _LIMB) for limb in N.LIMBS],
    T.StructField("top", T.DoubleType()),
    T.StructField("first", T.TimestampType()), T.StructField("last", T.TimestampType())])


@dataclass(frozen=True)
class Daily:
    """States by athlete, day and hour (``STATE``), in the place of the activities themselves."""

    states: DataFrame


class When(NamedTuple):
    """What a key may be made of: the start of an activity (or its day), and the hour of the day."""

    start: Column
    hour: Column


def kind_of(source: Column) -> Column:
    """Null for a null source."""
    return F.when(X.is_class(source), CLASS).when(X.is_outdoor(source), OUTDOOR)


def merged(rows: DataFrame, by: list[Column]) -> DataFrame:
    """States added up by ``by``, kind and measure."""
    sums = N.sum_sums({limb: F.col(limb) for limb in N.LIMBS})
    return rows.groupBy(*by, "kind", "measure").agg(
        F.sum("n").alias("n"), *[part.alias(limb) for limb, part in sums.items()],
        F.max("top").alias("top"), F.min("first").alias("first"), F.max("last").alias("last"))


def states(
    source: DataFrame | Daily, keys: dict[str, Callable[[When], Column]],
    measures: tuple[str, ...] = (RIDE,), kind: str | None = None,
) -> DataFrame:
    """States of ``measures`` by ``keys``; only those of one ``kind`` if given."""
    if isinstance(source, Daily):
        rows = source.states.where(F.col("measure").isin(*measures))
        when = When(F.col("day"), F.col("hour"))
        rows = rows if kind is None else rows.where(F.col("kind") == kind)
        return merged(rows, [make(when).alias(name) for name, make in keys.items()])
    test = {CLASS: X.is_class, OUTDOOR: X.is_outdoor}.get(kind)
    rows = source if test is None else source.where(test(F.col("original_source")))
    start = F.col("start_time")
    when = When(start, F.hour(start))
    known = _measures()
    # One row per measure keeps the generated code of the sums small, however many there are.
    values = F.array(*[
        F.struct(F.lit(m).alias("measure"), known[m].cast("double").alias("value"))
        for m in measures])
    long = rows.select(
        *[make(when).alias(f"_{name}") for name, make in keys.items()],
        kind_of(F.col("original_source")).alias("kind"), start.alias("_start"),
        F.explode(values).alias("_value"))
    return _summed(
        long.withColumnsRenamed({f"_{name}": name for name in keys} | {"_start": "start"}),
        list(keys))


def _summed(long: DataFrame, keys: list[str]) -> DataFrame:
    """States of ``_value`` (``measure`` and ``value``) by ``keys`` and ``kind``."""
    value = F.col("_value.value")
    sums = N.sum_parts(N.exact_parts(value))
    return long.where(value.isNotNull()).groupBy(
        *keys, "kind", F.col("_value.measure").alias("measure")).agg(
        F.count("*").alias("n"), *[part.alias(limb) for limb, part in sums.items()],
        F.max(value).alias("top"), F.min("start").alias("first"), F.max("start").alias("last"))


def daily(acts: DataFrame) -> DataFrame:
    """All measures of ``acts`` by athlete, day and hour, to be stored (``STATE``).

    Few activities share an hour, so they are dealt by it while they are one short row each, not one
    for every measure; a task takes about ``DEALT`` of them.
    """
    start = F.col("start_time")
    keys = ["athlete_id", "day", "hour"]
    short = materialize(acts.select(
        "athlete_id", F.to_date(start).alias("day"), F.hour(start).alias("hour"),
        kind_of(F.col("original_source")).alias("kind"), start.alias("start"), *[
            value.cast("double").alias(name) for name, value in _measures().items()
            if name != RIDE]), "short")
    dealt = short.repartition(-(-short.count() // DEALT) or 1, *keys)
    values = F.array(*[
        F.struct(F.lit(m).alias("measure"), (F.lit(0.0) if m == RIDE else F.col(m)).alias("value"))
        for m in _measures()])
    made = _summed(dealt.select(*keys, "kind", "start", F.explode(values).alias("_value")), keys)
    return made.select(*[F.col(f.name).cast(f.dataType) for f in STATE])


def total() -> Column:
    """Aggregate of states: the exact sum of their values; null where there is none."""
    return N.exact_total(N.sum_sums({limb: F.col(limb) for limb in N.LIMBS}))


def settled(
    source: DataFrame | Daily, keys: dict[str, Callable[[When], Column]],
    measures: tuple[str, ...] = (RIDE,), kind: str | None = None, split: bool = True,
) -> DataFrame:
    """Keys, ``kind``, ``measure``, ``n``, ``total``, ``top``, ``first``, ``last`` and ``mean``.

    Without ``split`` all kinds are taken together and ``kind`` is null.
    """
    rows = states(source, keys, measures, kind)
    if not split:
        rows = rows.withColumn("kind", F.lit(None).cast("string"))
    return rows.groupBy(*keys, "kind", "measure").agg(
        F.sum("n").alias("n"), total().alias("total"), F.max("top").alias("top"),
        F.min("first").alias("first"), F.max("last").alias("last")).withColumn(
        "mean", F.try_divide("total", "n"))


def of(measure: str, column: str, kind: str | None = None) -> Column:
    """Aggregate of settled rows: ``column`` of the one row of that measure (and kind)."""
    mine = F.col("measure") == measure
    if kind is not None:
        mine &= F.col("kind") == kind
    return F.max(F.when(mine, F.col(column)))


def rides(kind: str | None = None) -> Column:
    """Aggregate of settled rows: the number of activities (of a kind), 0 without any."""
    mine = F.col("measure") == RIDE
    if kind is not None:
        mine &= F.col("kind") == kind
    return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0).cast("long"))


def year(when: When) -> Column:
    return F.year(when.start)


def month(when: When) -> Column:
    return F.trunc(when.start, "MM")


def week(when: When) -> Column:
    return times.week_start(when.start)
