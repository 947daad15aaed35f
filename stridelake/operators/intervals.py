"""Interval joins and averages of irregular readings per calendar bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions import numeric as N, times

LEVELS = 22  # 2 ** 22 days are more than the calendar has


def interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    ts: str,
    start: str,
    end: str,
    by: list[str],
    default_days: int = 1,
) -> DataFrame:
    """Facts inside date intervals: ``start <= ts <= end``, both at midnight and inclusive.

    A missing ``end`` means ``start`` plus ``default_days``. An interval is covered by aligned
    blocks of 1, 2, 4, 8 ... days, two of a size at most, so even one that ends in the year 9999
    makes fewer than fifty rows. A fact names its block of every size that occurs, and meets an
    interval in exactly one of them. An interval whose end lies before its start holds nothing.
    """
    last = F.coalesce(F.col(end), F.date_add(F.col(start), default_days))
    covered = (
        intervals.withColumn("_last", last).where(F.col("_last") >= F.col(start))
        .withColumn("_block", F.explode(_blocks(F.unix_date(F.col(start)),
                                                F.unix_date(F.col("_last")))))
        .select("*", F.col("_block.level").alias("_level"), F.col("_block.nth").alias("_nth"))
        .drop("_block"))
    levels = [row["_level"] for row in covered.select("_level").distinct().collect()]  # few sizes
    day = F.unix_date(F.to_date(F.col(ts)))
    named = F.array(*[
        F.struct(F.lit(k).alias("level"), F.shiftright(day, k).alias("nth"))
        for k in sorted(levels) or [0]])
    dated = (
        facts.withColumn("_block", F.explode(named))
        .select("*", F.col("_block.level").alias("_level"), F.col("_block.nth").alias("_nth"))
        .drop("_block"))
    met = dated.join(covered, [*by, "_level", "_nth"])
    inside = F.col(ts) <= F.col("_last").cast("timestamp")
    return met.where(inside).drop("_level", "_nth", "_last")


def _blocks(first: Column, last: Column) -> Column:
    """Disjoint aligned blocks (``level``, ``nth``; ``2 ** level`` days) from ``first`` to ``last``,
    both day numbers."""
    def at(level: Column) -> Column:
        low = -F.call_function("shiftright", -first, level)  # rounded up
        high = F.call_function("shiftright", last + 1, level)
        left = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), low)
        right = F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), high - 1)
        return F.transform(
            F.array_compact(F.array(left, right)),
            lambda nth: F.struct(level.alias("level"), nth.alias("nth")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))


def bucket_average(
    acts: DataFrame, readings: DataFrame, by: list[str] | None = None, days: int = 7
) -> DataFrame:
    """Activities per week with the mean weight of the readings in ``[week, week + days]``.

    The bucket is closed on both ends, so a reading at the very first instant of a week also
    counts for the bucket that ends there. Weeks come from the activities alone. Each reading
    names its buckets itself, which leaves two aggregations and an equi-join on the week.
    """
    by = by or []
    taken = F.col("recorded_at")
    # Mondays from the earliest bucket that still reaches the reading to the reading's own week.
    own = F.date_trunc("week", taken)
    reach = taken - F.make_dt_interval(F.lit(days))
    first = F.date_trunc("week", reach)
    first = F.when(first < reach, first + F.make_dt_interval(F.lit(7))).otherwise(first)
    buckets = F.sequence(F.to_date(first), F.to_date(own), F.expr("INTERVAL 7 DAYS"))
    means = (
        readings.where(taken.isNotNull() & (first <= own))
        .select(*by, F.explode(buckets).alias("week"), "weight_lb")
        .groupBy(*by, "week").agg(N.exact_avg(F.col("weight_lb")).alias("avg_weight_lb"))
    )
    weeks = acts.groupBy(*by, times.week_start(F.col("start_time")).alias("week")).agg(
        F.count("*").alias("activities"))
    return weeks.join(means, [*by, "week"], "left")
