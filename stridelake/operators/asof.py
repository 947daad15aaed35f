"""As-of matching: the latest earlier event of another kind on the same day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions import times
from stridelake.operators import scan

TOLERANCE_S = 1200  # fixed value


def asof_same_day(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_ts: str,
    right_ts: str,
    payload: list[str],
    tie_break: list[str],
    tolerance_s: float = TOLERANCE_S,
    waive: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``left`` with ``match``: the ``payload`` and ``right_ts`` of the latest ``right`` row of the
    same key and day that is not later, or null.

    Among right rows with the same ``right_ts`` the first by ``tie_break`` is taken. A match
    further away than ``tolerance_s`` (inclusive) is dropped unless ``waive`` holds.

    No pairs are formed: both sides shrink to one point per instant, and a running last value
    over the points finds the match.
    """
    candidate = F.struct(F.col(right_ts).alias("at"), *payload)
    rights = right.where(F.col(right_ts).isNotNull()).groupBy(*by, F.col(right_ts).alias("_ts")).agg(
        F.min_by(candidate, F.struct(*tie_break)).alias("_value"))
    lefts = left.where(F.col(left_ts).isNotNull()).select(*by, F.col(left_ts).alias("_ts"))
    points = (
        rights.unionByName(lefts, allowMissingColumns=True)
        .groupBy(*by, "_ts").agg(F.max("_value").alias("_value"))
        .withColumn("_day", F.to_date("_ts"))
    )
    matched = (
        scan.carry_forward(points, [*by, "_day"], "_ts", "_value", "match", parts)
        .where(F.col("match").isNotNull())
        .select(*by, F.col("_ts").alias(left_ts), "match")
    )
    joined = left.join(matched, [*by, left_ts], "left")
    close = times.seconds_between(F.col("match.at"), F.col(left_ts)) <= tolerance_s
    if waive is not None:
        close = close | F.coalesce(waive, F.lit(False))
    return joined.withColumn("match", F.when(close, F.col("match")))


def tag_back(right: DataFrame, matches: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Write ``value`` of the matched left rows back to ``right``; the largest one wins.

    ``matches`` is the result of :func:`asof_same_day` with ``key`` among its payload.
    """
    tags = (
        matches.where(F.col("match").isNotNull())
        .groupBy(F.col(f"match.{key}").alias(key)).agg(F.max(value).alias(out))
    )
    return right.join(tags, key, "left")
