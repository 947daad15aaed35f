"""Gap-free calendars and the rule for filling them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.functions import times


def hour_spine(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("local_hour"))


def year_spine(bounds: DataFrame) -> DataFrame:
    """Years from ``first_year`` to ``last_year`` of a one-row frame; without a first year only
    the last one, without any data none."""
    years = F.sequence(F.coalesce("first_year", "last_year"), F.col("last_year"))
    return bounds.select(F.explode(years).alias("yr"))


def month_spine(bounds: DataFrame, n: int) -> DataFrame:
    """The ``n`` months that end with the month of ``latest`` in a one-row frame."""
    last = F.trunc("latest", "MM")
    months = F.sequence(F.add_months(last, 1 - n), last, F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias("month_start")).select(
        times.month_key(F.col("month_start")).alias("ym"))


def week_spine(bounds: DataFrame, start: date | str) -> DataFrame:
    """Mondays from the week of ``start`` to the week of ``latest`` in a one-row frame.

    Empty when there is no data or it all lies before ``start``.
    """
    first = times.week_start(F.lit(str(start)).cast("timestamp"))
    last = times.week_start(F.col("latest"))
    return (
        bounds.where(F.col("latest").isNotNull() & (last >= first))
        .select(F.explode(F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))).alias("week"))
    )


def fill(spine: DataFrame, values: DataFrame, keys: list[str], zero: list[str]) -> DataFrame:
    """Left-join ``values`` to the spine; where the key is absent the ``zero`` columns become 0.

    A null inside a row that is present stays null, as do rates in rows that are absent.
    """
    joined = spine.join(values.withColumn("_present", F.lit(True)), keys, "left")
    for name in zero:
        zero_value = F.lit(0).cast(values.schema[name].dataType)
        joined = joined.withColumn(
            name, F.when(F.col("_present"), F.col(name)).otherwise(zero_value))
    return joined.drop("_present")
