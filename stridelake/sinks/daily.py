"""The stored daily table of states, kept up to date batch by batch.

A batch of new activities adds its own states and reads nothing else. Where it replaces activities
that are stored already, the days these lay on or lie on now are made anew from the activity table,
and what was stored of such a day before no longer counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stridelake.operators import states
from stridelake.sinks.tables import BASE, Versions, read_folders, write_partitioned

STORED = T.StructType([
    *states.STATE,
    T.StructField("version", T.LongType()),  # larger for what was stored later
    T.StructField("anew", T.BooleanType())])  # nothing older counts for this day


@dataclass(frozen=True)
class DailyTable:
    path: str

    def _counting(self, spark: SparkSession) -> DataFrame:
        """The states that count, with ``_whole`` where all of the day are of one version."""
        rows = read_folders(spark, STORED, list(Versions(spark, self.path).live().values()))
        # One row per day decides which versions of the day count; days are few, whatever is stored.
        since = rows.groupBy(F.col("day").alias("_day")).agg(
            F.coalesce(F.max(F.when(F.col("anew"), F.col("version"))), F.lit(-1)).alias("_since"),
            F.min("version").alias("_oldest"), F.max("version").alias("_newest"))
        whole = F.greatest("_since", "_oldest") == F.col("_newest")
        return rows.join(F.broadcast(since), F.col("day").eqNullSafe(F.col("_day"))).where(
            (F.col("version") >= F.col("_since")) & F.col("measure").isNotNull()).select(
            *[f.name for f in states.STATE], whole.alias("_whole"))

    def read(self, spark: SparkSession) -> states.Daily:
        """All states that count; several may share a key."""
        return states.Daily(self._counting(spark).drop("_whole"))

    def days_of(self, spark: SparkSession, batch: str) -> DataFrame:
        """``day`` of all that a batch has stored here before."""
        live = Versions(spark, self.path).live()
        return read_folders(spark, STORED, [live[batch]] if batch in live else []).select(
            "day").distinct()

    def _store(self, made: DataFrame, anew: bool, batch: str) -> None:
        versions = Versions(made.sparkSession, self.path)
        rows = made.withColumns({
            "version": F.lit(versions.next_number()).cast("long"), "anew": F.lit(anew)})
        versions.store(rows.select(*[f.name for f in STORED]), batch, {})

    def add(self, acts: DataFrame, batch: str) -> None:
        """Add the states of activities that were not stored before."""
        self._store(states.daily(acts), False, batch)

    def renew(self, acts: DataFrame, days: DataFrame, batch: str) -> None:
        """Make the ``day`` values of ``days`` anew from all activities ``acts``.

        A day without any activity left is stored as a row without a measure.
        """
        wanted = days.select(F.col("day").alias("_day")).distinct()
        on_day = F.to_date("start_time").eqNullSafe(F.col("_day"))
        made = states.daily(acts.join(wanted, on_day, "left_semi"))
        empty = wanted.select(*[
            (F.col("_day") if f.name == "day" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in states.STATE])
        self._store(made.unionByName(empty), True, batch)

    def compact(self, spark: SparkSession) -> None:
        """One row per key, in one version. A version has one row per key already, so only days of
        which several count are added up."""
        versions = Versions(spark, self.path)
        folder = versions.fresh_folder()
        keys = [F.col(c) for c in ("athlete_id", "day", "hour")]
        counting = self._counting(spark)
        added = states.merged(counting.where("NOT _whole"), keys).select(
            *[F.col(f.name).cast(f.dataType) for f in states.STATE])
        rows = counting.where("_whole").drop("_whole").unionByName(added).withColumns({
            "version": F.lit(versions.next_number()).cast("long"), "anew": F.lit(True)})
        write_partitioned(rows, folder, {})
        versions.commit({BASE: folder})


def replaced_days(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """``day`` of every stored activity that ``incoming`` brings again, and of those it brings in
    their place; no rows for a batch of new activities.

    ``stored`` should also hold the rows that no longer count, so that a batch that is made again
    after a crash still finds the days it has to renew.
    """
    def days(df: DataFrame) -> DataFrame:
        return df.select(key, F.to_date("start_time").alias("day"))

    keys = incoming.select(key).distinct()
    old = days(stored).join(keys, key, "left_semi")
    again = days(incoming).join(old.select(key).distinct(), key, "left_semi")
    return old.unionByName(again).select("day").distinct()
