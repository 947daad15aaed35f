"""The two report bundles and the single-question reports, one frame per section."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from stridelake.functions import text as X, times
from stridelake.operators import asof, calendars, intervals, rollups, sessions, states
from stridelake.session import materialize


def dashboard(
    acts: DataFrame, tracks: DataFrame, strength: DataFrame,
    start: date | str = rollups.WINDOW_START, daily: states.Daily | None = None,
) -> dict[str, DataFrame]:
    """All sections of the overview page.

    The activities are read once for a daily table of states, from which the sections are made, and
    once for the ids of outdoor rides that the track points need. A stored table may be given as
    ``daily``; then the activities are only read for the latter.
    """
    days = daily or daily_states(acts)
    return {
        "stats": rollups.header_stats(days),
        "by_year": rollups.by_year(days),
        "cadence_speed_by_year": rollups.moving_averages_by_year(tracks, acts),
        "hour_of_day": rollups.by_local_hour(days),
        "class_by_year": rollups.class_by_year(days),
        "monthly_last_24": rollups.trailing_months(days),
        "recovery": rollups.recovery_weeks(days, strength, start),
    }


def daily_states(acts: DataFrame) -> states.Daily:
    """The states of all activities, written once."""
    return states.Daily(materialize(states.daily(acts), "daily"))


def class_bundles(
    acts: DataFrame, start: date | str = rollups.WINDOW_START, gap_s: float = sessions.GAP_S
) -> DataFrame:
    """Bundled class rides since ``start``, written once: sessions, orphans and the strength match
    all start from them."""
    rides = acts.where(X.is_class(F.col("original_source")) & times.since(
        F.col("start_time"), start))
    return materialize(sessions.bundle_records(rides, gap_s), "bundles")


def match_strength(
    bundles: DataFrame, strength: DataFrame, tolerance_s: float = asof.TOLERANCE_S
) -> DataFrame:
    """Strength sessions with the ride that warmed them up, if any.

    The logged time of a trainer-led session is late by hours, so for those any earlier ride of
    the day counts.
    """
    rides = bundles.select(
        "athlete_id", "bundle_start", "bundle_end",
        F.col("main.id").alias("ride_id"), F.col("main.name").alias("ride_name"))
    return asof.asof_same_day(
        strength, rides, ["athlete_id"], "start", "bundle_end",
        payload=["ride_id", "ride_name"], tie_break=["bundle_start", "ride_id"],
        tolerance_s=tolerance_s, waive=F.col("trainer_led"))


def class_sessions(
    bundles: DataFrame, matches: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Sessions and orphan splits, each with the strength day it was the warm-up for."""
    def tagged(rides: DataFrame) -> DataFrame:
        return asof.tag_back(
            rides.withColumnRenamed("id", "ride_id"), matches, "ride_id", "date",
            "pre_strength_for").drop("bundle_start", "bundle_end")

    main, orphans = sessions.summarize_bundles(bundles)
    return tagged(main), tagged(orphans)


def strength_report(matches: DataFrame) -> DataFrame:
    return matches.select(
        "athlete_id", "date", "name", "minutes", "logged_minutes", "trainer_led",
        F.col("match.ride_name").alias("warmup_ride"))


def training_report(
    acts: DataFrame, strength: DataFrame, start: date | str = rollups.WINDOW_START,
    gap_s: float = sessions.GAP_S, tolerance_s: float = asof.TOLERANCE_S,
    daily: states.Daily | None = None,
) -> dict[str, DataFrame]:
    """All sections of the training report, in the order of their dates.

    The activities are read for the bundles and, unless a stored table is given as ``daily``, once
    for the states.
    """
    days = daily or daily_states(acts)
    recent = strength.where(F.col("date") >= F.lit(str(start)).cast("date"))
    bundles = class_bundles(acts, start, gap_s)
    matches = materialize(match_strength(bundles, recent, tolerance_s), "matches")
    main, orphans = class_sessions(bundles, matches)
    latest = days.states.agg(F.max("last").alias("latest"))
    return {
        "weeks": calendars.week_spine(latest, start).select(
            "week", times.week_label(F.col("week")).alias("label")),
        "weekly": rollups.weekly_volume(days, recent, start),
        "class_sessions": main.orderBy("date", "ride_id"),
        "class_warmup_only": orphans.orderBy("date", "ride_id"),
        "strength_sessions": strength_report(matches.orderBy("start", "position")),
        "monthly": rollups.monthly_by_class(days, start),
        "headline": rollups.window_headline(days, recent, start),
    }


def activities_during_events(acts: DataFrame, events: DataFrame) -> DataFrame:
    """Activities that happened during a life event of the same athlete."""
    facts = acts.select("athlete_id", "id", "start_time")
    periods = events.select(
        "athlete_id", F.col("id").alias("event_id"), "title", "date", "date_end")
    return intervals.interval_join(
        facts, periods, "start_time", "date", "date_end", ["athlete_id"]
    ).select("athlete_id", "id", "start_time", "event_id", "title")
