"""Aggregations over activities and track points.

All of them group on keys of calendar size and read each input once. Where a report needs both
groups and an overall bound (the latest activity), the bound is taken from the groups. Those over
activities take either the activities or a daily table of states (:class:`states.Daily`).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions import numeric as N, text as X, times
from stridelake.operators import calendars, states
from stridelake.operators.states import CLASS, OUTDOOR, Daily, of, rides

WINDOW_START = date(2026, 6, 1)  # fixed value
TRAILING_MONTHS = 24  # fixed value


def _outdoor() -> Column:
    return X.is_outdoor(F.col("original_source"))


def _when(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def _since(start: date | str) -> Callable[[states.When], Column]:
    return lambda when: times.since(when.start, start)


def _by(columns: list[str] | None) -> dict[str, Callable[[states.When], Column]]:
    return {c: lambda when, c=c: F.col(c) for c in columns or []}


def header_stats(acts: DataFrame | Daily, by: list[str] | None = None) -> DataFrame:
    """One row of totals (per ``by``, e.g. the athlete). Miles and days derive from the rounded
    kilometres and hours."""
    all_kinds = states.states(
        acts, _by(by), (states.RIDE, "distance", "elapsed", "elevation", "calories"))

    def total(measure: str) -> Column:
        limbs = {limb: _when(F.col("measure") == measure, F.col(limb)) for limb in N.LIMBS}
        return N.exact_total(N.sum_sums(limbs))

    def or_zero(value: Column) -> Column:
        return _when(F.count("*") > 0, F.coalesce(value, F.lit(0.0)))

    totals = all_kinds.groupBy(*(by or [])).agg(
        rides(OUTDOOR).alias("outdoor_rides"),
        rides(CLASS).alias("class_rides"),
        N.round_half_up(N.m_to_km(total("distance")), 0).alias("total_km"),
        N.round_half_up(N.s_to_h(total("elapsed")), 0).alias("total_hours"),
        N.round_half_up(or_zero(total("elevation")), 0).alias("total_elevation_m"),
        N.round_half_up(or_zero(total("calories")), 0).alias("total_calories"),
        F.to_date(F.min("first")).alias("earliest"),
        F.to_date(F.max("last")).alias("latest"),
    )
    return totals.select(
        *(by or []),
        (F.col("outdoor_rides") + F.col("class_rides")).alias("total_rides"),
        "outdoor_rides", "class_rides", "total_km",
        N.round_half_even(N.km_to_mi(F.col("total_km"))).alias("total_mi"),
        "total_hours",
        N.round_half_even(N.h_to_days(F.col("total_hours")), 1).alias("total_days"),
        "total_elevation_m", "total_calories", "earliest", "latest",
    )


def by_year(acts: DataFrame | Daily, by: list[str] | None = None) -> DataFrame:
    """Outdoor rides per year (and ``by``): count, distance, longest, mean of the per-ride heart
    rates."""
    years = states.settled(
        acts, {**_by(by), "yr": states.year}, (states.RIDE, "distance", "hr"), OUTDOOR)
    return (
        years.groupBy(*(by or []), "yr")
        .agg(
            rides().alias("n"),
            N.round_half_up(N.m_to_km(of("distance", "total")), 1).alias("total_km"),
            N.round_half_up(N.m_to_km(of("distance", "top")), 1).alias("longest_km"),
            N.round_half_up(of("hr", "mean"), 1).alias("avg_hr"),
        )
        .orderBy("yr", *(by or []))
    )


def moving_averages_by_year(tracks: DataFrame, acts: DataFrame) -> DataFrame:
    """Mean cadence and speed of outdoor rides per year of the track point, stopped time left out.

    The points shrink to sums per activity and year before they meet the activities, so the join
    moves activities, not points, and an activity with a huge track is no heavier than another.
    """
    cadence, speed = F.col("cadence"), F.col("speed_mps")
    pedalling, moving = cadence > 0, speed > 0
    parts = N.sum_parts(N.exact_parts(_when(moving, speed)))
    partial = (
        tracks.groupBy("activity_id", F.year("timestamp").alias("yr"))
        .agg(
            F.sum(_when(pedalling, cadence)).alias("cadence"),
            F.count_if(pedalling).alias("cadence_n"),
            *[part.alias(name) for name, part in parts.items()],
            F.count_if(moving).alias("speed_n"),
        )
    )
    outdoor = acts.where(_outdoor()).select(F.col("id").alias("activity_id"))
    speed_sum = N.exact_total(N.sum_sums({name: F.col(name) for name in parts}))
    return (
        partial.join(outdoor, "activity_id").groupBy("yr")
        .agg(
            N.round_half_up(F.try_divide(F.sum("cadence"), F.sum("cadence_n")), 1)
            .alias("avg_cadence"),
            N.round_half_up(N.mps_to_kmh(F.try_divide(speed_sum, F.sum("speed_n"))), 1)
            .alias("avg_speed_kmh"),
        )
        .orderBy("yr")
    )


def by_local_hour(
    acts: DataFrame | Daily, offset_hours: int = times.LOCAL_OFFSET_HOURS
) -> DataFrame:
    """Outdoor rides per local hour, all 24 hours present."""
    hour = {"local_hour": lambda when: F.pmod(when.hour + F.lit(offset_hours), F.lit(24))}
    counts = states.states(acts, hour, kind=OUTDOOR).groupBy("local_hour").agg(rides().alias("n"))
    spine = calendars.hour_spine(counts.sparkSession)
    return calendars.fill(spine, counts, ["local_hour"], ["n"]).orderBy("local_hour")


def class_by_year(acts: DataFrame | Daily) -> DataFrame:
    """Class rides per year, from the first class year to the last year of any source."""
    years = (
        states.states(acts, {"yr": states.year}).groupBy("yr").agg(rides(CLASS).alias("n"))
        .where(F.col("yr").isNotNull())
    )
    bounds = years.agg(
        F.min(_when(F.col("n") > 0, F.col("yr"))).alias("first_year"),
        F.max("yr").alias("last_year"),
    )
    spine = calendars.year_spine(bounds)
    return calendars.fill(spine, years, ["yr"], ["n"]).orderBy("yr")


def trailing_months(acts: DataFrame | Daily, n: int = TRAILING_MONTHS) -> DataFrame:
    """Outdoor rides in the ``n`` months that end with the month of the latest activity.

    The latest activity is of any source. An instant-based cut-off ``n`` months back could only
    touch a month before the first one shown, so whole months are counted.
    """
    months = states.states(acts, {"month": states.month}).groupBy("month").agg(
        rides(OUTDOOR).alias("n"), F.max("last").alias("latest"))
    spine = calendars.month_spine(months.agg(F.max("latest").alias("latest")), n)
    counts = months.where(F.col("month").isNotNull()).select(
        times.month_key(F.col("month")).alias("ym"), "n")
    return calendars.fill(spine, counts, ["ym"], ["n"]).orderBy("ym")


def recovery_weeks(
    acts: DataFrame | Daily, strength: DataFrame, start: date | str = WINDOW_START
) -> DataFrame:
    """Class rides and strength sessions per week, every week from ``start`` to the latest data.

    Weeks are keyed by their Monday; the month-day form is for display only.
    """
    found = states.states(acts, {"week": states.week, "recent": _since(start)})
    weeks = found.groupBy("week").agg(
        F.coalesce(F.sum(_when(F.col("recent") & (F.col("kind") == CLASS), F.col("n"))),
                   F.lit(0)).alias("class_n"),
        F.max("last").alias("latest"))
    sessions = (
        strength.where(F.col("date") >= F.lit(str(start)).cast("date"))
        .groupBy(times.week_start(F.col("start")).alias("week"))
        .agg(F.count("*").alias("strength_n"))
    )
    spine = calendars.week_spine(weeks.agg(F.max("latest").alias("latest")), start)
    filled = calendars.fill(spine, weeks.select("week", "class_n"), ["week"], ["class_n"])
    filled = calendars.fill(filled, sessions, ["week"], ["strength_n"])
    return filled.select(
        "week", times.week_day_key(F.col("week")).alias("label"), "class_n", "strength_n",
    ).orderBy("week")


def weekly_volume(
    acts: DataFrame | Daily, strength: DataFrame, start: date | str = WINDOW_START
) -> DataFrame:
    """Outdoor, class and strength volume side by side per week.

    Counts and volumes of a week without that kind of activity are 0, rates are null. If the week
    has such activity but no measurement, the null stays.
    """
    found = states.settled(
        acts, {"week": states.week, "recent": _since(start)},
        (states.RIDE, "elapsed", "distance", "hr", "cadence", "speed", "output"))
    recent = F.col("recent")
    kinds = F.when(recent, F.col("kind"))  # what lies before only bounds the calendar

    def minutes(kind: str) -> Column:
        return N.round_half_up(N.s_to_min(of("elapsed", "total", kind)), 1)

    def or_zero(kind: str, value: str) -> Column:
        return F.when(F.coalesce(F.col(kind), F.lit(0)) == 0, F.lit(0.0)).otherwise(F.col(value))

    weeks = found.withColumn("kind", kinds).groupBy("week").agg(
        F.max("last").alias("latest"),
        rides(OUTDOOR).alias("outdoor_n"),
        minutes(OUTDOOR).alias("outdoor_min"),
        N.round_half_up(N.m_to_km(of("distance", "total", OUTDOOR)), 1).alias("outdoor_km"),
        N.round_half_up(of("hr", "mean", OUTDOOR), 1).alias("outdoor_hr"),
        N.round_half_up(of("cadence", "mean", OUTDOOR), 1).alias("outdoor_cadence"),
        N.round_half_up(N.mps_to_kmh(of("speed", "mean", OUTDOOR)), 1).alias("outdoor_speed"),
        rides(CLASS).alias("class_n"),
        minutes(CLASS).alias("class_min"),
        N.round_half_up(of("hr", "mean", CLASS), 1).alias("class_hr"),
        N.round_half_up(of("output", "total", CLASS), 1).alias("class_kj"),
    )
    sessions = (
        strength.where(F.col("date") >= F.lit(str(start)).cast("date"))
        .groupBy(times.week_start(F.col("start")).alias("week"))
        .agg(
            F.count("*").alias("strength_n"),
            N.exact_sum(F.coalesce("minutes", F.lit(0.0))).alias("minutes"),
        )
        # Rounding names its input many times, so it comes after the sum is made.
        .select("week", "strength_n",
                N.round_half_even(F.col("minutes"), 1).alias("strength_min"))
    )
    spine = calendars.week_spine(weeks.agg(F.max("latest").alias("latest")), start)
    joined = spine.join(weeks.drop("latest"), "week", "left").join(sessions, "week", "left")
    return joined.select(
        "week",
        times.week_label(F.col("week")).alias("label"),
        F.coalesce("outdoor_n", F.lit(0)).alias("outdoor_n"),
        or_zero("outdoor_n", "outdoor_min").alias("outdoor_min"),
        or_zero("outdoor_n", "outdoor_km").alias("outdoor_km"),
        "outdoor_hr", "outdoor_cadence", "outdoor_speed",
        F.coalesce("class_n", F.lit(0)).alias("class_n"),
        or_zero("class_n", "class_min").alias("class_min"),
        "class_hr",
        or_zero("class_n", "class_kj").alias("class_kj"),
        F.coalesce("strength_n", F.lit(0)).alias("strength_n"),
        F.coalesce("strength_min", F.lit(0.0)).alias("strength_min"),
    ).orderBy("week")


def monthly_by_class(
    acts: DataFrame | Daily, start: date | str = WINDOW_START, by: list[str] | None = None
) -> DataFrame:
    """Outdoor and class rides per month (and ``by``) since 1 January of the window's year, months
    with data only. A missing source counts as outdoor here."""
    january = date.fromisoformat(str(start)).replace(month=1, day=1)
    if isinstance(acts, Daily):
        recent = Daily(acts.states.where(times.since(F.col("day"), january)))
    else:
        recent = acts.where(times.since(F.col("start_time"), january))
    return (
        states.states(recent, {**_by(by), "first_day": states.month})
        .groupBy(*(by or []), "first_day")
        .agg((rides() - rides(CLASS)).alias("outdoor"), rides(CLASS).alias("class"))
        .select(*(by or []), times.month_key(F.col("first_day")).alias("month"), "outdoor", "class")
        .orderBy("month", *(by or []))
    )


def window_headline(
    acts: DataFrame | Daily, strength: DataFrame, start: date | str = WINDOW_START
) -> DataFrame:
    """One row of totals since ``start`` over the three kinds of activity."""
    found = states.settled(
        acts, {"recent": _since(start)}, (states.RIDE, "elapsed", "distance")).where("recent")
    lifts = (
        strength.where(F.col("date") >= F.lit(str(start)).cast("date"))
        .agg(F.count("*").alias("n"), N.exact_sum(F.coalesce("minutes", F.lit(0.0)))
             .alias("total"))
        .withColumn("measure", F.lit("strength")))
    return found.unionByName(lifts, allowMissingColumns=True).agg(
        rides(OUTDOOR).alias("outdoor_n"),
        N.round_half_up(N.s_to_min(of("elapsed", "total", OUTDOOR)), 0).alias("outdoor_min"),
        N.round_half_up(N.m_to_km(of("distance", "total", OUTDOOR)), 0).alias("outdoor_km"),
        rides(CLASS).alias("class_n"),
        N.round_half_up(N.s_to_min(of("elapsed", "total", CLASS)), 0).alias("class_min"),
        of("strength", "n").alias("strength_n"),
        F.coalesce(N.round_half_even(of("strength", "total"), 1), F.lit(0.0))
        .alias("strength_min"),
    )


def band_average(
    tracks: DataFrame, band: str, width: float, measure: str, out: str = "average"
) -> DataFrame:
    """Mean of ``measure`` per band of ``width`` units of ``band``, e.g. heart rate by altitude."""
    lower = F.floor(F.col(band) / F.lit(float(width))) * F.lit(float(width))
    return (
        tracks.where(F.col(band).isNotNull())
        .groupBy(lower.alias("band"))
        .agg(
            F.count(measure).alias("n"),
            N.round_half_up(N.exact_avg(F.col(measure)), 1).alias(out),
        )
        .orderBy("band")
    )


def gps_flags(points: DataFrame) -> DataFrame:
    """``gps_track_available`` per activity: whether any of its points has a position."""
    fix = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return points.groupBy("activity_id").agg(
        F.coalesce(F.bool_or(fix), F.lit(False)).alias("gps_track_available"))
