import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from stridelake.operators import asof, sessions
from stridelake.plans import reports
from tests import models
from tests.helpers import activities, activity, strength, utc

T0 = utc("2026-06-03 06:00:00")


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def bundle_starts(df):
    return {r.id: (r.bundle_start.replace(tzinfo=T0.tzinfo) - T0).total_seconds()
            for r in df.collect()}


def random_rides(seed, athletes=40, rows=900):
    rng = random.Random(seed)
    return [
        (rng.randrange(athletes), f"{i:05d}", at(60 * rng.randrange(0, 4000)),
         float(rng.choice([0, 60, 300, 600, 3600])))
        for i in range(rows)]


def as_activities(spark, rides):
    return activities(spark, *[
        activity(id, start, athlete_id=athlete, elapsed_time_s=seconds)
        for athlete, id, start, seconds in rides])


def test_gap_is_inclusive_and_measured_from_the_previous_row(spark):
    df = activities(
        spark,
        activity("a", at(0), elapsed_time_s=100.0),
        activity("b", at(700), elapsed_time_s=100.0),     # exactly 600 s after a
        activity("c", at(1401), elapsed_time_s=5000.0),   # 601 s after b
        activity("d", at(1500), elapsed_time_s=60.0),     # inside c
        activity("e", at(2200), elapsed_time_s=60.0),     # 640 s after d though inside c
        activity("f", at(2200), elapsed_time_s=60.0),     # same start as e
    )
    assert bundle_starts(sessions.bundle_by_gap(df)) == {
        "a": 0, "b": 0, "c": 1401, "d": 1401, "e": 2200, "f": 2200}


# Many ranges cut every athlete to pieces.
@pytest.mark.parametrize("parts,athletes", [(1, 40), (7, 40), (60, 40), (300, 40), (13, 2)])
def test_bundles_and_roles_match_the_model(spark, parts, athletes):
    rides = random_rides(parts, athletes)
    rides = [(None if a == 1 else a, *rest) for a, *rest in rides]
    df = as_activities(spark, rides)
    marked = sessions.mark_main(df, 600, parts).collect()
    expected, roles = models.bundles(rides, 600), models.roles(rides, 600)
    assert len(marked) == len(rides)
    assert {r.id: r.bundle_start.replace(tzinfo=T0.tzinfo) for r in marked} == expected
    assert {r.id: r.role for r in marked} == roles


def test_one_athlete_with_all_rows(spark):
    rides = random_rides(3, athletes=1, rows=1500)
    starts = sessions.bundle_by_gap(as_activities(spark, rides), 600, 50).collect()
    assert {r.id: r.bundle_start.replace(tzinfo=T0.tzinfo) for r in starts} == models.bundles(
        rides, 600)


@pytest.mark.parametrize("parts", [3, 90])
def test_summary_does_not_depend_on_the_ranges(spark, parts):
    df = as_activities(spark, random_rides(11)).withColumn(
        "average_heart_rate", (F.col("elapsed_time_s") % 70) + 90.5)
    columns = ["athlete_id", "bundle_start", "main.id", "bundle_end", "n_rows", "elapsed_sum",
               "warmup_hr", "cooldown_hr"]
    got = sessions.bundle_records(df, 600, parts).select(*columns)
    reference = sessions.bundle_records(df.coalesce(1), 600, 1).select(*columns)
    assert got.exceptAll(reference).isEmpty() and reference.exceptAll(got).isEmpty()


def test_session_record(spark):
    df = activities(
        spark,
        activity("w", at(0), name="Warm Up", elapsed_time_s=300.0, average_heart_rate=100.0,
                 kj=20.0),
        activity("m", at(310), name="Clímb", elapsed_time_s=1200.0, average_heart_rate=140.04,
                 max_heart_rate=170.0, calories=300.0, kj=180.0),
        activity("c1", at(1520), elapsed_time_s=300.0, average_heart_rate=110.0, kj=0.0),
        activity("c2", at(1830), elapsed_time_s=303.0, average_heart_rate=None),
    )
    main, orphans = sessions.summarize_bundles(sessions.bundle_records(df))
    assert orphans.count() == 0
    row = main.first().asDict()
    expected = dict(
        id="m", name="Clmb", hr=140.0, minutes=20.0, max_hr=170.0, total_minutes=35.0,
        watts=150.0, kj=200.0, calories=300.0, high_intensity=True, warmup_hr=100.0,
        cooldown_hr=110.0, hr_recovery=30.0)
    assert {k: row[k] for k in expected} == expected


def test_missing_values_and_ties(spark):
    df = activities(
        spark,
        activity("b", at(0), elapsed_time_s=600.0, kj=0.0),
        activity("a", at(600), elapsed_time_s=600.0, name=None),   # as long, but later
        activity("s", at(0), elapsed_time_s=60.0, average_heart_rate=90.0),
        activity("z", at(99999), elapsed_time_s=0.0, kj=50.0),
    )
    rows = {r.id: r for r in sessions.summarize_bundles(sessions.bundle_records(df))[0].collect()}
    assert set(rows) == {"b", "z"}
    # The row that starts with the main one is neither warm-up nor cool-down.
    assert (rows["b"].warmup_hr, rows["b"].cooldown_hr, rows["b"].total_minutes) == (
        None, None, 21.0)
    assert (rows["b"].kj, rows["b"].watts, rows["b"].hr, rows["b"].high_intensity) == (
        None, None, None, False)
    assert (rows["z"].watts, rows["z"].kj) == (None, 50.0)


def test_only_single_rows_named_so_are_orphans(spark):
    df = activities(
        spark,
        activity("o", at(0), name="10 min Cool Down"),
        activity("p", at(50000), name="Warm-up"), activity("q", at(50600), name="warm up"),
        activity("r", at(90000), name=None),
    )
    main, orphans = sessions.summarize_bundles(sessions.bundle_records(df))
    assert [r.id for r in orphans.collect()] == ["o"]
    assert {r.id for r in main.collect()} == {"p", "r"}


def matches(spark, rides, lifts, **options):
    bundles = sessions.bundle_records(activities(spark, *rides))
    found = reports.match_strength(bundles, strength(spark, *lifts), **options)
    main, orphans = reports.class_sessions(bundles, found)
    tags = {r.ride_id: r.pre_strength_for for r in main.unionByName(
        orphans, allowMissingColumns=True).collect()}
    return {r.position: r.match and r.match.ride_id for r in found.collect()}, tags


def test_tolerance_waiver_and_back_reference(spark):
    rides = [
        activity("early", "2026-06-03 06:00:00", elapsed_time_s=600.0),
        activity("late", "2026-06-03 09:00:00", elapsed_time_s=600.0, name="Warm Up"),
        activity("night", "2026-06-04 23:55:00", elapsed_time_s=600.0),  # ends on the 5th
    ]
    lifts = [
        ("2026-06-03 09:30:00", 30.0, False),  # exactly 1200 s after late
        ("2026-06-03 09:30:01", 30.0, False),  # a second too far
        ("2026-06-03 17:00:00", 60.0, True),   # hours later, but logged afterwards
        ("2026-06-03 09:10:00", 30.0, False),  # at the very end
        ("2026-06-05 00:10:00", 30.0, False),  # the ride's end decides the day
        ("2026-06-03 05:00:00", 30.0, True),   # nothing before it
        ("2026-06-06 00:10:00", 30.0, True),   # nothing on that day
    ]
    found, tags = matches(spark, rides, lifts)
    assert found == {0: "late", 1: None, 2: "late", 3: "late", 4: "night", 5: None, 6: None}
    assert {k: str(v) for k, v in tags.items()} == {
        "early": "None", "late": "2026-06-03", "night": "2026-06-05"}


@pytest.mark.parametrize("parts", [1, 5, 200])
def test_asof_matches_the_model(spark, parts):
    rng = random.Random(5)
    moment = lambda: at(120 * rng.randrange(0, 3000))
    lefts = [(i, rng.randrange(5), moment(), rng.random() < 0.3) for i in range(600)]
    rights = [(i, rng.randrange(5), moment()) for i in range(500)]
    left = spark.createDataFrame(lefts, "l int, key int, ts timestamp, waived boolean")
    right = spark.createDataFrame(rights, "r int, key int, ended timestamp")
    got = asof.asof_same_day(
        left, right, ["key"], "ts", "ended", ["r"], ["r"], 1200, F.col("waived"), parts)
    found = {r.l: r.match and r.match.r for r in got.collect()}
    assert found == models.asof(lefts, rights, 1200)
