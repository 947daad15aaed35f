import pytest
from pyspark.sql import functions as F

from stridelake import schemas
from stridelake.operators import intervals, rollups
from stridelake.plans import reports
from tests.helpers import activities, activity, records, strength, utc

START = "2026-06-01"


def no_activities(spark):
    return spark.createDataFrame([], schemas.ACTIVITY)


def test_header_derives_miles_and_days_from_rounded_values(spark):
    df = activities(
        spark,
        activity(1, "2026-06-01 10:00:00", "garmin", distance_m=1499.0, elapsed_time_s=5400.0,
                 calories=10.0, elevation_gain_m=5.0),
        activity(2, "2026-06-02 10:00:00", "peloton", elapsed_time_s=3600.0),
        activity(3, "2026-06-03 10:00:00", None, elapsed_time_s=None),
    )
    row = rollups.header_stats(df).first()
    assert row.asDict() == dict(
        total_rides=2, outdoor_rides=1, class_rides=1, total_km=1.0, total_mi=1.0,
        total_hours=3.0, total_days=0.1, total_elevation_m=5.0, total_calories=10.0,
        earliest=utc("2026-06-01").date(), latest=utc("2026-06-03").date())


def test_mean_heart_rate_is_over_rides_not_time(spark):
    df = activities(
        spark,
        activity(1, "2026-01-01 00:00:00", "garmin", average_heart_rate=100.0, distance_m=1000.0),
        activity(2, "2026-01-02 00:00:00", "garmin", average_heart_rate=151.0,
                 elapsed_time_s=99999.0),
        activity(3, "2026-01-03 00:00:00", "garmin"),
        activity(4, "2026-01-03 00:00:00", "peloton", average_heart_rate=10.0),
    )
    assert records(rollups.by_year(df)) == [(2026, 3, 1.0, 1.0, 125.5)]


def test_moving_averages_use_the_year_of_the_point(spark):
    acts = activities(
        spark, activity(1, "2025-12-31 23:00:00", "garmin"), activity(2, "2025-06-01", "peloton"))
    points = spark.createDataFrame([
        ("1", utc("2025-12-31 23:59:59"), 80, 0.0), ("1", utc("2026-01-01 00:00:00"), 0, 5.0),
        ("1", utc("2026-01-01 00:00:01"), 90, 6.0), ("2", utc("2026-01-01"), 10, 1.0),
        ("lost", utc("2026-01-01"), 10, 1.0),
    ], "activity_id string, timestamp timestamp, cadence int, speed_mps double")
    assert records(rollups.moving_averages_by_year(points, acts)) == [
        (2025, 80.0, None), (2026, 90.0, 19.8)]


def test_hours_are_local_and_complete(spark):
    df = activities(spark, activity(1, "2026-06-01 03:00:00", "garmin"))
    rows = dict(records(rollups.by_local_hour(df)))
    assert len(rows) == 24 and rows[22] == 1 and sum(rows.values()) == 1


def test_class_years_run_to_the_last_year_of_any_source(spark):
    df = activities(
        spark, activity(1, "2019-01-01", "garmin"), activity(2, "2021-01-01"),
        activity(3, "2023-01-01", "garmin"))
    assert records(rollups.class_by_year(df)) == [(2021, 1), (2022, 0), (2023, 0)]
    outdoor = df.where("original_source = 'garmin'")
    assert records(rollups.class_by_year(outdoor)) == [(2023, 0)]
    assert records(rollups.class_by_year(no_activities(spark))) == []


def test_trailing_months(spark):
    df = activities(
        spark, activity(1, "2024-06-20", "garmin"),            # 25th month: not shown
        activity(2, "2024-07-01", "garmin"), activity(3, "2026-06-10", "garmin"),
        activity(4, "2026-06-15", "peloton"))                  # sets the end, is not counted
    rows = records(rollups.trailing_months(df))
    assert len(rows) == 24 and rows[0] == ("2024-07", 1) and rows[-1] == ("2026-06", 1)
    assert sum(n for _, n in rows) == 2
    assert records(rollups.trailing_months(no_activities(spark))) == []


def test_recovery_weeks_of_another_year_do_not_count(spark):
    df = activities(
        spark, activity(1, "2026-06-02"), activity(2, "2026-06-16", "garmin"),
        activity(3, "2020-06-02"))                            # its Monday is 06-01 as well
    lifts = strength(spark, ("2026-06-09 10:00:00", 30.0, False),
                     ("2020-06-02 10:00:00", 30.0, False))
    rows = records(rollups.recovery_weeks(df, lifts, START), "label", "class_n", "strength_n")
    assert rows == [("06-01", 1, 0), ("06-08", 0, 1), ("06-15", 0, 0)]
    assert records(rollups.recovery_weeks(no_activities(spark), lifts, START)) == []


def test_weekly_nulls_and_zeros(spark):
    df = activities(
        spark,
        activity(1, "2026-06-02 10:00:00"),                    # class ride without energy
        activity(2, "2026-06-16 10:00:00", "garmin", elapsed_time_s=90.0),
        activity(3, "2026-05-31 10:00:00", "garmin"))          # before the window
    lifts = strength(spark, ("2026-06-03 10:00:00", None, False))
    rows = rollups.weekly_volume(df, lifts, START).collect()
    first, second, third = rows
    assert (first.class_n, first.class_kj, first.outdoor_n, first.outdoor_km) == (1, None, 0, 0.0)
    assert (first.outdoor_hr, first.strength_n, first.strength_min) == (None, 1, 0.0)
    assert (second.class_n, second.class_kj, second.class_hr) == (0, 0.0, None)
    assert (third.outdoor_n, third.outdoor_min, third.outdoor_km) == (1, 1.5, None)


def test_missing_source_is_outdoor_only_in_the_monthly_report(spark):
    df = activities(
        spark, activity(1, "2026-01-01", None), activity(2, "2026-03-01"),
        activity(3, "2025-12-31", "garmin"))
    assert records(rollups.monthly_by_class(df, START)) == [("2026-01", 1, 0), ("2026-03", 0, 1)]
    row = rollups.window_headline(df, strength(spark), "2025-01-01").first()
    assert (row.outdoor_n, row.class_n, row.strength_n, row.strength_min) == (1, 1, 0, 0.0)


def test_band_average(spark):
    points = spark.createDataFrame(
        [(-1.0, 100), (0.0, 110), (99.9, 121), (100.0, None), (None, 1)],
        "altitude_m double, heart_rate int")
    assert records(rollups.band_average(points, "altitude_m", 100, "heart_rate")) == [
        (-100.0, 1, 100.0), (0.0, 2, 115.5), (100.0, 0, None)]


def test_interval_bounds(spark):
    acts = activities(
        spark, activity("m", "2026-06-01 00:00:00"), activity("e", "2026-06-02 00:00:00"),
        activity("f", "2026-06-02 00:00:01"), activity("l", "2026-06-05 12:00:00"),
        activity("x", "2026-06-01 12:00:00", athlete_id=9))
    day = lambda text: utc(text).date()
    events = spark.createDataFrame([
        (0, "one", "One day", day("2026-06-01"), None),
        (0, "span", "Span", day("2026-06-02"), day("2026-06-05")),
        (0, "back", "Backwards", day("2026-06-05"), day("2026-06-01"))],
        "athlete_id bigint, id string, title string, date date, date_end date")
    got = reports.activities_during_events(acts, events)
    assert sorted(records(got, "id", "event_id")) == [
        ("e", "one"), ("e", "span"), ("f", "span"), ("m", "one")]


def test_reading_on_a_boundary_counts_twice(spark):
    acts = activities(spark, activity(1, "2026-06-02"), activity(2, "2026-06-09"),
                      activity(3, "2026-06-09"), activity(4, "2026-07-01"))
    weights = spark.createDataFrame(
        [(utc("2026-06-08 00:00:00"), 150.0), (utc("2026-06-10"), 160.0)],
        "recorded_at timestamp, weight_lb double")
    rows = records(intervals.bucket_average(acts, weights).orderBy("week"))
    assert [(str(w), n, a) for w, n, a in rows] == [
        ("2026-06-01", 1, 150.0), ("2026-06-08", 2, 155.0), ("2026-06-29", 1, None)]


def test_report_bundles_have_all_sections(spark, tmp_path):
    from stridelake.sinks import sections

    df = activities(
        spark, activity(1, "2026-06-02 06:00:00"), activity(2, "2026-06-03 06:00:00", "garmin"))
    lifts = strength(spark, ("2026-06-02 06:15:00", 30.0, False))
    points = spark.createDataFrame([], schemas.TRACK_POINT)
    bundle = {**reports.dashboard(df, points, lifts), **reports.training_report(df, lifts)}
    sections.write_bundle(bundle, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out" / "strength_sessions")).first()
    assert back.warmup_ride == "Ride 1"
    assert {p.name for p in (tmp_path / "out").iterdir()} == set(bundle)


def test_sorted_section_keeps_its_order_across_files(spark, tmp_path):
    from stridelake.sinks import sections

    path = str(tmp_path / "sorted")
    sections.write_section(
        spark.range(1000).withColumn("x", F.col("id") * 37 % 1000).repartition(8), path, ["x"])
    parts = sorted(p for p in (tmp_path / "sorted").iterdir() if p.suffix == ".json")
    values = [int(line.split(":")[-1].strip("}\n")) for p in parts for line in p.open()]
    assert values == sorted(values) and len(values) == 1000
