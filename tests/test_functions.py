import math
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stridelake.functions import numeric as N, text as X, times
from tests.helpers import utc


def column(spark, values, build, type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v")).alias("r")).collect()]


def _awkward_numbers():
    rng = random.Random(7)
    numbers = [rng.randrange(0, 200000) / rng.choice([60.0, 20.0, 8.0, 3.6]) for _ in range(4000)]
    return numbers + [i * 0.05 for i in range(400)] + [-2.5, -1.05, 0.25, 0.75, 1e9 + 0.25]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_half_even_rounding_is_that_of_the_exact_binary_value(spark, digits):
    numbers = _awkward_numbers()
    got = column(spark, numbers, lambda c: N.round_half_even(c, digits), "double")
    assert got == [round(x, digits) if digits else float(round(x)) for x in numbers]


def test_half_up_rounding_is_that_of_the_sql_reports(spark):
    frame = pd.DataFrame({"x": _awkward_numbers()})
    want = duckdb.sql("SELECT round(x, 1) FROM frame").fetchall()
    got = column(spark, list(frame.x), lambda c: N.round_half_up(c, 1), "double")
    assert got == [w[0] for w in want]


def test_exact_sum_does_not_depend_on_order(spark):
    numbers = [1e10, 0.1, -1e10, 0.2, 12345.678901] * 50
    forward = spark.createDataFrame([(x,) for x in numbers], "x double")
    backward = spark.createDataFrame([(x,) for x in reversed(numbers)], "x double").repartition(7)
    expected = 12345.978901 * 50
    for df in (forward, backward):
        assert df.agg(N.exact_sum(F.col("x"))).first()[0] == pytest.approx(expected, abs=1e-9)
    assert forward.agg(N.exact_sum(F.col("x"))).first() == backward.agg(
        N.exact_sum(F.col("x"))).first()
    empty = forward.where("false").agg(N.exact_sum(F.col("x")), N.exact_avg(F.col("x"))).first()
    assert tuple(empty) == (None, None)


def test_integers_are_rounded_not_truncated(spark):
    assert column(spark, [87.52, 88.5, 87.5, None], N.round_to_int, "double") == [88, 88, 88, None]


def test_mean_watts_needs_both_inputs(spark):
    df = spark.createDataFrame(
        [(90.0, 600.0), (0.0, 600.0), (90.0, 0.0), (None, 600.0)], "kj double, s double")
    assert [r[0] for r in df.select(N.mean_watts(F.col("kj"), F.col("s"))).collect()] == [
        150.0, None, None, None]


def test_semicircles(spark):
    assert column(spark, [2 ** 31, -(2 ** 30), None], N.semicircles_to_degrees, "bigint") == [
        180.0, -90.0, None]


def test_activity_ids(spark):
    entries = ["1234567.fit.gz", "1234567.fit", "1234567.tcx.gz", "1234567.tcx", "archive_entry",
               "X.FIT.GZ"]
    assert column(spark, entries, X.activity_id_from_entry) == ["1234567"] * 4 + [
        "archive_entry", "X.FIT.GZ"]


def test_source_classes(spark):
    makers = ["garmin", "Garmin", "peloton", "hevy", "strava", "", "Wahoo", None, "my Peloton"]
    assert column(spark, makers, X.source_from_manufacturer) == [
        "garmin", "garmin", "peloton", "hevy", "unknown", "unknown", "wahoo", "unknown", "peloton"]


def test_suffixes_ignore_case(spark):
    names = ["a.FIT", "a.tcx.GZ", "a.gpx", "a.fit.txt"]
    assert column(spark, names, lambda c: X.has_suffix(c, X.SUPPORTED_SUFFIXES)) == [
        True, True, False, False]


def test_name_patterns(spark):
    names = ["10 min WARM UP", "Warm-up", "warmup ride", "cool_down", None, "swarm of cups"]
    assert column(spark, names, lambda c: X.name_matches(c, X.WARM_UP)) == [
        True, True, True, False, False, False]
    assert column(spark, names, lambda c: X.name_matches(c, X.COOL_DOWN)) == [
        False, False, False, True, False, False]


def test_strict_enum_fails_on_unknown_values(spark):
    mapping = {"a": "A"}
    assert column(spark, ["a", "b", None], lambda c: X.map_enum(c, mapping)) == ["A", None, None]
    with pytest.raises(Exception, match="unrecognized value: b"):
        column(spark, ["a", "b"], lambda c: X.map_enum(c, mapping, strict=True))


def test_intensity_thresholds(spark):
    df = spark.createDataFrame(
        [(128.0, None), (127.9, 149.9), (None, 150.0), (None, None)], "hr double, w double")
    assert [r[0] for r in df.select(X.high_intensity(F.col("hr"), F.col("w"))).collect()] == [
        True, False, True, False]


def test_times(spark):
    at = [utc("2026-06-07 03:30:00"), utc("2026-01-01 23:59:59"), None]
    assert column(spark, at, times.local_hour, "timestamp") == [22, 18, None]
    assert column(spark, at, lambda c: times.week_label(times.week_start(c)), "timestamp") == [
        "Jun 1", "Dec 29", None]
    texts = ["Jul 5, 2026, 6:15:00 AM", "Dec 31, 2025, 12:00:01 PM", "2026-07-05", None]
    got = column(spark, texts, lambda c: times.parse_index_ts(c).cast("string"))
    assert got == ["2026-07-05 06:15:00", "2025-12-31 12:00:01", None, None]
    iso = ["2026-07-05T06:15:00", "2026-07-05T06:15:00Z", "2026-07-05T06:15:00+00:00"]
    got = column(spark, iso, lambda c: times.parse_iso_utc(c).cast("string"))
    assert got == ["2026-07-05 06:15:00"] * 3
    got = column(spark, ["1700000000123456789"], lambda c: times.nanos_to_ts(c).cast("string"))
    assert got == ["2023-11-14 22:13:20.123456"]


@pytest.mark.parametrize(("numbers", "expected"), [
    ([1e-7] * 1000, 1e-4), ([1e19, 1.0], 1e19), ([5e18, 5e18], 1e19), ([9e17] * 30, 2.7e19),
    ([float("inf"), 1.0], float("inf")), ([-1.5, -2.25, None], -3.75), ([123456789012345.675], 123456789012345.675),
])
def test_exact_sum_of_tiny_and_huge_values(spark, numbers, expected):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert df.agg(N.exact_sum(F.col("x"))).first()[0] == pytest.approx(expected, rel=1e-15)


def test_exact_sums_of_any_sign_are_exact(spark):
    rng = random.Random(6)
    numbers = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-6, 14)
               for _ in range(5000)] + [-1.0, -0.5, 0.25, -(2.0 ** 59), 2.0 ** 59, -0.0]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").repartition(7)
    got = df.agg(N.exact_sum(F.col("x"))).first()[0]
    assert got == pytest.approx(math.fsum(numbers), rel=1e-15)
    assert got == df.coalesce(1).agg(N.exact_sum(F.col("x"))).first()[0]


def test_parts_keep_the_sign(spark):
    df = spark.createDataFrame([(-1.0,), (-0.75,), (2.0 ** 41 + 3.5,)], "x double")
    parts = [tuple(r) for r in df.select(*[
        part.alias(name) for name, part in N.exact_parts(F.col("x")).items()]).collect()]
    assert parts == [(0, 0, -1, 0, 0.0), (0, 0, 0, -(3 << 18), 0.0), (2, 0, 3, 1 << 19, 0.0)]


@pytest.mark.parametrize("rows", [2 * 10 ** 10, 8 * 10 ** 12])
@pytest.mark.parametrize("value", [-1e-9 - 1.0, 0.999999999, 123456.789, -(2.0 ** 59)])
def test_sums_of_very_many_rows_do_not_overflow(spark, rows, value):
    """Each row here stands for the sums of ``rows`` rows; a hundred of them are added up."""
    parts = {name: part * F.lit(rows).cast("double" if name == "fine" else "long")
             for name, part in N.exact_parts(F.lit(value)).items()}
    partial = spark.range(100).select(*[part.alias(name) for name, part in parts.items()])
    got = partial.agg(N.exact_total(N.sum_sums(
        {name: F.col(name) for name in N.LIMBS}))).first()[0]
    assert got == pytest.approx(100 * rows * value, rel=1e-15)


def test_partial_sums_near_the_largest_long(spark):
    huge = 2 ** 62 + 12345
    df = spark.range(5).select(*[F.lit(huge).alias(n) for n in N.LIMBS[:-1]],
                               F.lit(0.25).alias("fine"))
    got = df.agg(N.exact_total(N.sum_sums({n: F.col(n) for n in N.LIMBS}))).first()[0]
    exact = 5 * (huge * 2 ** 40 + huge * 2 ** 20 + huge + huge / 2 ** 20) + 1.25
    assert got == pytest.approx(exact, rel=1e-15)


@pytest.mark.parametrize("numbers", [[float("nan"), 1.0], [float("inf"), float("-inf")]])
def test_exact_sum_without_a_value(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert str(df.agg(N.exact_sum(F.col("x"))).first()[0]) == "nan"


def test_malformed_nanoseconds_give_null(spark):
    assert column(spark, ["abc"], lambda c: times.nanos_to_ts(c).cast("string")) == [None]


def test_an_interval_without_an_end_in_sight_makes_few_blocks(spark):
    from stridelake.operators import intervals

    df = spark.sql("SELECT 19000 AS a, 2932896 AS b UNION ALL SELECT -7, 5 UNION ALL SELECT 3, 3")
    for row in df.select("a", "b", intervals._blocks(F.col("a"), F.col("b")).alias("x")).collect():
        assert len(row.x) < 50
        days = sorted((c.nth << c.level, (c.nth + 1) << c.level) for c in row.x)
        assert days[0][0] == row.a and days[-1][1] == row.b + 1
        assert all(p[1] == q[0] for p, q in zip(days, days[1:]))
