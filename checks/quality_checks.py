"""Validation reports and column expressions, with their SQL."""

from __future__ import annotations

from checks import adapters as A
from checks.sql import ACTS, E, LIFE_EVENTS, READINGS, ascii_only, half_even, with_
from pyspark.sql import functions as F
from stridelake import session
from stridelake.functions import numeric as N, text as X, times
from stridelake.operators import normalize, quality, rules
from stridelake.sources import files

_WEIGHT = READINGS + """,
shape AS (
  SELECT entry, id AS label, 'original_source is required' AS message FROM readings
  WHERE original_source IS NULL
  UNION ALL
  SELECT entry, id, 'weight_kg is required' FROM readings WHERE kg IS NULL),
good AS (SELECT * FROM readings WHERE entry NOT IN (SELECT entry FROM shape)),
issues AS (
  SELECT entry, label, message FROM shape
  UNION ALL
  SELECT entry, id, 'weight_kg is outside 30 to 250' FROM good WHERE kg NOT BETWEEN 30 AND 250
  UNION ALL
  SELECT entry, id, 'weight_lb does not match weight_kg' FROM good
  WHERE abs(lb - CAST(printf('%.1f', kg * 2.2046226218::DOUBLE) AS DOUBLE)) > 0.2::DOUBLE
  UNION ALL
  SELECT entry, id, 'id is taken already by entry #' || CAST(first_entry AS VARCHAR)
  FROM (SELECT *, min(entry) OVER (PARTITION BY id) AS first_entry FROM good)
  WHERE entry > first_entry)"""

_LIFE = LIFE_EVENTS + """,
named AS (
  SELECT *, coalesce(id, 'entry #' || CAST(entry AS VARCHAR)) AS label FROM life),
shape AS (
  SELECT entry, label, 'id is required' AS message FROM named WHERE id IS NULL
  UNION ALL
  SELECT entry, label, 'description is required' FROM named WHERE no_description
  UNION ALL
  SELECT entry, label, 'category is unknown' FROM named WHERE bad_category),
good AS (SELECT * FROM life WHERE entry NOT IN (SELECT entry FROM shape)),
refs AS (
  SELECT entry, id, CAST(unnest([block - 5, block + 5]) AS VARCHAR) AS ref FROM life
  WHERE id IS NOT NULL),
dangling AS (SELECT * FROM refs WHERE ref NOT IN (SELECT id FROM good)),
issues AS (
  SELECT entry, label, message FROM shape
  UNION ALL
  SELECT entry, id, 'date_end is before date' FROM good WHERE day_end < day
  UNION ALL
  SELECT entry, id, 'id is taken already by entry #' || CAST(first_entry AS VARCHAR)
  FROM (SELECT *, min(entry) OVER (PARTITION BY id) AS first_entry FROM good)
  WHERE entry > first_entry
  UNION ALL
  SELECT entry, id, 'references unknown id ' || ref FROM dangling)"""

_REPORT = r"""
SELECT trim(regexp_replace(message, '(entry #|unknown id ).*', '\1')) AS kind, count(*) AS n
FROM issues GROUP BY 1"""


def _life_refs(s, d):
    events = A.life_events(s, d).where(F.col("id").isNotNull())
    known = events.select(F.col("id").alias("ref"))
    return quality.dangling_refs(events, "related_event_ids", known, ["entry", "id"])


def _times(s, d):
    ts, k = F.col("ts"), F.col("k")
    text = F.date_format(ts, times.INDEX_TIMESTAMP)
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return A.events(s, d).select(
        "event_id",
        times.local_hour(ts).alias("local_hour"),
        times.month_key(ts).alias("month"),
        times.week_start(ts).alias("week"),
        times.week_label(times.week_start(ts)).alias("week_label"),
        times.week_day_key(times.week_start(ts)).alias("week_key"),
        times.parse_index_ts(F.when(k % 2 == 0, text).otherwise("no date")).alias("parsed"),
        times.parse_iso_utc(F.when(k % 2 == 0, iso).otherwise(F.concat(iso, F.lit("Z"))))
        .alias("iso"),
        times.nanos_to_ts((F.unix_micros(ts) * 1000 + k).cast("string")).alias("from_nanos"),
        times.end_time(ts, F.col("value")).alias("end_time"),
        (ts - F.expr("INTERVAL 24 MONTHS")).alias("two_years_before"),
    )


def _texts(s, d):
    name, k = A.ride_name(), F.col("k")
    suffix = A._case(k % 6, {0: ".fit.gz", 1: ".FIT.GZ", 2: ".tcx.gz", 3: ".tcx", 4: ".gpx"}, "")
    entry = F.concat(F.col("event_id").cast("string"), suffix)
    maker = A._case(k % 8, {0: "GARMIN Ltd", 1: "my peloton", 2: "Hevy", 3: "strava", 4: "",
                            5: "Strava App"}, "Wahoo")
    return A.events(s, d).select(
        "event_id",
        X.ascii_only(name).alias("ascii_name"),
        X.name_matches(name, X.WARM_UP).alias("is_warm_up"),
        X.name_matches(name, X.COOL_DOWN).alias("is_cool_down"),
        X.name_matches(name, X.TRAINER_LED).alias("is_trainer_led"),
        X.basename(F.concat(F.lit("a/b/"), entry)).alias("file_name"),
        X.activity_id_from_entry(entry).alias("activity_id"),
        X.has_suffix(entry, X.SUPPORTED_SUFFIXES).alias("supported"),
        X.source_from_manufacturer(F.when(k % 9 != 0, maker)).alias("source_class"),
        X.device_name(
            F.when(k % 3 == 0, F.lit("0")).when(k % 3 == 1, F.lit("edge")),
            F.when(k % 5 != 0, F.lit("p1"))).alias("device"),
        X.non_blank(F.when(k % 4 == 0, F.lit("  ")).when(k % 4 == 1, F.lit("x")))
        .alias("has_text"),
        X.assumed_minutes(k % 2 == 0, F.col("value")).alias("minutes"),
        X.high_intensity(
            F.when(k % 3 != 0, F.lit(60.0) + k), F.when(k % 4 != 0, F.col("value")))
        .alias("intense"),
    )


def _numbers(s, d):
    v, k = F.col("value"), F.col("k")
    return A.events(s, d).select(
        "event_id",
        N.round_half_up(v / F.lit(60.0), 1).alias("sql_round"),
        N.round_half_even(v / F.lit(20.0), 1).alias("even_1"),
        N.round_half_even(v / F.lit(8.0), 2).alias("even_2"),
        N.round_half_even(k / F.lit(2.0)).alias("even_0"),
        N.round_to_int(v).alias("as_int"),
        N.m_to_km(v).alias("km"),
        N.mps_to_kmh(v).alias("kmh"),
        N.s_to_min(v).alias("mins"),
        N.j_to_kj(v).alias("kj"),
        N.kg_to_lb(v).alias("lb"),
        N.km_to_mi(v).alias("mi"),
        N.semicircles_to_degrees(F.col("event_id") * 1000).alias("degrees"),
        N.mean_watts(F.when(k % 5 != 0, v).otherwise(0.0), k.cast("double")).alias("watts"),
        N.zero_to_null(k.cast("double")).alias("heart_rate"),
        N.first_non_null(F.when(k % 2 == 0, v), F.when(k % 3 == 0, k.cast("double")))
        .alias("preferred"),
    )


def _record_outcomes(s, d):
    checked = rules.check(A.activity_texts(s, d), normalize.activity_spec())
    return checked.select("event_id", F.array_join("violations", "; ").alias("violations"))


def _checked_records(s, d):
    """The good records, written as text files and read back through the rules."""
    path = session.fresh_path(s, "texts")
    A.activity_texts(s, d).select(F.col("text").alias("value")).write.text(path)
    good, _ = rules.read_checked(
        files.read_texts(s, path, multi_line=False).drop("file"), normalize.activity_spec())
    return good.select(
        "id", "original_source", "name", "start_time", "elapsed_time_s", "calories",
        F.col("endurance_metrics.distance_m").alias("distance_m"),
        F.col("class_metrics.class_type").alias("class_type"))


CHECKS = {
    "record_outcomes": (
        _record_outcomes,
        with_(E) + """
SELECT event_id, CASE k % 12 WHEN 0 THEN 'calories is not a number'
  WHEN 1 THEN 'record is no JSON object' WHEN 2 THEN 'record has unknown fields'
  WHEN 3 THEN 'elapsed_time_s is out of range'
  WHEN 4 THEN 'more than one of endurance_metrics, strength_metrics, class_metrics'
  WHEN 5 THEN 'id is required' WHEN 6 THEN 'record is no JSON object'
  WHEN 7 THEN 'start_time is not a time' ELSE '' END AS violations
FROM e"""),
    "checked_records": (
        _checked_records,
        with_(ACTS) + """
SELECT id, src AS original_source, name, date_trunc('second', start_time) AS start_time,
       elapsed_s AS elapsed_time_s, calories,
       CASE WHEN k % 12 = 8 THEN 5.5::DOUBLE END AS distance_m,
       CASE WHEN k % 12 = 9 THEN 'spin' END AS class_type
FROM acts WHERE k % 12 > 7"""),
    "weight_issues": (
        lambda s, d: quality.validate_weight(A.readings(s, d)),
        with_(E, _WEIGHT) + "SELECT entry, label, message FROM issues"),
    "weight_issue_report": (
        lambda s, d: quality.violations_report(quality.validate_weight(A.readings(s, d))),
        with_(E, _WEIGHT) + _REPORT),
    "life_event_issues": (
        lambda s, d: quality.validate_life_events(A.life_events(s, d)),
        with_(E, _LIFE) + "SELECT entry, label, message FROM issues"),
    "life_event_issue_report": (
        lambda s, d: quality.violations_report(quality.validate_life_events(A.life_events(s, d))),
        with_(E, _LIFE) + _REPORT),
    "repeated_reading_ids": (
        lambda s, d: quality.duplicate_ids(A.readings(s, d), "id", "entry").select(
            "id", "entry", "first_position"),
        with_(E, READINGS) + """
SELECT id, entry, first_position FROM (
  SELECT id, entry, min(entry) OVER (PARTITION BY id) AS first_position FROM readings)
WHERE entry > first_position"""),
    "dangling_event_references": (
        _life_refs,
        with_(E, LIFE_EVENTS) + """
SELECT entry, id, ref FROM (
  SELECT entry, id, CAST(unnest([block - 5, block + 5]) AS VARCHAR) AS ref FROM life
  WHERE id IS NOT NULL)
WHERE ref NOT IN (SELECT id FROM life WHERE id IS NOT NULL)"""),
    "time_expressions": (
        _times,
        with_(E) + """
SELECT event_id, CAST((hour(ts) + 24 - 5) % 24 AS INTEGER) AS local_hour,
       strftime(ts, '%Y-%m') AS month, CAST(date_trunc('week', ts) AS DATE) AS week,
       strftime(date_trunc('week', ts), '%b %-d') AS week_label,
       strftime(date_trunc('week', ts), '%m-%d') AS week_key,
       CASE WHEN k % 2 = 0 THEN date_trunc('second', ts) END AS parsed,
       date_trunc('second', ts) AS iso, ts AS from_nanos,
       make_timestamp(epoch_us(ts) + CAST(round_even(value * 1e6, 0) AS BIGINT)) AS end_time,
       ts - INTERVAL 24 MONTH AS two_years_before
FROM e"""),
    "text_expressions": (
        _texts,
        with_(E, """t AS (
  SELECT *, CASE k % 7 WHEN 0 THEN 'Warm-Up Ride' WHEN 1 THEN 'Cool Down Ride'
              WHEN 2 THEN 'Trainer Session 4' WHEN 3 THEN 'Café Ride '
              ELSE 'Ride ' || CAST(k AS VARCHAR) END AS name,
         CAST(event_id AS VARCHAR) || CASE k % 6 WHEN 0 THEN '.fit.gz' WHEN 1 THEN '.FIT.GZ'
           WHEN 2 THEN '.tcx.gz' WHEN 3 THEN '.tcx' WHEN 4 THEN '.gpx' ELSE '' END AS entry
  FROM e)""") + f"""
SELECT event_id, {ascii_only('name')} AS ascii_name,
       regexp_matches(name, '(?i)warm.?up') AS is_warm_up,
       regexp_matches(name, '(?i)cool.?down') AS is_cool_down,
       name LIKE '%Trainer Session%' AS is_trainer_led, entry AS file_name,
       CASE WHEN k % 6 IN (1, 4) THEN entry ELSE CAST(event_id AS VARCHAR) END AS activity_id,
       k % 6 IN (0, 1, 2, 3) AS supported,
       CASE WHEN k % 9 = 0 THEN 'unknown' ELSE CASE k % 8 WHEN 0 THEN 'garmin'
         WHEN 1 THEN 'peloton' WHEN 2 THEN 'hevy' WHEN 3 THEN 'unknown' WHEN 4 THEN 'unknown'
         WHEN 5 THEN 'strava app' ELSE 'wahoo' END END AS source_class,
       CASE WHEN k % 3 = 1 THEN 'edge' WHEN k % 5 <> 0 THEN 'p1' END AS device,
       k % 4 = 1 AS has_text,
       CASE WHEN k % 2 = 0 THEN 60.0::DOUBLE ELSE value END AS minutes,
       (k % 3 <> 0 AND 60 + k >= 128) OR (k % 4 <> 0 AND value >= 150) AS intense
FROM t"""),
    "numeric_expressions": (
        _numbers,
        with_(E) + f"""
SELECT event_id, round(value / 60.0::DOUBLE, 1) AS sql_round,
       {half_even('value / 20.0::DOUBLE', 1)} AS even_1,
       {half_even('value / 8.0::DOUBLE', 2)} AS even_2,
       round_even(k / 2.0::DOUBLE, 0) AS even_0, CAST(round_even(value, 0) AS INTEGER) AS as_int,
       value / 1000.0::DOUBLE AS km, value * 3.6::DOUBLE AS kmh, value / 60.0::DOUBLE AS mins,
       value / 1000.0::DOUBLE AS kj, value * 2.2046226218::DOUBLE AS lb,
       value * 0.621371::DOUBLE AS mi,
       event_id * 1000 * (180.0::DOUBLE / 2147483648.0::DOUBLE) AS degrees,
       CASE WHEN k % 5 <> 0 AND value <> 0 AND k <> 0
            THEN value * 1000.0::DOUBLE / CAST(k AS DOUBLE) END AS watts,
       CAST(nullif(k, 0) AS DOUBLE) AS heart_rate,
       CASE WHEN k % 2 = 0 THEN value WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) END AS preferred
FROM e"""),
}
