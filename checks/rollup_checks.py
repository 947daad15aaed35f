"""Report sections that are plain rollups, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import adapters as A
from checks.sql import (
    ACTS, E, LONG_ACTS, READINGS, STRENGTH, TRACKS, half_even, mean, total, with_)
from stridelake import schemas, session
from stridelake.functions import numeric as N
from stridelake.operators import intervals, lookup, normalize, rollups, states
from stridelake.plans import reports
from stridelake.streaming import ingest

START = "2024-01-08"
LONG_START = "1999-06-01"


def _stats_sql(ctes: str) -> str:
    return with_(ctes, f"""t AS (
  SELECT count(*) FILTER (WHERE src <> 'peloton') AS outdoor_rides,
         count(*) FILTER (WHERE src = 'peloton') AS class_rides,
         round({total('distance_m')} / 1000.0::DOUBLE, 0) AS total_km,
         round({total('elapsed_s')} / 3600.0::DOUBLE, 0) AS total_hours,
         round({total('coalesce(elevation_m, 0)')}, 0) AS total_elevation_m,
         round({total('coalesce(calories, 0)')}, 0) AS total_calories,
         CAST(min(start_time) AS DATE) AS earliest, CAST(max(start_time) AS DATE) AS latest
  FROM acts)""") + f"""
SELECT outdoor_rides + class_rides AS total_rides, outdoor_rides, class_rides, total_km,
       {half_even('total_km * 0.621371::DOUBLE', 0)} AS total_mi, total_hours,
       {half_even('total_hours / 24.0::DOUBLE', 1)} AS total_days, total_elevation_m,
       total_calories, earliest, latest
FROM t"""


_WEEKLY_SQL = with_(ACTS, STRENGTH, f"""o AS (
  SELECT CAST(date_trunc('week', start_time) AS DATE) AS week, count(*) AS n,
         round({total('elapsed_s')} / 60.0::DOUBLE, 1) AS mins,
         round({total('distance_m')} / 1000.0::DOUBLE, 1) AS km, round({mean('hr')}, 1) AS hr,
         round({mean('cadence')}, 1) AS cadence,
         round({mean('speed_mps')} * 3.6::DOUBLE, 1) AS speed
  FROM acts WHERE src <> 'peloton' AND start_time >= DATE '{START}' GROUP BY 1)""", f"""p AS (
  SELECT CAST(date_trunc('week', start_time) AS DATE) AS week, count(*) AS n,
         round({total('elapsed_s')} / 60.0::DOUBLE, 1) AS mins, round({mean('hr')}, 1) AS hr,
         round({total('kj')}, 1) AS kj
  FROM acts WHERE src = 'peloton' AND start_time >= DATE '{START}' GROUP BY 1)""", f"""s AS (
  SELECT CAST(date_trunc('week', start_ts) AS DATE) AS week, count(*) AS n,
         {half_even(total('coalesce(minutes, 0)'), 1)} AS mins
  FROM strength WHERE day >= DATE '{START}' GROUP BY 1)""", f"""spine AS (
  SELECT CAST(unnest(generate_series(DATE '{START}', max(start_time), INTERVAL 7 DAY)) AS DATE)
         AS week FROM acts)""")

def _in_batches(s, d) -> states.Daily:
    """The daily table of all activities, kept over four batches: some activities first come with
    another time and source, are then replaced, and the table is compacted in between."""
    path = session.fresh_path(s, "kept")
    store = ingest.Store("", f"{path}/acts", f"{path}/tracks", f"{path}/ledger",
                         daily=f"{path}/daily")
    acts = A.activities(s, d)
    key = F.col("id").cast("long")
    wrong = acts.where(key % 5 == 0).withColumns({
        "start_time": F.col("start_time") - F.expr("INTERVAL 40 DAYS"),
        "original_source": F.lit("hevy"), "elapsed_time_s": F.lit(1e7)})
    for n, batch in enumerate((wrong, acts.where(key % 2 == 1), acts.where(key % 10 == 0),
                               acts.where((key % 2 == 0) & (key % 10 != 0)))):
        made = normalize.conform(batch.withColumns({
            "entry": F.col("id"), "modified": F.timestamp_seconds(F.lit(n))}),
            schemas.STORED_ACTIVITY)
        ingest.store_result(ingest.IngestResult(
            made, s.createDataFrame([], schemas.STORED_POINT),
            s.createDataFrame([], schemas.OUTCOME)), store, f"batch {n}")
        if n == 1:
            store.daily_table.compact(s)
    return store.daily_table.read(s)


def _dashboard(section):
    """A section of the overview bundle, from one reading of the long activities."""
    return lambda s, d: reports.dashboard(
        A.long_activities(s, d), A.tracks(s, d), A.strength(s, d), LONG_START)[section]


def _report(section):
    """A section of the training bundle, from one reading of the activities."""
    return lambda s, d: reports.training_report(
        A.activities(s, d), A.strength(s, d), START)[section]


def _extreme_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of tiny, huge, infinite and undefined values, one kind per line number."""
    kind, odd = F.col("l_linenumber"), F.col("l_orderkey")
    value = (
        F.when(kind == 1, F.col("l_quantity") * F.lit(1e-7))
        .when(kind == 2, F.col("l_quantity") * F.lit(1e18))
        .when((kind == 3) & (odd % 97 == 0), F.lit(float("inf")))
        .when((kind == 4) & (odd % 89 == 0), F.lit(float("nan")))
        .otherwise(F.col("l_tax")))
    total = F.col("total")
    finite = ~F.isnan(total) & (F.abs(total) < F.lit(float("inf")))
    scaled = F.when(kind == 2, total / F.lit(1e18)).otherwise(total)
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(kind.cast("long").alias("kind"))
        .agg(N.exact_sum(value).alias("total"), F.max(kind).alias("l_linenumber"))
        .select("kind", F.when(finite, F.round(scaled, 8)).alias("total"),
                F.isnan(total).alias("undefined")))


_EXTREME_SUMS = """
SELECT kind, CASE WHEN isfinite(total)
         THEN round(CASE WHEN kind = 2 THEN total / 1e18::DOUBLE ELSE total END, 8) END AS total,
       isnan(total) AS undefined
FROM (SELECT CAST(l_linenumber AS BIGINT) AS kind, sum(
        CASE WHEN l_linenumber = 1 THEN l_quantity * 1e-7::DOUBLE
             WHEN l_linenumber = 2 THEN l_quantity * 1e18::DOUBLE
             WHEN l_linenumber = 3 AND l_orderkey % 97 = 0 THEN 'inf'::DOUBLE
             WHEN l_linenumber = 4 AND l_orderkey % 89 = 0 THEN 'nan'::DOUBLE
             ELSE l_tax END) AS total
      FROM lineitem GROUP BY l_linenumber)"""

CHECKS = {
    "small_and_extreme_sums": (_extreme_sums, _EXTREME_SUMS),
    "header_stats": (
        lambda s, d: rollups.header_stats(A.activities(s, d)), _stats_sql(ACTS)),
    "header_stats_long_span": (
        lambda s, d: rollups.header_stats(A.long_activities(s, d)), _stats_sql(LONG_ACTS)),
    "rides_by_year": (
        lambda s, d: rollups.by_year(A.long_activities(s, d)),
        with_(LONG_ACTS) + f"""
SELECT CAST(year(start_time) AS INTEGER) AS yr, count(*) AS n,
       round({total('distance_m')} / 1000.0::DOUBLE, 1) AS total_km,
       round(max(distance_m) / 1000.0::DOUBLE, 1) AS longest_km,
       round({mean('hr')}, 1) AS avg_hr
FROM acts WHERE src <> 'peloton' GROUP BY 1 ORDER BY 1"""),
    "moving_averages_by_year": (
        lambda s, d: rollups.moving_averages_by_year(A.tracks(s, d), A.long_activities(s, d)),
        with_(LONG_ACTS, TRACKS) + f"""
SELECT CAST(year(t.ts) AS INTEGER) AS yr,
       round({total('t.cadence', 't.cadence > 0')}
             / count(*) FILTER (WHERE t.cadence > 0), 1) AS avg_cadence,
       round({total('t.speed_mps', 't.speed_mps > 0')}
             / count(*) FILTER (WHERE t.speed_mps > 0) * 3.6::DOUBLE, 1) AS avg_speed_kmh
FROM tracks t JOIN acts a ON a.id = t.activity_id
WHERE a.src <> 'peloton' GROUP BY 1 ORDER BY 1"""),
    "rides_by_local_hour": (
        lambda s, d: rollups.by_local_hour(A.activities(s, d)),
        with_(ACTS) + """
SELECT CAST(h.h AS INTEGER) AS local_hour, count(a.id) AS n
FROM generate_series(0, 23) AS h(h)
LEFT JOIN acts a ON (hour(a.start_time) + 24 - 5) % 24 = h.h AND a.src <> 'peloton'
GROUP BY 1 ORDER BY 1"""),
    "class_rides_by_year": (
        lambda s, d: rollups.class_by_year(A.long_activities(s, d)),
        with_(LONG_ACTS) + """
SELECT CAST(y.yr AS INTEGER) AS yr, count(a.id) AS n
FROM (SELECT unnest(generate_series(
               coalesce(min(year(start_time)) FILTER (WHERE src = 'peloton'),
                        max(year(start_time))),
               max(year(start_time)))) AS yr FROM acts) y
LEFT JOIN acts a ON year(a.start_time) = y.yr AND a.src = 'peloton'
GROUP BY 1 ORDER BY 1"""),
    "rides_in_trailing_months": (
        lambda s, d: rollups.trailing_months(A.long_activities(s, d)),
        with_(LONG_ACTS, """c AS (
  SELECT strftime(start_time, '%Y-%m') AS ym, count(*) AS n FROM acts
  WHERE src <> 'peloton'
    AND start_time >= (SELECT max(start_time) FROM acts) - INTERVAL 24 MONTH
  GROUP BY 1)""", """spine AS (
  SELECT strftime(unnest(generate_series(
           date_trunc('month', max(start_time)) - INTERVAL 23 MONTH, max(start_time),
           INTERVAL 1 MONTH)), '%Y-%m') AS ym FROM acts)""") + """
SELECT spine.ym, coalesce(c.n, 0) AS n FROM spine LEFT JOIN c USING (ym) ORDER BY 1"""),
    "recovery_weeks": (
        lambda s, d: rollups.recovery_weeks(A.activities(s, d), A.strength(s, d), START),
        with_(ACTS, STRENGTH, f"""spine AS (
  SELECT CAST(unnest(generate_series(DATE '{START}', max(start_time), INTERVAL 7 DAY)) AS DATE)
         AS week FROM acts)""") + f"""
SELECT week, strftime(week, '%m-%d') AS label,
       (SELECT count(*) FROM acts WHERE src = 'peloton' AND start_time >= DATE '{START}'
          AND CAST(date_trunc('week', start_time) AS DATE) = week) AS class_n,
       (SELECT count(*) FROM strength WHERE day >= DATE '{START}'
          AND CAST(date_trunc('week', start_ts) AS DATE) = week) AS strength_n
FROM spine ORDER BY week"""),
    "weekly_volume": (
        lambda s, d: rollups.weekly_volume(A.activities(s, d), A.strength(s, d), START),
        _WEEKLY_SQL + """
SELECT w.week, strftime(w.week, '%b %-d') AS label,
       coalesce(o.n, 0) AS outdoor_n,
       CASE WHEN o.n IS NULL THEN 0 ELSE o.mins END AS outdoor_min,
       CASE WHEN o.n IS NULL THEN 0 ELSE o.km END AS outdoor_km,
       o.hr AS outdoor_hr, o.cadence AS outdoor_cadence, o.speed AS outdoor_speed,
       coalesce(p.n, 0) AS class_n, CASE WHEN p.n IS NULL THEN 0 ELSE p.mins END AS class_min,
       p.hr AS class_hr, CASE WHEN p.n IS NULL THEN 0 ELSE p.kj END AS class_kj,
       coalesce(s.n, 0) AS strength_n, coalesce(s.mins, 0) AS strength_min
FROM spine w LEFT JOIN o USING (week) LEFT JOIN p USING (week) LEFT JOIN s USING (week)
ORDER BY week"""),
    "rides_by_month_and_kind": (
        lambda s, d: rollups.monthly_by_class(A.long_activities(s, d), LONG_START),
        with_(LONG_ACTS) + """
SELECT strftime(start_time, '%Y-%m') AS month,
       count(*) FILTER (WHERE src IS DISTINCT FROM 'peloton') AS outdoor,
       count(*) FILTER (WHERE src = 'peloton') AS class
FROM acts WHERE start_time >= DATE '1999-01-01' GROUP BY 1 ORDER BY 1"""),
    "window_headline": (
        lambda s, d: rollups.window_headline(A.activities(s, d), A.strength(s, d), START),
        with_(ACTS, STRENGTH) + f"""
SELECT a.*, s.* FROM (
  SELECT count(*) FILTER (WHERE src <> 'peloton') AS outdoor_n,
         round({total('elapsed_s', "src <> 'peloton'")} / 60.0::DOUBLE, 0) AS outdoor_min,
         round({total('distance_m', "src <> 'peloton'")} / 1000.0::DOUBLE, 0) AS outdoor_km,
         count(*) FILTER (WHERE src = 'peloton') AS class_n,
         round({total('elapsed_s', "src = 'peloton'")} / 60.0::DOUBLE, 0) AS class_min
  FROM acts WHERE start_time >= DATE '{START}') a, (
  SELECT count(*) AS strength_n,
         {half_even(total('coalesce(minutes, 0)'), 1)} AS strength_min
  FROM strength WHERE day >= DATE '{START}') s"""),
    "heart_rate_by_elevation_band": (
        lambda s, d: rollups.band_average(
            A.tracks(s, d), "altitude_m", 500.0, "heart_rate", "avg_hr"),
        with_(TRACKS) + f"""
SELECT floor(altitude_m / 500.0::DOUBLE) * 500.0::DOUBLE AS band, count(heart_rate) AS n,
       round({mean('heart_rate')}, 1) AS avg_hr
FROM tracks GROUP BY 1 ORDER BY 1"""),
    "gps_flags": (
        lambda s, d: rollups.gps_flags(A.tracks(s, d)),
        with_(TRACKS) + """
SELECT activity_id, bool_or(lat IS NOT NULL) AS gps_track_available
FROM tracks GROUP BY 1"""),
    "weekly_volume_with_mean_weight": (
        lambda s, d: intervals.bucket_average(A.activities(s, d), A.readings(s, d)),
        with_(ACTS, READINGS) + f"""
SELECT w.week, w.activities, (
         SELECT {mean('lb')} FROM readings r
         WHERE r.recorded_at BETWEEN w.week AND w.week + INTERVAL 7 DAY) AS avg_weight_lb
FROM (SELECT CAST(date_trunc('week', start_time) AS DATE) AS week, count(*) AS activities
      FROM acts GROUP BY 1) w"""),
    "weekly_mean_weight_by_athlete": (
        lambda s, d: intervals.bucket_average(
            A.activities(s, d), A.readings(s, d), ["athlete_id"], days=10),
        with_(ACTS, READINGS) + f"""
SELECT w.athlete_id, w.week, w.activities, m.avg_weight_lb
FROM (SELECT athlete_id, CAST(date_trunc('week', start_time) AS DATE) AS week,
             count(*) AS activities FROM acts GROUP BY 1, 2) w
LEFT JOIN (
  SELECT v.athlete_id, v.week, {mean('r.lb')} AS avg_weight_lb
  FROM (SELECT DISTINCT athlete_id, CAST(date_trunc('week', start_time) AS DATE) AS week
        FROM acts) v
  JOIN readings r ON r.athlete_id = v.athlete_id
   AND r.recorded_at BETWEEN v.week AND v.week + INTERVAL 10 DAY
  GROUP BY 1, 2) m ON m.athlete_id = w.athlete_id AND m.week = w.week"""),
    "id_reconciliation": (
        lambda s, d: lookup.reconcile_ids(
            A.activities(s, d).select("id"), A.long_activities(s, d).select("id"), "id"),
        """
SELECT count(*) AS checked, count(*) FILTER (WHERE hit) AS matched,
       count(*) FILTER (WHERE NOT hit) AS unmatched,
       CASE WHEN count(*) FILTER (WHERE hit) >= 3 THEN 'IDs match' ELSE 'IDs do not match' END
         AS verdict
FROM (SELECT event_id IN (SELECT o_orderkey FROM orders) AS hit FROM events)"""),
    "id_sides": (
        lambda s, d: lookup.match_ids(
            A.tracks(s, d).selectExpr("cast(activity_id as bigint) * 3 as id"),
            A.long_activities(s, d).selectExpr("cast(id as bigint) as id"), "id"),
        """
SELECT coalesce(l.id, r.id) AS id,
       CASE WHEN r.id IS NULL THEN 'left' WHEN l.id IS NULL THEN 'right' ELSE 'both' END AS side
FROM (SELECT DISTINCT l_orderkey * 3 AS id FROM lineitem) l
FULL JOIN (SELECT o_orderkey AS id FROM orders) r ON l.id = r.id"""),
}

# The same sections out of the two report bundles and out of a daily table that was kept by batches.
CHECKS |= {
    "dashboard_stats": (_dashboard("stats"), CHECKS["header_stats_long_span"][1]),
    "dashboard_by_year": (_dashboard("by_year"), CHECKS["rides_by_year"][1]),
    "dashboard_cadence_speed": (
        _dashboard("cadence_speed_by_year"), CHECKS["moving_averages_by_year"][1]),
    "dashboard_class_by_year": (_dashboard("class_by_year"), CHECKS["class_rides_by_year"][1]),
    "dashboard_trailing_months": (
        _dashboard("monthly_last_24"), CHECKS["rides_in_trailing_months"][1]),
    "report_weekly": (_report("weekly"), CHECKS["weekly_volume"][1]),
    "report_headline": (_report("headline"), CHECKS["window_headline"][1]),
    "kept_stats": (
        lambda s, d: rollups.header_stats(_in_batches(s, d)), CHECKS["header_stats"][1]),
    "kept_weekly_volume": (
        lambda s, d: rollups.weekly_volume(_in_batches(s, d), A.strength(s, d), START),
        CHECKS["weekly_volume"][1]),
    "kept_rides_by_local_hour": (
        lambda s, d: rollups.by_local_hour(_in_batches(s, d)),
        CHECKS["rides_by_local_hour"][1]),
    "rides_by_athlete_and_year": (
        lambda s, d: rollups.by_year(A.long_activities(s, d), ["athlete_id"]),
        with_(LONG_ACTS) + f"""
SELECT athlete_id, CAST(year(start_time) AS INTEGER) AS yr, count(*) AS n,
       round({total('distance_m')} / 1000.0::DOUBLE, 1) AS total_km,
       round(max(distance_m) / 1000.0::DOUBLE, 1) AS longest_km,
       round({mean('hr')}, 1) AS avg_hr
FROM acts WHERE src <> 'peloton' GROUP BY 1, 2"""),
    "rides_by_athlete_month_and_kind": (
        lambda s, d: rollups.monthly_by_class(
            A.long_activities(s, d), LONG_START, ["athlete_id"]),
        with_(LONG_ACTS) + """
SELECT athlete_id, strftime(start_time, '%Y-%m') AS month,
       count(*) FILTER (WHERE src IS DISTINCT FROM 'peloton') AS outdoor,
       count(*) FILTER (WHERE src = 'peloton') AS class
FROM acts WHERE start_time >= DATE '1999-01-01' GROUP BY 1, 2"""),
}
