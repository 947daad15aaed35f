"""Bundles, as-of matches and interval joins, with their SQL.

The supplied events are spread thinly over a month, so the gap and the tolerance are hours here.
"""

from __future__ import annotations

from checks import adapters as A
from checks.sql import ACTS, LIFE_EVENTS, STRENGTH, ascii_only, half_even, mean, total, with_
from pyspark.sql import functions as F
from stridelake import schemas, session
from stridelake.functions import text as X
from stridelake.operators import sessions
from stridelake.plans import reports
from stridelake.streaming import bundles

START = "2024-01-08"
GAP_S = 6 * 3600
TOLERANCE_S = 12 * 3600


def _rides(s, d):
    return A.activities(s, d).where(X.is_class(F.col("original_source")))


def _bundles(s, d):
    return reports.class_bundles(A.activities(s, d), START, GAP_S)


def _streamed_bundles(s, d):
    """The same rides as a stream: each arrives up to two days after it started, in three runs that
    go on from the checkpoint; a row without an id at the end lets the last ones go."""
    path = session.fresh_path(s, "bundles")
    source, out, progress = (f"{path}/{n}" for n in ("in", "out", "progress"))
    late = F.pmod(F.xxhash64("id"), F.lit(172_800))
    arrival = F.to_date(F.timestamp_seconds(F.unix_seconds("start_time") + late))
    run = F.floor(F.datediff(arrival, F.lit("2024-01-01")) / 11)
    rides = _rides(s, d).withColumn("run", F.least(F.lit(2), F.greatest(F.lit(0), run)))
    end = s.range(1).select(F.lit("2199-01-01").cast("timestamp").alias("start_time"))
    for n in range(3):
        rows = rides.where(F.col("run") == n).drop("run")
        rows = rows.unionByName(end, allowMissingColumns=True) if n == 2 else rows
        rows.write.mode("append").parquet(source)
        bundles.bundles_available_now(
            s.readStream.schema(schemas.ACTIVITY).parquet(source), out, progress, "3 days", GAP_S)
    return bundles.read_placed(s, out)


def _matches(s, d, rides=None):
    strength = A.strength(s, d).where(F.col("date") >= START)
    return reports.match_strength(rides or _bundles(s, d), strength, TOLERANCE_S)


def _sessions(s, d, orphans: bool):
    rides = _bundles(s, d)
    return reports.class_sessions(rides, _matches(s, d, rides))[int(orphans)]


def _rows(condition: str, gap_s: int = GAP_S) -> str:
    return f"""r AS (
  SELECT athlete_id, id, start_time AS start, {ascii_only('name')} AS name, elapsed_s, hr, max_hr,
         calories, kj,
         make_timestamp(epoch_us(start_time) + CAST(round(elapsed_s * 1e6) AS BIGINT)) AS end_ts
  FROM acts WHERE {condition})""" + f""",
o AS (
  SELECT *, lag(end_ts) OVER (PARTITION BY athlete_id ORDER BY start, id) AS prev_end FROM r),
f AS (
  SELECT *, sum(CASE WHEN prev_end IS NULL
                       OR epoch_us(start) - epoch_us(prev_end) > {gap_s * 1000000} THEN 1
                     ELSE 0 END)
            OVER (PARTITION BY athlete_id ORDER BY start, id ROWS UNBOUNDED PRECEDING) AS bundle
  FROM o),
m AS (
  SELECT *, min(start) OVER b AS bundle_start, count(*) OVER b AS n_rows,
         row_number() OVER (PARTITION BY athlete_id, bundle
                            ORDER BY elapsed_s DESC, start, id) AS rank
  FROM f WINDOW b AS (PARTITION BY athlete_id, bundle)),
z AS (
  SELECT *, first_value(start) OVER (PARTITION BY athlete_id, bundle ORDER BY rank) AS main_start,
         first_value(name) OVER (PARTITION BY athlete_id, bundle ORDER BY rank) AS main_name
  FROM m),
role AS (
  SELECT *, CASE WHEN rank = 1 THEN 'main' WHEN start < main_start THEN 'warmup'
                 WHEN start > main_start THEN 'cooldown' ELSE 'same_start' END AS role,
         n_rows = 1 AND regexp_matches(main_name, '(?i)warm.?up|cool.?down') AS is_orphan
  FROM z)"""


_ALL = with_(ACTS, _rows("src = 'peloton'"))
_RECENT = with_(ACTS, STRENGTH, _rows(f"src = 'peloton' AND start_time >= DATE '{START}'"), f"""
bundles AS (
  SELECT athlete_id, bundle_start, max(end_ts) AS bundle_end, any_value(is_orphan) AS is_orphan,
         sum(elapsed_s) AS elapsed_sum,
         {total('kj', 'kj <> 0')} AS kj_sum,
         {half_even(mean('hr', "role = 'warmup'"), 1)} AS warmup_hr,
         {half_even(mean('hr', "role = 'cooldown'"), 1)} AS cooldown_hr
  FROM role GROUP BY athlete_id, bundle_start),
rides AS (
  SELECT b.*, m.id, m.name, m.start, m.hr, m.max_hr, m.calories, m.elapsed_s, m.kj,
         nullif(m.kj, 0) * 1000 / nullif(m.elapsed_s, 0) AS watts
  FROM bundles b JOIN role m ON m.athlete_id = b.athlete_id AND m.bundle_start = b.bundle_start
   AND m.rank = 1),
recent AS (SELECT * FROM strength WHERE day >= DATE '{START}'),
best AS (
  SELECT s.position, r.id, r.name, r.bundle_end,
         row_number() OVER (PARTITION BY s.position
                            ORDER BY r.bundle_end DESC, r.bundle_start, r.id) AS rank
  FROM recent s JOIN rides r ON r.athlete_id = s.athlete_id
   AND CAST(r.bundle_end AS DATE) = s.day AND r.bundle_end <= s.start_ts),
matched AS (
  SELECT s.*, CASE WHEN ok THEN b.id END AS ride_id, CASE WHEN ok THEN b.name END AS ride_name,
         CASE WHEN ok THEN b.bundle_end END AS ride_end
  FROM recent s LEFT JOIN best b ON b.position = s.position AND b.rank = 1,
  LATERAL (SELECT s.trainer_led OR epoch_us(s.start_ts) - epoch_us(b.bundle_end)
                  <= {TOLERANCE_S * 1000000} AS ok)),
tags AS (SELECT ride_id AS id, max(day) AS pre_strength_for FROM matched
         WHERE ride_id IS NOT NULL GROUP BY 1)""")

_COMMON = f"""athlete_id, id AS ride_id, CAST(start AS DATE) AS date, name,
       {half_even('hr', 1)} AS hr, {half_even('elapsed_s / 60.0::DOUBLE', 1)} AS minutes,
       pre_strength_for"""

CHECKS = {
    "ride_bundles": (
        lambda s, d: sessions.bundle_by_gap(_rides(s, d), GAP_S).select(
            "athlete_id", "id", "start", "bundle_start"),
        _ALL + "SELECT athlete_id, id, start, bundle_start FROM role"),
    "bundles_of_one_athlete": (
        lambda s, d: sessions.bundle_by_gap(
            _rides(s, d).withColumn("athlete_id", F.lit(0).cast("long")), 60).select(
            "athlete_id", "id", "start", "bundle_start"),
        with_(ACTS.replace("user_id AS athlete_id", "0::BIGINT AS athlete_id"),
              _rows("src = 'peloton'", 60))
        + "SELECT athlete_id, id, start, bundle_start FROM role"),
    "streamed_bundles": (
        _streamed_bundles,
        _ALL + "SELECT athlete_id, id, start, bundle_start FROM role"),
    "ride_roles": (
        lambda s, d: sessions.mark_main(_rides(s, d), GAP_S).select(
            "athlete_id", "id", "bundle_start", "role", "is_orphan"),
        _ALL + "SELECT athlete_id, id, bundle_start, role, is_orphan FROM role"),
    "class_sessions": (
        lambda s, d: _sessions(s, d, orphans=False),
        _RECENT + f"""
SELECT {_COMMON}, max_hr, {half_even('elapsed_sum / 60.0::DOUBLE', 1)} AS total_minutes,
       {half_even('watts', 1)} AS watts, {half_even('nullif(kj_sum, 0)', 1)} AS kj, calories,
       coalesce(hr >= 128, false) OR coalesce(watts >= 150, false) AS high_intensity,
       warmup_hr, cooldown_hr, {half_even('hr - cooldown_hr', 1)} AS hr_recovery
FROM rides LEFT JOIN tags USING (id) WHERE NOT is_orphan"""),
    "class_warmup_only": (
        lambda s, d: _sessions(s, d, orphans=True),
        _RECENT + f"SELECT {_COMMON} FROM rides LEFT JOIN tags USING (id) WHERE is_orphan"),
    "strength_ride_matches": (
        lambda s, d: _matches(s, d).select(
            "position", "start", F.col("match.ride_id").alias("ride_id"),
            F.col("match.at").alias("ride_end")),
        _RECENT + "SELECT position, start_ts AS start, ride_id, ride_end FROM matched"),
    "strength_sessions": (
        lambda s, d: reports.strength_report(_matches(s, d)),
        _RECENT + """
SELECT athlete_id, day AS date, name, minutes, logged_minutes, trainer_led,
       ride_name AS warmup_ride FROM matched"""),
    "strength_index_rows": (
        lambda s, d: A.strength(s, d),
        with_(ACTS, STRENGTH) + """
SELECT athlete_id, position, start_ts AS start, day AS date, name, minutes, logged_minutes,
       trainer_led FROM strength"""),
    "activities_during_life_events": (
        lambda s, d: reports.activities_during_events(A.activities(s, d), A.life_events(s, d)),
        with_(ACTS, LIFE_EVENTS) + """
SELECT a.athlete_id, a.id, a.start_time, l.id AS event_id, l.title
FROM acts a JOIN life l ON l.athlete_id = a.athlete_id AND a.start_time >= l.day
 AND a.start_time <= coalesce(l.day_end, l.day + INTERVAL 1 DAY)"""),
}
