"""The adapters of :mod:`checks.adapters` as SQL common table expressions."""

from __future__ import annotations


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def total(value: str, condition: str = "") -> str:
    """Exact sum of a double expression, in binary digits down to 2**-60."""
    where = f" FILTER (WHERE {condition})" if condition else ""
    scale = "1152921504606846976.0::DOUBLE"
    return f"(CAST(sum(CAST(CAST({value} AS DOUBLE) * {scale} AS HUGEINT)){where} AS DOUBLE) / {scale})"


def mean(value: str, condition: str = "") -> str:
    where = f" FILTER (WHERE {condition})" if condition else ""
    return f"({total(value, condition)} / nullif(count({value}){where}, 0))"


def half_even(value: str, digits: int) -> str:
    """Rounding of the exact binary value, true ties to even."""
    return f"CAST(printf('%.{digits}f', {value}) AS DOUBLE)"


def ascii_only(value: str) -> str:
    return rf"regexp_replace({value}, '[^\x00-\x7F]', '', 'g')"


E = """e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events)"""

RIDE_NAME = """CASE k % 7 WHEN 0 THEN 'Warm-Up Ride' WHEN 1 THEN 'Cool Down Ride'
         WHEN 2 THEN 'Trainer Session 4' WHEN 3 THEN 'Café Ride '
         ELSE 'Ride ' || CAST(k AS VARCHAR) END"""

ACTS = E + f""",
acts AS (
  SELECT user_id AS athlete_id, CAST(event_id AS VARCHAR) AS id,
         CASE event_type WHEN 'purchase' THEN 'peloton' WHEN 'signup' THEN 'hevy'
              ELSE 'garmin' END AS src,
         {RIDE_NAME} AS name,
         ts AS start_time,
         60.0::DOUBLE + 6.0::DOUBLE * value AS elapsed_s,
         CASE WHEN k % 9 <> 0 THEN k * 7.5::DOUBLE END AS calories,
         CAST(nullif(k, 0) + 75 AS DOUBLE) AS hr,
         CAST(nullif(k, 0) + 75 AS DOUBLE) + 20 AS max_hr,
         CASE WHEN event_type NOT IN ('purchase', 'signup') THEN value * 1000.0::DOUBLE END
           AS distance_m,
         CASE WHEN event_type NOT IN ('purchase', 'signup') THEN value / 10.0::DOUBLE END
           AS speed_mps,
         CASE WHEN event_type NOT IN ('purchase', 'signup') AND k % 4 <> 0
              THEN CAST(k AS DOUBLE) END AS elevation_m,
         CASE WHEN event_type NOT IN ('purchase', 'signup') AND k % 5 <> 0
              THEN CAST(60 + k % 40 AS DOUBLE) END AS cadence,
         CASE WHEN event_type = 'purchase' AND k % 10 <> 0 THEN value END AS kj,
         CAST(event_id AS VARCHAR) || '.fit.gz' AS ref, k, event_id
  FROM e)"""

LONG_ACTS = """acts AS (
  SELECT o_custkey AS athlete_id, CAST(o_orderkey AS VARCHAR) AS id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'peloton' WHEN '2-HIGH' THEN 'hevy'
              ELSE 'garmin' END AS src,
         o_orderdate AS start_time, o_totalprice / 100.0::DOUBLE AS elapsed_s,
         CAST(o_orderkey % 900 AS DOUBLE) AS calories,
         CASE WHEN o_orderkey % 8 <> 0 THEN CAST(100 + o_orderkey % 60 AS DOUBLE) END AS hr,
         o_totalprice AS distance_m,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 500 AS DOUBLE) END AS elevation_m
  FROM orders)"""

TRACKS = """tracks AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS activity_id, l_shipdate AS ts,
         l_extendedprice AS altitude_m, CAST(l_quantity + 80 AS INTEGER) AS heart_rate,
         CAST(l_quantity - 1 AS INTEGER) AS cadence, l_discount * 100.0::DOUBLE AS speed_mps,
         CASE WHEN l_linenumber % 3 = 0 THEN l_tax END AS lat
  FROM lineitem)"""

STRENGTH = f"""strength AS (
  SELECT user_id AS athlete_id, event_id * 2 AS position, date_trunc('second', ts) AS start_ts,
         CAST(ts AS DATE) AS day, trim({ascii_only("title")}) AS name, trainer_led,
         CASE WHEN trainer_led THEN 60.0::DOUBLE ELSE logged END AS minutes,
         CASE WHEN trainer_led THEN logged END AS logged_minutes
  FROM (SELECT *, CASE WHEN k % 11 = 0 THEN '  ' ELSE {RIDE_NAME} END AS title,
               k % 11 <> 0 AND k % 7 = 2 AS trainer_led,
               CASE WHEN k % 6 <> 0 THEN
                 {half_even("(60.0::DOUBLE + 6.0::DOUBLE * value) / 60.0::DOUBLE", 1)} END
                 AS logged
        FROM e WHERE event_type = 'signup'))"""

READINGS = f"""readings AS (
  SELECT user_id AS athlete_id, event_id AS entry,
         CAST(event_id // 3 AS VARCHAR) AS id,
         CASE WHEN k % 16 <> 3 THEN CASE event_type WHEN 'view' THEN 'hevy'
              ELSE 'google_fit_manual_entry' END END AS original_source,
         CASE WHEN k % 8 = 0 THEN CAST(date_trunc('week', ts) AS TIMESTAMP) ELSE ts END
           AS recorded_at,
         CASE WHEN k <> 0 THEN value END AS kg,
         CASE WHEN k % 7 <> 0 THEN {half_even("value * 2.2046226218::DOUBLE", 1)}
              + CASE WHEN k % 5 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS lb
  FROM e)"""

LIFE_EVENTS = """life AS (
  SELECT user_id AS athlete_id, event_id AS entry,
         CASE WHEN k <> 50 THEN CAST(event_id // 4 AS VARCHAR) END AS id,
         CAST(ts AS DATE) AS day,
         CASE WHEN k % 2 = 0 THEN CAST(ts AS DATE) + (k % 5 - 1) END AS day_end,
         k % 6 = 5 AS bad_category, 'Event ' || CAST(k AS VARCHAR) AS title,
         k % 25 = 7 AS no_description, event_id // 4 AS block
  FROM e)"""
