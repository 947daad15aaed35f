"""Ingest, lookup, weight and batch accounting, with their SQL."""

from __future__ import annotations

from checks import adapters as A
from checks.sql import ACTS, E, LONG_ACTS, RIDE_NAME, STRENGTH, TRACKS, half_even, with_
from pyspark.sql import functions as F
from stridelake import schemas, session
from stridelake.operators import lookup, normalize, quality
from stridelake.sinks import sections, tables
from stridelake.sources import files, listing, payloads
from stridelake.streaming import ingest


def _flat(activities):
    return activities.select(
        "id", "original_source", "activity_type", "start_time", "elapsed_time_s", "calories",
        "average_heart_rate", "device_name", "raw_file_reference",
        F.col("endurance_metrics.distance_m").alias("distance_m"),
        F.col("endurance_metrics.gps_track_available").alias("gps_track_available"),
        F.col("strength_metrics").isNotNull().alias("has_strength"),
        F.col("class_metrics.class_type").alias("class_type"),
        F.col("class_metrics.output_kj").alias("output_kj"),
    )


def _device_raw(s, d):
    return payloads.collapse_messages(A.messages(s, d))


def _device_activities(s, d):
    """All files go through the operators, whose rules turn away those without a start time."""
    files = _device_raw(s, d).files
    mapped = normalize.to_activity(files.withColumn("entry", F.col("payload")))
    good, _ = quality.split_ok(quality.apply_rules(mapped, normalize.activity_rules()))
    return _flat(good)


def _device_points(s, d):
    records = _device_raw(s, d).records.select(
        normalize.X.activity_id_from_entry(F.col("payload")).alias("activity_id"), "record")
    return normalize.to_track_points(records)


def _xml(s, d):
    return payloads.parse_tcx(A.xml_files(s, d))


def _xml_activities(s, d):
    files = payloads.tcx_to_raw(_xml(s, d)).files
    good = files.where(F.col("error").isNull())
    return _flat(normalize.to_activity(good.withColumn("entry", F.col("payload"))))


def _xml_points(s, d):
    return payloads.tcx_points(_xml(s, d).points).select("payload", "record.*").select(
        "payload", "timestamp", "heart_rate", "cadence", "speed", "distance", "power")


def _triaged(found):
    return listing.triage_entries(found).drop("length", "modified")


def _lookup(s, d):
    return lookup.dedupe_lookup(A.index(s, d))


def _enriched(s, d):
    return lookup.enrich_names(A.unnamed_activities(s, d), _lookup(s, d))


def _batch(s, d):
    triaged = listing.triage_entries(A.file_listing(s, d))
    raw = payloads.collapse_messages(A.messages(s, d))
    names = _lookup(s, d)
    return ingest.ingest(triaged, raw, names, "batch")


_DEVICE = """dev AS (
  SELECT o.*, o_orderkey AS key, CAST(o_orderkey AS VARCHAR) AS id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'peloton' WHEN '2-HIGH' THEN 'hevy'
           WHEN '3-MEDIUM' THEN 'garmin' WHEN '4-NOT SPECIFIED' THEN 'unknown' ELSE 'acme' END
           AS src,
         CASE o_orderkey % 5 WHEN 0 THEN 'Cycling' WHEN 1 THEN 'training'
           WHEN 2 THEN 'fitness_equipment' WHEN 3 THEN 'curling' ELSE 'running' END AS sport,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS start_time,
         coalesce(p.fix, false) AS fix
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, bool_or(l_linenumber % 4 = 0) AS fix FROM lineitem GROUP BY 1) p
    ON p.l_orderkey = o.o_orderkey)"""

_FLAT_DEVICE = """
SELECT id, src AS original_source, sport AS activity_type, start_time,
       o_totalprice / 100.0::DOUBLE AS elapsed_time_s,
       CASE WHEN key % 3 = 0 THEN 1.0 ELSE CAST(key % 900 AS DOUBLE) END AS calories,
       CAST(NULL AS DOUBLE) AS average_heart_rate,
       CASE WHEN key % 2 = 0 THEN '3122' WHEN key % 4 = 1 THEN '42' END AS device_name,
       id || '.fit.gz' AS raw_file_reference,
       CASE WHEN src <> 'peloton' AND sport IN ('Cycling', 'running') THEN o_totalprice END
         AS distance_m,
       CASE WHEN src <> 'peloton' AND sport IN ('Cycling', 'running') THEN fix END
         AS gps_track_available,
       src <> 'peloton' AND sport = 'training' AS has_strength,
       CASE WHEN src = 'peloton' OR sport = 'fitness_equipment' THEN 'spin' END AS class_type,
       CASE WHEN src = 'peloton' OR sport = 'fitness_equipment'
            THEN CAST(key % 700 AS DOUBLE) END AS output_kj
FROM dev"""

_POINT_COLUMNS = """CAST(l_orderkey AS VARCHAR) AS activity_id, l_shipdate AS "timestamp",
       CASE WHEN l_linenumber % 2 = 0 THEN l_partkey * 1000 * (180.0::DOUBLE / 2147483648.0) END
         AS lat,
       CASE WHEN l_linenumber % 4 = 0 THEN l_suppkey * -1000 * (180.0::DOUBLE / 2147483648.0) END
         AS lon,
       CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice + 0.5::DOUBLE ELSE l_extendedprice END
         AS altitude_m,
       CAST(l_quantity AS INTEGER) AS heart_rate, CAST(l_quantity AS INTEGER) AS cadence,
       CASE WHEN l_linenumber % 2 = 1 THEN l_tax ELSE l_discount END AS speed_mps,
       CAST(NULL AS DOUBLE) AS distance_m, CAST(NULL AS DOUBLE) AS power_w"""

_BATCH = """b AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS name, o_orderkey AS key FROM orders),
out AS (
  SELECT name || CASE key % 10 WHEN 0 THEN '' WHEN 1 THEN '.GPX' WHEN 2 THEN '.txt'
                               WHEN 3 THEN '.FIT' ELSE '.fit.gz' END AS entry,
         CASE WHEN key % 10 IN (0, 1) THEN 'skipped'
              WHEN key % 10 IN (2, 3) OR key % 11 = 0 THEN 'failed' ELSE 'succeeded' END AS status,
         CASE key % 10 WHEN 0
              THEN 'folder holds no supported payload'
              WHEN 1 THEN 'unsupported file type'
              WHEN 2 THEN 'no supported payload found in this entry'
              WHEN 3 THEN 'payload could not be decoded'
              ELSE CASE WHEN key % 11 = 0 THEN 'start_time is required' END END AS reason,
         key
  FROM b)"""

_XML = """x AS (
  SELECT *, CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS start_time,
         CASE WHEN k % 17 = 0 THEN 'malformed XML' WHEN k % 13 = 0 THEN 'no lap element found' END
           AS error
  FROM e)"""

# One lap file per block of fifty events, of all kinds of names; every ninth breaks off. The file of
# block 3 is that of a folder which is empty at first.
_FOLDER = """files AS (
  SELECT *, event_id // 50 AS block,
         CASE WHEN event_id // 50 = 3 THEN 'late' ELSE CASE event_id // 50 % 6
           WHEN 0 THEN '' WHEN 1 THEN '_' WHEN 2 THEN 'ride[' WHEN 3 THEN '.' ELSE 'f' END
           || CAST(event_id // 50 AS VARCHAR) || CASE event_id // 50 % 6
           WHEN 0 THEN '.tcx' WHEN 1 THEN '.tcx.gz' WHEN 2 THEN '].tcx' WHEN 3 THEN '.tcx'
           WHEN 4 THEN '' ELSE '.tcx.gz' END END AS entry,
         CASE WHEN event_id // 50 = 3 OR event_id // 50 % 6 = 4 THEN 'ride.tcx' END AS inner_file,
         coalesce(inner_file, entry) AS file,
         event_id // 50 % 9 = 8 AS broken,
         min(date_trunc('second', ts)) OVER (PARTITION BY event_id // 50) AS first
  FROM e)"""

_INDEX = f"""idx AS (
  SELECT event_id, event_id * 2 AS position,
         CASE WHEN k % 11 = 0 THEN '' ELSE trim({RIDE_NAME}) END AS title FROM e
  UNION ALL
  SELECT event_id, event_id * 2 + 1, CASE WHEN k % 2 = 0 THEN '' ELSE 'Second title' END
  FROM e WHERE k % 13 = 0),
names AS (
  SELECT CAST(event_id AS VARCHAR) || '.fit.gz' AS file, arg_max(title, position) AS title
  FROM idx WHERE title <> '' GROUP BY 1)"""

_NAMED = """named AS (
  SELECT a.id, CASE WHEN event_id % 3 = 2 THEN 'Own' ELSE
                 coalesce(n.title, CASE WHEN event_id % 3 = 1 THEN '' END) END AS name,
         CASE WHEN event_id % 3 = 2 THEN 'already_named'
              WHEN n.title IS NOT NULL THEN 'updated' ELSE 'no_match' END AS name_status
  FROM acts a LEFT JOIN names n ON n.file = a.ref AND event_id % 7 <> 0)"""

def _activity_table(path):
    return tables.Table(
        path, schemas.STORED_ACTIVITY, "id", schemas.ORIGIN, tables.activity_partitions())


def _from_entry(activities, entry):
    return activities.withColumns({
        "entry": F.lit(entry), "modified": F.lit(None).cast("timestamp")})


def _upserted(s, d):
    """Store some activities with another source and name, then all; the later entry counts."""
    table = _activity_table(session.fresh_path(s, "upserted"))
    first = A.activities(s, d)
    again = first.where(F.col("calories").isNull()).withColumn("name", F.lit("Again")).withColumn(
        "original_source", F.lit("peloton"))
    table.store(_from_entry(again, "b"), "one")
    table.store(_from_entry(first, "a"), "two")
    return table.read(s).select(
        "id", "original_source", "name", "start_time", "elapsed_time_s")


def _upserted_with_repeats(s, d):
    """Every event is a version of its user's record; the latest counts, in three batches that
    overlap, with many versions of a record in each and a compaction between them."""
    table = _activity_table(session.fresh_path(s, "repeats"))
    versions = normalize.conform(A.events(s, d).select(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("name"),
        F.col("value").alias("elapsed_time_s"), F.lit("record").alias("entry"),
        F.col("ts").alias("modified"), F.col("k").cast("double").alias("calories")),
        schemas.STORED_ACTIVITY)
    for n, some in enumerate(("calories % 5 < 3", "calories % 3 = 0", "calories % 2 = 0")):
        table.store(versions.where(some), f"batch {n}")
        if n == 1:
            table.compact(s)
    return table.read(s).select("id", "name", "elapsed_time_s", "modified")


def _tracks_after_reingest(s, d):
    """All orders come with their lines as track points; orders divisible by 3 come back without
    any, those divisible by 4 with the lines of even number only, in an entry of the same name
    that was changed later."""
    path = session.fresh_path(s, "tracks")
    store = ingest.Store("", f"{path}/activities", f"{path}/tracks", f"{path}/ledger")
    key = F.col("id").cast("long")
    for n, (orders, lines) in enumerate([
            (F.lit(True), F.lit(True)),
            ((key % 3 == 0) | (key % 4 == 0), (key % 3 != 0) & (F.col("line") % 2 == 0))]):
        when = F.timestamp_seconds(F.lit(n))
        origin = {"entry": F.concat("id", F.lit(".fit")), "modified": when}
        acts = A.long_activities(s, d).where(orders).withColumns(origin)
        points = A.tracks(s, d).withColumn("id", F.col("activity_id")).withColumn(
            "line", F.col("cadence")).where(orders & lines).withColumns(origin)
        ingest.store_result(ingest.IngestResult(
            normalize.conform(acts, schemas.STORED_ACTIVITY),
            normalize.conform(points, schemas.STORED_POINT),
            s.createDataFrame([], schemas.OUTCOME)), store, f"batch {n}")
    return ingest.read_tracks(s, store).select(
        "activity_id", "timestamp", "altitude_m", "heart_rate", "cadence")


def _run_over_folder(s, d):
    """Write lap files, run a batch over their folder, fill an empty folder and run once more."""
    path = session.fresh_path(s, "folder")
    store = ingest.Store(f"{path}/in", f"{path}/activities", f"{path}/tracks", f"{path}/ledger")
    late = F.col("payload").startswith("late")
    written = A.lap_files(s, d)
    A.write_files(written.where(~late), f"{path}/in", ["late/"])
    first = ingest.run_batch(s, store, batch_id="first")
    A.write_files(written.where(late), f"{path}/in")
    second = ingest.run_batch(s, store, batch_id="second")
    return store, first.unionByName(second)


def _folder_tracks(s, d):
    store, _ = _run_over_folder(s, d)
    acts = ingest.read_activities(s, store).select(
        "id", "raw_file_reference", "start_time", "original_source")
    points = ingest.read_tracks(s, store).select(
        F.col("activity_id").alias("id"), "timestamp", "cadence", "distance_m")
    return acts.join(points, "id")


def _streamed(s, d):
    """Stream all activities into a table, then once more from the start of the stream."""
    path = session.fresh_path(s, "streamed")
    for _ in range(2):
        stream = _from_entry(A.order_activities(A.order_stream(s, d)), "order")
        ingest.upsert_available_now(
            stream, path, schemas.STORED_ACTIVITY, "id", schemas.ORIGIN,
            tables.activity_partitions(), session.fresh_path(s, "progress"))
    return _activity_table(path).read(s).select(
        "athlete_id", "id", "original_source", "start_time", "elapsed_time_s")


def _json_activities(s, d):
    path = session.fresh_path(s, "json")
    sections.write_section(A.activities(s, d).drop("athlete_id"), path)
    return files.read_activities(s, path, multi_line=False).select(
        "athlete_id", "id", "original_source", "name", "start_time", "elapsed_time_s",
        F.col("endurance_metrics.distance_m").alias("distance_m"),
        F.col("class_metrics.output_kj").alias("output_kj"))


def _csv_strength(s, d):
    path = session.fresh_path(s, "index")
    A.index(s, d).select(*schemas.ACTIVITY_INDEX).write.option("header", True).option(
        "escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    return normalize.strength_sessions(files.read_activity_index(s, path)).select(
        "start", "date", "name", "minutes", "logged_minutes", "trainer_led")


CHECKS = {
    "stored_activities_replaced_by_id": (
        _upserted,
        with_(ACTS) + """
SELECT id, CASE WHEN calories IS NULL THEN 'peloton' ELSE src END AS original_source,
       CASE WHEN calories IS NULL THEN 'Again' ELSE name END AS name, start_time,
       elapsed_s AS elapsed_time_s
FROM acts"""),
    "upsert_with_repeated_keys": (
        _upserted_with_repeats,
        with_(E) + """
SELECT CAST(user_id AS VARCHAR) AS id, arg_max(event_type, ts) AS name,
       arg_max(value, ts) AS elapsed_time_s, max(ts) AS modified
FROM e WHERE k % 5 < 3 OR k % 3 = 0 OR k % 2 = 0 GROUP BY user_id"""),
    "tracks_after_reingest": (
        _tracks_after_reingest,
        with_(TRACKS) + """
SELECT activity_id, ts AS "timestamp", altitude_m, heart_rate, cadence
FROM (SELECT *, CAST(activity_id AS BIGINT) AS key FROM tracks)
WHERE key IN (SELECT o_orderkey FROM orders)
  AND (key % 3 <> 0 AND (key % 4 <> 0 OR cadence % 2 = 0))"""),
    "folder_ingested": (
        _folder_tracks,
        with_(E, _FOLDER) + """
SELECT replace(replace(entry, '.gz', ''), '.tcx', '') AS id, file AS raw_file_reference,
       first AS start_time, 'peloton' AS original_source, date_trunc('second', ts) AS "timestamp",
       k AS cadence, value AS distance_m
FROM files WHERE NOT broken"""),
    "folder_ingest_summary": (
        lambda s, d: _run_over_folder(s, d)[1],
        with_(E, _FOLDER) + """,
entries AS (SELECT entry, bool_or(broken) AS broken FROM files GROUP BY entry)
SELECT 'first' AS batch_id, count(*) + 1 AS attempted,
       count(*) FILTER (WHERE NOT broken) AS succeeded, count(*) FILTER (WHERE broken) AS failed,
       1 AS skipped
FROM entries WHERE entry <> 'late'
UNION ALL
SELECT 'second', count(*) FILTER (WHERE broken OR entry = 'late'),
       count(*) FILTER (WHERE entry = 'late'), count(*) FILTER (WHERE broken), 0
FROM entries"""),
    "streamed_activities": (
        _streamed,
        with_(LONG_ACTS) + """
SELECT athlete_id, id, src AS original_source, start_time, elapsed_s AS elapsed_time_s
FROM acts"""),
    "activities_from_json": (
        _json_activities,
        with_(ACTS) + """
SELECT 0::BIGINT AS athlete_id, id, src AS original_source, name, start_time,
       elapsed_s AS elapsed_time_s, distance_m, kj AS output_kj
FROM acts"""),
    "strength_sessions_from_csv": (
        _csv_strength,
        with_(ACTS, STRENGTH) + """
SELECT start_ts AS start, day AS date, name, minutes, logged_minutes, trainer_led
FROM strength"""),
    "device_messages_collapsed": (
        lambda s, d: _device_raw(s, d).files.select(
            "payload", "file_id.manufacturer", "file_id.garmin_product", "file_id.product",
            "session.sport", "session.total_calories", "has_position"),
        with_(_DEVICE) + """
SELECT coalesce(id, CAST(l.l_orderkey AS VARCHAR)) || '.fit.gz' AS payload,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Peloton' WHEN '2-HIGH' THEN 'hevy'
         WHEN '3-MEDIUM' THEN 'Garmin' WHEN '4-NOT SPECIFIED' THEN 'strava'
         WHEN '5-LOW' THEN 'Acme' END AS manufacturer,
       CASE WHEN key % 2 = 0 THEN '3122' WHEN key % 4 = 1 THEN '0' END AS garmin_product,
       CASE WHEN key % 4 = 1 THEN '42' END AS product, sport,
       CASE WHEN key % 3 = 0 THEN 1.0 ELSE CAST(key % 900 AS DOUBLE) END AS total_calories,
       coalesce(l.fix, dev.fix) AS has_position
FROM dev FULL JOIN (SELECT l_orderkey, bool_or(l_linenumber % 4 = 0) AS fix
                    FROM lineitem GROUP BY 1) l ON l.l_orderkey = key"""),
    "device_activities": (
        _device_activities, with_(_DEVICE) + _FLAT_DEVICE + " WHERE start_time IS NOT NULL"),
    "device_track_points": (_device_points, f"SELECT {_POINT_COLUMNS} FROM lineitem"),
    "xml_outcomes": (
        lambda s, d: _xml(s, d).files.select("payload", "sport", "creator", "start", "error"),
        with_(E, _XML) + """
SELECT id || '.tcx' AS payload, CASE WHEN k % 17 <> 0 THEN 'Biking' END AS sport,
       CASE WHEN k % 17 <> 0 THEN CASE WHEN k % 3 = 0 THEN 'Other Bike' ELSE 'Peloton Bike+' END
         END AS creator,
       CASE WHEN k % 17 <> 0 THEN strftime(start_time, '%Y-%m-%dT%H:%M:%SZ') END AS start, error
FROM x"""),
    "xml_activities": (
        _xml_activities,
        with_(E, _XML) + """
SELECT id, CASE WHEN k % 3 = 0 THEN 'other bike' ELSE 'peloton' END AS original_source,
       'Biking' AS activity_type, start_time, value AS elapsed_time_s,
       CAST(k AS DOUBLE) AS calories, CAST(nullif(k, 0) AS DOUBLE) AS average_heart_rate,
       CAST(NULL AS VARCHAR) AS device_name, id || '.tcx' AS raw_file_reference,
       CAST(NULL AS DOUBLE) AS distance_m, CAST(NULL AS BOOLEAN) AS gps_track_available,
       false AS has_strength, CASE WHEN k % 3 <> 0 THEN 'Biking' END AS class_type,
       CASE WHEN k % 3 <> 0 THEN k * 1000.5::DOUBLE / 1000 END AS output_kj
FROM x WHERE error IS NULL"""),
    "xml_track_points": (
        _xml_points,
        with_(E, _XML) + """
SELECT id || '.tcx' AS payload, start_time AS "timestamp", nullif(k, 0) AS heart_rate,
       CAST(round_even(value, 0) AS INTEGER) AS cadence, value / 10.0::DOUBLE AS speed,
       value AS distance, CAST(k AS DOUBLE) AS power
FROM x WHERE error IS NULL
UNION ALL
SELECT id || '.tcx', start_time + INTERVAL 2 SECOND, CAST(round_even(k + 60.5::DOUBLE, 0) AS INTEGER),
       0, value / 10.0::DOUBLE, value, CAST(k AS DOUBLE)
FROM x WHERE error IS NULL"""),
    "entry_triage": (
        lambda s, d: _triaged(A.file_listing(s, d)),
        with_(_BATCH) + """
SELECT entry, CASE WHEN key % 10 >= 3 THEN entry END AS payload,
       CASE WHEN key % 10 >= 3 THEN 'parse' ELSE status END AS status,
       CASE WHEN key % 10 < 3 THEN reason END AS reason
FROM out"""),
    "folder_triage": (
        lambda s, d: _triaged(A.folder_listing(s, d)),
        """
WITH f AS (
  SELECT 'folder ' || CAST(o_custkey AS VARCHAR) AS entry,
         min(CAST(o_orderkey AS VARCHAR)
             || CASE o_orderkey % 4 WHEN 1 THEN '.fit' WHEN 2 THEN '.TCX.gz' END) AS file
  FROM orders GROUP BY 1)
SELECT entry, entry || '/sub/' || file AS payload,
       CASE WHEN file IS NULL THEN 'skipped' ELSE 'parse' END AS status,
       CASE WHEN file IS NULL
            THEN 'folder holds no supported payload' END AS reason
FROM f"""),
    "pending_entries": (
        lambda s, d: ingest.pending_entries(
            listing.triage_entries(A.file_listing(s, d)), A.ledger(s, d)).select("entry"),
        with_(_BATCH) + "SELECT entry FROM out WHERE NOT (key % 7 < 5 AND key % 4 IN (0, 1))"),
    "pending_after_change": (
        lambda s, d: ingest.pending_entries(
            listing.triage_entries(A.file_listing(s, d).withColumn(
                "length", F.when(F.length("path") % 2 == 0, 1).otherwise(2).cast("long"))),
            A.ledger(s, d).withColumn(
                "length", F.when(F.col("payload").isNotNull(), 1).cast("long"))).select("entry"),
        with_(_BATCH) + """
SELECT entry FROM out
WHERE NOT (key % 7 < 5 AND key % 4 IN (0, 1) AND (key % 10 < 3 OR length(entry) % 2 = 0))"""),
    "next_batch_of_entries": (
        lambda s, d: ingest.pending_entries(
            listing.triage_entries(A.file_listing(s, d)), A.ledger(s, d), 50).select("entry"),
        with_(_BATCH) + """
SELECT entry FROM out WHERE NOT (key % 7 < 5 AND key % 4 IN (0, 1)) ORDER BY entry LIMIT 50"""),
    "ingest_outcomes": (
        lambda s, d: _batch(s, d).outcomes.select("entry", "status", "reason"),
        with_(_BATCH) + "SELECT entry, status, reason FROM out"),
    "ingest_activities": (
        lambda s, d: _flat(_batch(s, d).activities),
        with_(_DEVICE) + _FLAT_DEVICE + " WHERE start_time IS NOT NULL AND key % 10 > 3"),
    "ingest_track_points": (
        lambda s, d: _batch(s, d).tracks.drop(*schemas.ORIGIN),
        f"""
SELECT {_POINT_COLUMNS} FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND l_orderkey % 10 > 3
  AND l_orderkey % 11 <> 0"""),
    "batch_summary": (
        lambda s, d: quality.batch_summary(_batch(s, d).outcomes),
        with_(_BATCH) + """
SELECT 'batch' AS batch_id, count(*) AS attempted,
       count(*) FILTER (WHERE status = 'succeeded') AS succeeded,
       count(*) FILTER (WHERE status = 'failed') AS failed,
       count(*) FILTER (WHERE status = 'skipped') AS skipped
FROM out"""),
    "quarantined_entries": (
        lambda s, d: quality.quarantine(_batch(s, d).outcomes),
        with_(_BATCH) + """
SELECT 'batch' AS batch_id, entry, status, reason FROM out WHERE status <> 'succeeded'"""),
    "name_lookup": (_lookup, with_(E, _INDEX) + "SELECT file, title FROM names"),
    "names_filled": (
        lambda s, d: _enriched(s, d).select("id", "name", "name_status"),
        with_(ACTS, _INDEX, _NAMED) + "SELECT * FROM named"),
    "name_backfill_counts": (
        lambda s, d: lookup.name_counts(_enriched(s, d)),
        with_(ACTS, _INDEX, _NAMED) + """
SELECT count(*) FILTER (WHERE name_status = 'updated') AS updated,
       count(*) FILTER (WHERE name_status = 'already_named') AS already_named,
       count(*) FILTER (WHERE name_status = 'no_match') AS no_match
FROM named"""),
    "weight_readings": (
        lambda s, d: normalize.normalize_weight(A.weight_stream(s, d)).select(
            "id", "source", "original_source", "recorded_at", "weight_kg", "weight_lb",
            F.array_join("violations", ",").alias("violations")),
        with_(E) + f"""
SELECT CAST(epoch_us(ts) * 1000 + k AS VARCHAR) AS id, 'google_fit' AS source,
       CASE WHEN k % 9 = 2 THEN NULL WHEN event_type IN ('view', 'click') THEN 'hevy'
            ELSE 'google_fit_manual_entry' END AS original_source,
       ts AS recorded_at, {half_even('value', 2)} AS weight_kg,
       {half_even('value * 2.2046226218::DOUBLE', 1)} AS weight_lb,
       CASE WHEN k % 9 = 2 THEN 'unrecognized origin' ELSE '' END AS violations
FROM e"""),
}
