"""Shape the supplied tables like the engine's inputs.

Each adapter reads a whole table; the kind of an event only decides values. ``checks.sql`` repeats the
same derivations in SQL.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stridelake import schemas
from stridelake.functions import numeric as N
from stridelake.operators import normalize
from stridelake.session import configure
from stridelake.sources import listing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def _case(subject: Column, cases: dict, default) -> Column:
    result = None
    for value, outcome in cases.items():
        outcome = F.lit(outcome)
        result = F.when(subject == value, outcome) if result is None else result.when(
            subject == value, outcome)
    return result.otherwise(default if isinstance(default, Column) else F.lit(default))


def ride_name() -> Column:
    k = F.col("k")
    return _case(k % 7, {0: "Warm-Up Ride", 1: "Cool Down Ride", 2: "Trainer Session 4",
                         3: "Café Ride "}, F.concat(F.lit("Ride "), k.cast("string")))


def event_source() -> Column:
    return _case(F.col("event_type"), {"purchase": "peloton", "signup": "hevy"}, "garmin")


def elapsed() -> Column:
    return F.lit(60.0) + F.lit(6.0) * F.col("value")


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities with fine-grained times, one per event."""
    e = events(spark, sf_dir).withColumn("src", event_source())
    k, value = F.col("k"), F.col("value")
    outdoor, ride = F.col("src") == "garmin", F.col("src") == "peloton"
    endurance = F.struct(
        (value * 1000.0).alias("distance_m"),
        (value / 10.0).alias("average_speed_mps"),
        F.lit(None).cast("double").alias("max_speed_mps"),
        F.when(k % 4 != 0, k.cast("double")).alias("elevation_gain_m"),
        F.when(k % 5 != 0, (60 + k % 40).cast("double")).alias("average_cadence"),
        F.lit(None).cast("double").alias("average_power_w"),
        F.lit(None).cast("double").alias("max_power_w"),
        (k % 2 == 0).alias("gps_track_available"),
    )
    in_class = F.struct(
        F.lit(None).cast("string").alias("instructor"),
        F.lit(None).cast("string").alias("class_title"),
        F.lit("Biking").alias("class_type"),
        F.when(k % 10 != 0, value).alias("output_kj"),
    )
    hr = (F.nullif(k, F.lit(0)) + 75).cast("double")
    return normalize.conform_activity(e.select(
        F.col("user_id").alias("athlete_id"),
        F.col("event_id").cast("string").alias("id"),
        F.col("src").alias("original_source"),
        _case(F.col("src"), {"garmin": "cycling", "peloton": "Biking"}, "Weight Training")
        .alias("activity_type"),
        ride_name().alias("name"),
        F.col("ts").alias("start_time"),
        elapsed().alias("elapsed_time_s"),
        elapsed().alias("moving_time_s"),
        F.when(k % 9 != 0, k * 7.5).alias("calories"),
        hr.alias("average_heart_rate"),
        (hr + 20).alias("max_heart_rate"),
        F.when(outdoor, endurance).alias("endurance_metrics"),
        F.when(ride, in_class).alias("class_metrics"),
        F.concat(F.col("event_id").cast("string"), F.lit(".fit.gz")).alias("raw_file_reference"),
    ))


def activity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` and ``text``: activity records as JSON, most of them broken in one way."""
    kinds = events(spark, sf_dir).select(F.col("event_id").cast("string").alias("id"), "k")
    acts = activities(spark, sf_dir).drop("athlete_id", "endurance_metrics", "class_metrics")
    way = F.col("k") % 12
    distance = F.struct(F.lit(5.5).alias("distance_m"))
    record = F.struct(
        F.when(way != 5, F.col("id")).alias("id"), F.lit("strava").alias("source"),
        "original_source", "activity_type", "name",
        F.when(way == 7, "soon").otherwise(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("start_time"),
        F.when(way == 3, -1.0).otherwise(F.col("elapsed_time_s")).alias("elapsed_time_s"),
        F.when(way != 0, F.col("calories")).alias("calories"),
        F.when(way == 0, "12 kcal").alias("calories_text"),
        F.when(way.isin(4, 8), distance).alias("endurance_metrics"),
        F.when(way.isin(4, 9), F.struct(F.lit("spin").alias("class_type"))).alias("class_metrics"),
        F.when(way == 2, 1).alias("colour"), "raw_file_reference")
    text = F.replace(F.to_json(record), F.lit("calories_text"), F.lit("calories"))
    return acts.join(kinds, "id").select(
        F.col("id").cast("long").alias("event_id"),
        F.when(way == 1, F.substring(text, 1, 40)).when(way == 6, F.concat(
            F.lit("["), text, F.lit("]"))).otherwise(text).alias("text"))


def long_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities over several years, one per order."""
    return order_activities(table(spark, sf_dir, "orders"))


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders file as a stream."""
    schema = table(spark, sf_dir, "orders").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(
        sf_dir)


def order_activities(o: DataFrame) -> DataFrame:
    source = _case(F.col("o_orderpriority"), {"1-URGENT": "peloton", "2-HIGH": "hevy"}, "garmin")
    key = F.col("o_orderkey")
    return normalize.conform_activity(o.select(
        F.col("o_custkey").alias("athlete_id"),
        key.cast("string").alias("id"),
        source.alias("original_source"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        (F.col("o_totalprice") / 100.0).alias("elapsed_time_s"),
        (key % 900).cast("double").alias("calories"),
        F.when(key % 8 != 0, (100 + key % 60).cast("double")).alias("average_heart_rate"),
        F.struct(
            F.col("o_totalprice").alias("distance_m"),
            F.lit(None).cast("double").alias("average_speed_mps"),
            F.lit(None).cast("double").alias("max_speed_mps"),
            F.when(key % 3 != 0, (key % 500).cast("double")).alias("elevation_gain_m"),
            F.lit(None).cast("double").alias("average_cadence"),
            F.lit(None).cast("double").alias("average_power_w"),
            F.lit(None).cast("double").alias("max_power_w"),
            F.lit(None).cast("boolean").alias("gps_track_available"),
        ).alias("endurance_metrics"),
    ))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track points, one per line item."""
    li = table(spark, sf_dir, "lineitem")
    has_fix = F.col("l_linenumber") % 3 == 0
    return normalize.conform(li.select(
        F.col("l_orderkey").cast("string").alias("activity_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.when(has_fix, F.col("l_tax")).alias("lat"),
        F.when(has_fix, F.col("l_tax")).alias("lon"),
        F.col("l_extendedprice").alias("altitude_m"),
        (F.col("l_quantity") + 80).cast("int").alias("heart_rate"),
        (F.col("l_quantity") - 1).cast("int").alias("cadence"),
        (F.col("l_discount") * 100.0).alias("speed_mps"),
    ), schemas.TRACK_POINT)


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity index rows: every event, with a second row for some files."""
    e = events(spark, sf_dir)
    k = F.col("k")
    first = e.select(
        F.concat(F.lit("activities/"), F.col("event_id").cast("string"), F.lit(".fit.gz"))
        .alias("Filename"),
        F.when(k % 11 == 0, F.lit("  ")).otherwise(ride_name()).alias("Activity Name"),
        _case(F.col("event_type"), {"signup": "Weight Training"}, "Ride").alias("Activity Type"),
        F.date_format("ts", "MMM d, yyyy, h:mm:ss a").alias("Activity Date"),
        F.when(k % 6 == 0, F.lit("")).otherwise(elapsed().cast("string")).alias("Elapsed Time"),
        F.col("user_id").alias("athlete_id"),
        (F.col("event_id") * 2).alias("position"),
        k.alias("k"),
    )
    second = first.where(k % 13 == 0).select(
        "Filename",
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("Second title")).alias("Activity Name"),
        F.lit("Ride").alias("Activity Type"),
        "Activity Date", "Elapsed Time", "athlete_id",
        (F.col("position") + 1).alias("position"), "k",
    )
    return first.unionByName(second).drop("k")


def strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.strength_sessions(index(spark, sf_dir))


def unnamed_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities of which some have a name, some an empty one and some none."""
    key = F.col("id").cast("long")
    name = F.when(key % 3 == 0, F.lit(None)).when(key % 3 == 1, F.lit("")).otherwise(F.lit("Own"))
    ref = F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("raw_file_reference"))
    return activities(spark, sf_dir).withColumn("name", name).withColumn(
        "raw_file_reference", ref)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight readings with repeated ids, odd values and some at the first instant of a week."""
    v = events(spark, sf_dir)
    k, kg = F.col("k"), F.col("value")
    origin = _case(F.col("event_type"), {"view": "hevy"}, "google_fit_manual_entry")
    lb = N.round_half_even(N.kg_to_lb(kg), 1) + F.when(k % 5 == 0, 1.0).otherwise(0.0)
    return v.select(
        F.col("user_id").alias("athlete_id"),
        F.col("event_id").alias("entry"),
        F.floor(F.col("event_id") / 3).cast("string").alias("id"),
        F.lit("google_fit").alias("source"),
        F.when(k % 16 != 3, origin).alias("original_source"),
        F.when(k % 8 == 0, F.date_trunc("week", "ts")).otherwise(F.col("ts"))
        .alias("recorded_at"),
        F.when(k != 0, kg).alias("weight_kg"),
        F.when(k % 7 != 0, lb).alias("weight_lb"),
    )


def life_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Life events with repeated ids, reversed periods and dangling references."""
    v = events(spark, sf_dir)
    category = _case(F.col("event_type"), {
        "view": "health", "click": "life-event", "signup": "equipment", "purchase": "training"},
        "other")
    k = F.col("k")
    block = F.floor(F.col("event_id") / 4)
    day = F.to_date("ts")
    return v.select(
        F.col("user_id").alias("athlete_id"),
        F.col("event_id").alias("entry"),
        F.when(k != 50, block.cast("string")).alias("id"),
        day.alias("date"),
        F.when(k % 2 == 0, F.date_add(day, k % 5 - 1)).alias("date_end"),
        F.when(k % 6 == 5, "else").otherwise(category).alias("category"),
        F.concat(F.lit("Event "), k.cast("string")).alias("title"),
        F.when(k % 25 != 7, F.lit("text")).alias("description"),
        F.array((block - 5).cast("string"), (block + 5).cast("string"))
        .alias("related_event_ids"),
    )


def weight_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datastream documents with one data point each."""
    v = events(spark, sf_dir)
    k = F.col("k")
    user, synced = normalize.WEIGHT_ORIGINS
    from_app = F.col("event_type").isin("view", "click")
    point = F.struct(
        F.when(k % 9 == 2, F.lit("raw:other")).when(from_app, F.lit(synced))
        .otherwise(F.lit(user)).alias("originDataSourceId"),
        (F.unix_micros("ts") * 1000 + k).cast("string").alias("startTimeNanos"),
        F.array(F.struct(F.struct(F.col("value").alias("fpVal")).alias("value")))
        .alias("fitValue"),
    )
    return v.select(F.array(point).alias("Data Points"))


def _message(msg_type: str, schema, values: dict[str, Column], field: str) -> Column:
    return F.struct(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]).alias(field)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages: file and session messages from orders, samples from line items."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    payload = F.concat(key.cast("string"), F.lit(".fit.gz"))
    maker = _case(F.col("o_orderpriority"), {
        "1-URGENT": "Peloton", "2-HIGH": "hevy", "3-MEDIUM": "Garmin",
        "4-NOT SPECIFIED": "strava"}, "Acme")
    sport = _case(key % 5, {0: "Cycling", 1: "training", 2: "fitness_equipment", 3: "curling"},
                  "running")

    def rows(source: DataFrame, msg_type: str, seq: Column, field: str, values) -> DataFrame:
        return source.select(
            payload.alias("payload"), F.lit(msg_type).alias("msg_type"),
            seq.cast("long").alias("seq"),
            _message(msg_type, schemas.MESSAGE[field].dataType, values, field))

    parts = [
        rows(o, "file_id", F.lit(0), "file_id", {
            "manufacturer": maker,
            "garmin_product": F.when(key % 4 == 0, F.lit("edge")).when(key % 4 == 1, F.lit("0")),
            "product": F.when(key % 4 == 1, F.lit("42"))}),
        rows(o.where(key % 2 == 0), "file_id", F.lit(1), "file_id", {
            "garmin_product": F.lit("3122")}),
        rows(o, "session", F.lit(2), "session", {
            "sport": sport, "sub_sport": F.lit("spin"),
            "start_time": F.when(key % 11 != 0, F.col("o_orderdate").cast("timestamp")),
            "total_elapsed_time": F.col("o_totalprice") / 100.0,
            "total_calories": (key % 900).cast("double"),
            "total_distance": F.col("o_totalprice"),
            "total_work": (key % 700).cast("double")}),
        rows(o.where(key % 3 == 0), "session", F.lit(3), "session", {
            "total_calories": F.lit(1.0)}),
    ]
    li = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    sample = _message("record", schemas.RECORD, {
        "timestamp": F.col("l_shipdate").cast("timestamp"),
        "position_lat": F.when(line % 2 == 0, F.col("l_partkey") * 1000),
        "position_long": F.when(line % 4 == 0, F.col("l_suppkey") * -1000),
        "altitude": F.col("l_extendedprice"),
        "enhanced_altitude": F.when(line % 3 == 0, F.col("l_extendedprice") + 0.5),
        "heart_rate": F.col("l_quantity").cast("int"),
        "cadence": F.col("l_quantity").cast("int"),
        "speed": F.col("l_discount"),
        "enhanced_speed": F.when(line % 2 == 1, F.col("l_tax")),
    }, "record")
    parts.append(li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".fit.gz")).alias("payload"),
        F.lit("record").alias("msg_type"), (line + 10).cast("long").alias("seq"), sample))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One input entry per order: payload files, folders, unsupported and unknown files."""
    key = F.col("o_orderkey")
    name = key.cast("string")
    path = (
        F.when(key % 10 == 0, F.concat(name, F.lit("/readme.txt")))
        .when(key % 10 == 1, F.concat(name, F.lit(".GPX")))
        .when(key % 10 == 2, F.concat(name, F.lit(".txt")))
        .when(key % 10 == 3, F.concat(name, F.lit(".FIT")))
        .otherwise(F.concat(name, F.lit(".fit.gz")))
    )
    return table(spark, sf_dir, "orders").select(path.alias("path"))


def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files per customer folder, one per order."""
    suffix = _case(F.col("o_orderkey") % 4, {0: ".txt", 1: ".fit", 2: ".TCX.gz"}, ".gpx")
    return table(spark, sf_dir, "orders").select(F.concat(
        F.lit("folder "), F.col("o_custkey").cast("string"), F.lit("/sub/"),
        F.col("o_orderkey").cast("string"), suffix).alias("path"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier outcomes for some of the entries of :func:`file_listing`."""
    number = F.regexp_extract("entry", r"(\d+)", 1).cast("long")
    status = _case(number % 4, {0: "succeeded", 1: "skipped"}, "failed")
    return listing.triage_entries(file_listing(spark, sf_dir)).where(number % 7 < 5).select(
        F.lit("earlier").alias("batch_id"), "entry", "payload", status.alias("status"),
        F.lit(None).cast("string").alias("reason"))


def lap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``payload`` and ``content``: one lap file per fifty events, with all kinds of names."""
    e = events(spark, sf_dir).withColumn("block", F.floor(F.col("event_id") / 50))
    kind, number = F.col("block") % 6, F.col("block").cast("string")
    name = F.when(F.col("block") == 3, "late/ride.tcx").otherwise(F.concat(
        _case(kind, {0: "", 1: "_", 2: "ride[", 3: "."}, "f"), number,
        _case(kind, {0: ".tcx", 1: ".tcx.gz", 2: "].tcx", 3: ".tcx", 4: "/ride.tcx"}, ".tcx.gz")))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    point = F.concat(
        F.lit("<Trackpoint><Time>"), iso, F.lit("</Time><Cadence>"), F.col("k").cast("string"),
        F.lit("</Cadence><DistanceMeters>"), F.col("value").cast("string"),
        F.lit("</DistanceMeters></Trackpoint>"))
    laps = e.select("block", name.alias("payload"), iso.alias("iso"), point.alias("point")).groupBy(
        "block", "payload").agg(
        F.min("iso").alias("first"), F.array_join(F.collect_list("point"), "").alias("points"))
    end = F.when(F.col("block") % 9 == 8, F.lit("")).otherwise("</TrainingCenterDatabase>")
    return laps.select("payload", F.encode(F.concat(
        F.lit("<TrainingCenterDatabase><Activities><Activity Sport='Biking'><Id>x</Id>"
              "<Lap StartTime='"), F.col("first"), F.lit("'><Track>"), F.col("points"),
        F.lit("</Track></Lap><Creator><Name>Peloton</Name></Creator></Activity></Activities>"),
        end), "UTF-8").alias("content"))


def write_files(files: DataFrame, root: str, folders: list[str] = []) -> None:
    """Write each row's ``content`` below ``root``, zipped if ``payload`` says so; also empty
    ``folders``."""
    def write(batches):
        store, top = fs.FileSystem.from_uri(listing.uri_of(root))
        for batch in batches:
            for payload, content in zip(*(c.to_pylist() for c in batch.columns)):
                store.create_dir(f"{top}/{payload}".rpartition("/")[0], recursive=True)
                data = gzip.compress(content) if payload.endswith(".gz") else content
                with store.open_output_stream(f"{top}/{payload}", compression=None) as out:
                    out.write(data)
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["payload"])

    files.mapInArrow(write, "payload string").count()
    for folder in folders:
        store, top = fs.FileSystem.from_uri(listing.uri_of(root))
        store.create_dir(f"{top}/{folder}", recursive=True)


def xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML lap file per event; some with blanks in front, without a lap, or cut off."""
    k, value = F.col("k"), F.col("value")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    later = F.date_format(F.col("ts") + F.expr("INTERVAL 2 SECONDS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def text(*parts) -> Column:
        return F.concat(*[
            p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    def point(time: Column, cadence: Column, hr: Column) -> Column:
        return text(
            "<Trackpoint><Time>", time, "</Time><DistanceMeters>", value,
            "</DistanceMeters><HeartRateBpm><Value>", hr, "</Value></HeartRateBpm><Cadence>",
            cadence, '</Cadence><Extensions><TPX xmlns="urn:extension"><Speed>', value / 10.0,
            "</Speed><Watts>", k, "</Watts></TPX></Extensions></Trackpoint>")

    lap = text(
        '<Lap StartTime="', iso, '"><TotalTimeSeconds>', value, "</TotalTimeSeconds><Calories>",
        k, "</Calories><AverageHeartRateBpm><Value>", k, "</Value></AverageHeartRateBpm><Track>",
        point(iso, value, k), point(later, F.lit(0.0), k + 60.5), "</Track>"
        '<Extensions><TPX xmlns="urn:extension"><TotalPower>', k * 1000.5,
        "</TotalPower></TPX></Extensions></Lap>")
    doc = text(
        F.when(k % 2 == 1, F.lit("   \n ")).otherwise(F.lit("")),
        '<?xml version="1.0"?><TrainingCenterDatabase xmlns="urn:training"><Activities>'
        '<Activity Sport="Biking"><Id>', iso, "</Id>",
        F.when(k % 13 != 0, lap).otherwise(F.lit("")),
        "<Creator><Name>",
        F.when(k % 3 == 0, F.lit("Other Bike")).otherwise(F.lit("Peloton Bike+")),
        "</Name></Creator></Activity></Activities>",
        F.when(k % 17 != 0, F.lit("</TrainingCenterDatabase>")).otherwise(F.lit("")))
    # Stands for a folder of files, which would be read by all cores.
    spread = events(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "event_id")
    return spread.select(
        F.concat(F.col("event_id").cast("string"), F.lit(".tcx")).alias("payload"),
        F.encode(doc, "UTF-8").alias("content"))
