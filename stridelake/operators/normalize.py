"""From raw payloads, weight streams and index rows to the standard tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stridelake import schemas
from stridelake.functions import numeric as N, text as X, times
from stridelake.operators import quality, rules

# Sports per metrics block and the sources of weight readings.
ENDURANCE_SPORTS = (
    "running", "cycling", "swimming", "hiking", "walking",
    "rowing", "nordic_skiing", "alpine_skiing", "elliptical",
)
STRENGTH_SPORTS = ("training", "strength_training")
CLASS_SPORTS = ("fitness_equipment", "cardio_training")
RECORD_SOURCE = "strava"
WEIGHT_SOURCE = "google_fit"
WEIGHT_ORIGINS = {
    "raw:com.google.weight:com.google.android.apps.fitness:user_input": "google_fit_manual_entry",
    "raw:com.google.weight:com.hevy:health_platform": "hevy",
}
STRENGTH_TYPE = "Weight Training"
REQUIRED_FIELDS = (
    "id", "source", "original_source", "activity_type", "start_time", "raw_file_reference")


def route_metrics(source: Column, sport: Column, session: str, has_position: Column) -> list[Column]:
    """The three metrics blocks, of which at most one is set.

    A class source always gives the class block, whatever the sport. Otherwise the sport decides,
    and an unlisted sport gives no block.
    """
    def field(name: str) -> Column:
        return F.col(f"{session}.{name}")

    lowered = F.lower(sport)
    is_class = X.is_class(source) | lowered.isin(*CLASS_SPORTS)
    is_endurance = ~X.is_class(source) & lowered.isin(*ENDURANCE_SPORTS)
    is_strength = ~X.is_class(source) & lowered.isin(*STRENGTH_SPORTS)
    endurance = F.struct(
        field("total_distance").alias("distance_m"),
        field("avg_speed").alias("average_speed_mps"),
        field("max_speed").alias("max_speed_mps"),
        field("total_ascent").alias("elevation_gain_m"),
        field("avg_cadence").alias("average_cadence"),
        field("avg_power").alias("average_power_w"),
        field("max_power").alias("max_power_w"),
        has_position.alias("gps_track_available"),
    )
    strength = F.struct(F.array().cast("array<string>").alias("exercises"))
    in_class = F.struct(
        F.lit(None).cast("string").alias("instructor"),
        F.lit(None).cast("string").alias("class_title"),
        field("sub_sport").alias("class_type"),
        field("total_work").alias("output_kj"),
    )
    return [
        F.when(is_endurance, endurance).alias("endurance_metrics"),
        F.when(is_strength, strength).alias("strength_metrics"),
        F.when(is_class, in_class).alias("class_metrics"),
    ]


def to_activity(raw: DataFrame, athlete_id: Column | None = None) -> DataFrame:
    """Standard activities from ``entry``, ``payload``, ``file_id``, ``session``,
    ``has_position``. Further columns of ``raw`` are kept behind the standard ones."""
    source = X.source_from_manufacturer(F.col("file_id.manufacturer"))
    sport = F.coalesce(F.col("session.sport"), F.lit("unknown"))
    session = F.col("session")
    columns = [
        (F.lit(0) if athlete_id is None else athlete_id).cast("long").alias("athlete_id"),
        X.activity_id_from_entry(F.col("entry")).alias("id"),
        F.lit(RECORD_SOURCE).alias("source"),
        source.alias("original_source"),
        sport.alias("activity_type"),
        F.lit(None).cast("string").alias("name"),
        session["start_time"].alias("start_time"),
        F.lit(None).cast("string").alias("timezone"),
        session["total_elapsed_time"].alias("elapsed_time_s"),
        session["total_timer_time"].alias("moving_time_s"),
        session["total_calories"].alias("calories"),
        session["avg_heart_rate"].alias("average_heart_rate"),
        session["max_heart_rate"].alias("max_heart_rate"),
        X.device_name(F.col("file_id.garmin_product"), F.col("file_id.product"))
        .alias("device_name"),
        *route_metrics(source, sport, "session", F.col("has_position")),
        X.basename(F.col("payload")).alias("raw_file_reference"),
        F.current_timestamp().alias("ingested_at"),
    ]
    return raw.select(*columns, *[c for c in raw.columns if c not in ("session", "file_id")])


def activity_spec() -> rules.Spec:
    """What a written activity record must look like."""
    written = T.StructType([f for f in schemas.ACTIVITY if f.name != "athlete_id"])
    positive = (0.0, None)
    return rules.Spec(
        written, required=REQUIRED_FIELDS,
        ranges={
            "elapsed_time_s": positive, "moving_time_s": positive, "calories": positive,
            "average_heart_rate": (0.0, 300.0), "max_heart_rate": (0.0, 300.0),
            "endurance_metrics.distance_m": positive, "class_metrics.output_kj": positive},
        enums={"source": (RECORD_SOURCE,)},
        exclusive=(("endurance_metrics", "strength_metrics", "class_metrics"),))


def activity_rules() -> list[quality.Rule]:
    return quality.required(*REQUIRED_FIELDS)


def to_track_points(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Track points from ``activity_id`` and ``record``, and the columns ``keep``. Points without a
    position are kept."""
    r = F.col("record")
    return records.select(
        "activity_id", *keep,
        r["timestamp"].alias("timestamp"),
        N.semicircles_to_degrees(r["position_lat"]).alias("lat"),
        N.semicircles_to_degrees(r["position_long"]).alias("lon"),
        N.first_non_null(r["enhanced_altitude"], r["altitude"]).alias("altitude_m"),
        r["heart_rate"].alias("heart_rate"),
        r["cadence"].alias("cadence"),
        N.first_non_null(r["enhanced_speed"], r["speed"]).alias("speed_mps"),
        r["distance"].alias("distance_m"),
        r["power"].alias("power_w"),
    )


def normalize_weight(
    raw: DataFrame, origins: dict[str, str] | None = None, strict: bool = False
) -> DataFrame:
    """Weight readings from datastream files, with ``violations`` for unknown origins and
    malformed start times.

    With ``strict`` an unknown origin fails the job. Pounds derive from the unrounded kilograms.
    """
    point = F.col("point")
    nanos = point["startTimeNanos"]
    kg = F.try_element_at(point["fitValue"], F.lit(1))["value"]["fpVal"]
    origin = X.map_enum(point["originDataSourceId"], origins or WEIGHT_ORIGINS, strict)
    readings = raw.select(F.explode("Data Points").alias("point")).select(
        nanos.alias("id"),
        F.lit(WEIGHT_SOURCE).alias("source"),
        origin.alias("original_source"),
        times.nanos_to_ts(nanos).alias("recorded_at"),
        N.round_half_even(kg, 2).alias("weight_kg"),
        N.round_half_even(N.kg_to_lb(kg), 1).alias("weight_lb"),
        F.current_timestamp().alias("ingested_at"),
    )
    rules = [
        ("unrecognized origin", F.col("original_source").isNotNull()),
        ("start time is no number", F.col("id").isNull() | F.col("recorded_at").isNotNull()),
    ]
    return quality.apply_rules(readings, rules)


def strength_sessions(index: DataFrame, since: date | str | None = None) -> DataFrame:
    """Strength sessions from the activity index.

    Trainer-led sessions are logged afterwards, so their length is assumed and the logged minutes
    are shown beside it. Without an ``athlete_id`` column everything belongs to athlete 0.
    """
    if "athlete_id" not in index.columns:
        index = index.withColumn("athlete_id", F.lit(0).cast("long"))
    start = times.parse_index_ts(F.col("Activity Date"))
    name = F.regexp_replace(
        X.ascii_only(F.coalesce(F.col("Activity Name"), F.lit(""))), r"\A\s+|\s+\z", "")
    elapsed = N.zero_to_null(F.col("Elapsed Time").try_cast("double"))
    sessions = (
        index.where(X.of_type(F.col("Activity Type"), STRENGTH_TYPE))
        .select(
            "athlete_id", "position", start.alias("start"), name.alias("name"),
            N.round_half_even(N.s_to_min(elapsed), 1).alias("logged"),
        )
        .where(F.col("start").isNotNull())
        .withColumn("trainer_led", X.name_matches(F.col("name"), X.TRAINER_LED))
    )
    if since is not None:
        sessions = sessions.where(times.since(F.col("start"), since))
    return sessions.select(
        "athlete_id", "position", "start", F.to_date("start").alias("date"), "name",
        X.assumed_minutes(F.col("trainer_led"), F.col("logged")).alias("minutes"),
        F.when(F.col("trainer_led"), F.col("logged")).alias("logged_minutes"),
        "trainer_led",
    )


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in order and type, extra ones dropped, missing ones null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema])


def conform_activity(df: DataFrame) -> DataFrame:
    return conform(df, schemas.ACTIVITY)
