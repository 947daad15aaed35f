"""Explicit schemas. Nothing is inferred: all-null columns would come back as strings."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
TS, DATE, BIN = T.TimestampType(), T.DateType(), T.BinaryType()

ENDURANCE = _struct(
    distance_m=D, average_speed_mps=D, max_speed_mps=D, elevation_gain_m=D,
    average_cadence=D, average_power_w=D, max_power_w=D, gps_track_available=B,
)
STRENGTH = _struct(exercises=T.ArrayType(S))
CLASS = _struct(instructor=S, class_title=S, class_type=S, output_kj=D)

ACTIVITY = _struct(
    athlete_id=L, id=S, source=S, original_source=S, activity_type=S, name=S,
    start_time=TS, timezone=S, elapsed_time_s=D, moving_time_s=D, calories=D,
    average_heart_rate=D, max_heart_rate=D, device_name=S,
    endurance_metrics=ENDURANCE, strength_metrics=STRENGTH, class_metrics=CLASS,
    raw_file_reference=S, ingested_at=TS,
)

TRACK_POINT = _struct(
    activity_id=S, timestamp=TS, lat=D, lon=D, altitude_m=D, heart_rate=I, cadence=I,
    speed_mps=D, distance_m=D, power_w=D,
)

FILE_ID = _struct(manufacturer=S, garmin_product=S, product=S)
SESSION = _struct(
    sport=S, sub_sport=S, start_time=TS, total_elapsed_time=D, total_timer_time=D,
    total_calories=D, avg_heart_rate=D, max_heart_rate=D, total_distance=D, avg_speed=D,
    max_speed=D, total_ascent=D, avg_cadence=D, avg_power=D, max_power=D, total_work=D,
)
RECORD = _struct(
    timestamp=TS, position_lat=L, position_long=L, altitude=D, enhanced_altitude=D,
    heart_rate=I, cadence=I, speed=D, enhanced_speed=D, distance=D, power=D,
)
# One row per decoded message; exactly one of the three structs is set, by msg_type.
MESSAGE = _struct(
    payload=S, msg_type=S, seq=L, file_id=FILE_ID, session=SESSION, record=RECORD,
)

# One row per XML lap file (is_file) and one per sample of its first lap.
LAP_ROW = _struct(
    payload=S, is_file=B, error=S, sport=S, creator=S, start=S, total_time=D, calories=D,
    average_hr=D, max_hr=D, total_power=D,
    time=S, distance=D, cadence=D, hr=D, speed=D, watts=D,
)

ACTIVITY_INDEX = ["Filename", "Activity Name", "Activity Type", "Activity Date", "Elapsed Time"]

WEIGHT_STREAM = T.StructType([T.StructField("Data Points", T.ArrayType(_struct(
    originDataSourceId=S, startTimeNanos=S,
    fitValue=T.ArrayType(_struct(value=_struct(fpVal=D))))))])
WEIGHT = _struct(
    id=S, source=S, original_source=S, recorded_at=TS, weight_kg=D, weight_lb=D, ingested_at=TS,
)
LIFE_EVENT = _struct(
    id=S, date=DATE, date_end=DATE, date_precision=S, ongoing=B, category=S, title=S,
    description=S, tags=T.ArrayType(S), related_event_ids=T.ArrayType(S),
)

OUTCOME = _struct(
    batch_id=S, entry=S, payload=S, status=S, reason=S, length=L, modified=TS,
)
# Stored rows also say which entry they come from, and when it was changed last.
ORIGIN = ("entry", "modified")
STORED_ACTIVITY = T.StructType([*ACTIVITY, T.StructField("entry", S), T.StructField("modified", TS)])
STORED_POINT = T.StructType(
    [*TRACK_POINT, T.StructField("entry", S), T.StructField("modified", TS)])
