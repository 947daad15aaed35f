"""Small builders for literal activities."""

from __future__ import annotations

from datetime import datetime, timezone

from stridelake import schemas


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def activity(id, start, source="peloton", **fields):
    row = {f.name: None for f in schemas.ACTIVITY}
    row.update(
        athlete_id=0, id=str(id), source="strava", original_source=source, activity_type="ride",
        name=f"Ride {id}", start_time=utc(start) if isinstance(start, str) else start,
        elapsed_time_s=600.0, raw_file_reference=f"{id}.fit.gz")
    for name in ("distance_m", "average_speed_mps", "elevation_gain_m", "average_cadence"):
        if name in fields:
            block = row["endurance_metrics"] or {f.name: None for f in schemas.ENDURANCE}
            row["endurance_metrics"] = {**block, name: fields.pop(name)}
    if "kj" in fields:
        row["class_metrics"] = {
            "instructor": None, "class_title": None, "class_type": None,
            "output_kj": fields.pop("kj")}
    row.update(fields)
    return row


def activities(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ACTIVITY)


STRENGTH = (
    "athlete_id bigint, position bigint, start timestamp, date date, name string, "
    "minutes double, logged_minutes double, trainer_led boolean")


def strength(spark, *rows):
    """Rows of ``(start, minutes, trainer_led)``."""
    data = []
    for position, (start, minutes, trainer_led) in enumerate(rows):
        at = utc(start) if isinstance(start, str) else start
        data.append((0, position, at, at.date(), f"Session {position}", minutes, None, trainer_led))
    return spark.createDataFrame(data, STRENGTH)


def records(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
