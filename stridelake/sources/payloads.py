"""Raw payloads: XML lap files and decoded device messages.

Both formats end in the same two tables. ``files`` has one row per payload (``payload``,
``file_id``, ``session``, ``has_position``, ``error``), ``records`` has one row per sample
(``payload`` and a ``record`` struct). Samples stay rows throughout: no file's samples are ever
gathered into one array or one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stridelake import schemas
from stridelake.functions import numeric as N, text as X, times
from stridelake.session import materialize
from stridelake.sources import lapfiles

MESSAGE_BUCKETS = 256


class RawPayloads(NamedTuple):
    files: DataFrame
    records: DataFrame


class LapFiles(NamedTuple):
    """XML lap files and their samples, both read back from one stored table."""

    files: DataFrame
    points: DataFrame


def _stored(rows: DataFrame) -> LapFiles:
    # Parsing is the expensive step and both outputs need it, so its result is written once; a
    # filter on it can then not repeat the parse.
    kept = materialize(rows, "laps")
    return LapFiles(kept.where("is_file").drop("is_file"), kept.where("NOT is_file"))


def parse_tcx(files: DataFrame) -> LapFiles:
    """Parse XML lap files given as ``payload`` and ``content``; a broken one has an ``error`` and
    no samples. Only the first activity and its first lap count."""
    return _stored(lapfiles.parse_contents(files))


def read_tcx(payloads: DataFrame, root: str) -> LapFiles:
    """:func:`parse_tcx` of the files below ``root`` that the column ``payload`` names."""
    return _stored(lapfiles.parse_stored(payloads, root))


def tcx_points(points: DataFrame) -> DataFrame:
    """One row per sample, in the common record shape.

    Heart rate 0 means that no strap was worn and becomes null; cadence 0 is coasting and stays.
    """
    record = _shape(schemas.RECORD, {
        "timestamp": times.parse_iso_utc(F.col("time")),
        "heart_rate": N.round_to_int(N.zero_to_null(F.col("hr"))),
        "cadence": N.round_to_int(F.col("cadence")),
        "speed": F.col("speed"),
        "distance": F.col("distance"),
        "power": F.col("watts"),
    })
    return points.select("payload", record.alias("record"))


def tcx_to_raw(parsed: LapFiles) -> RawPayloads:
    """Bring parsed XML lap files into the common raw shape.

    Moving time and distance are not carried over; total power is in joules. An XML file never
    holds positions.
    """
    creator = F.coalesce(F.col("creator"), F.lit(""))
    file_id = _shape(schemas.FILE_ID, {
        "manufacturer": F.when(F.lower(creator).contains(X.CLASS_SOURCE), F.lit(X.CLASS_SOURCE))
        .otherwise(creator),
    })
    session = _shape(schemas.SESSION, {
        "sport": F.col("sport"),
        "sub_sport": F.col("sport"),
        "start_time": times.parse_iso_utc(F.col("start")),
        "total_elapsed_time": F.col("total_time"),
        "total_calories": F.col("calories"),
        "avg_heart_rate": N.zero_to_null(F.col("average_hr")),
        "max_heart_rate": N.zero_to_null(F.col("max_hr")),
        "total_work": N.j_to_kj(F.col("total_power")),
    })
    files = parsed.files.select(
        "payload", file_id.alias("file_id"), session.alias("session"),
        F.lit(False).alias("has_position"), "error",
    )
    return RawPayloads(files, tcx_points(parsed.points))


def _bucket(payload: Column) -> Column:
    return F.pmod(F.xxhash64(payload), F.lit(MESSAGE_BUCKETS)).cast("int")


def write_messages(messages: DataFrame, path: str) -> None:
    """Add decoded messages to a table whose folders hold those of a share of the payloads."""
    (messages.withColumn("bucket", _bucket(F.col("payload")))
     .hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket").parquet(path))


def read_messages(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The messages of the payloads in ``wanted``; of a table made by :func:`write_messages` only
    the folders that may hold some are read."""
    messages = spark.read.schema(schemas.MESSAGE).parquet(path)
    if "bucket" in messages.columns:
        buckets = wanted.select(_bucket(F.col("payload")).alias("bucket")).distinct().collect()
        messages = messages.where(F.col("bucket").isin([r.bucket for r in buckets])).drop("bucket")
    return messages.join(wanted.select("payload"), "payload", "left_semi")


def collapse_messages(messages: DataFrame) -> RawPayloads:
    """Collapse decoded messages (``schemas.MESSAGE``) to the common raw shape.

    Field by field, the last message that carries a value wins. Samples, which are nearly all
    messages, only answer whether there is a position; they shrink to one row per payload before
    the summary messages join them. Everything is a mergeable aggregate, so a payload with a third
    of all messages is reduced before the shuffle.
    """
    is_sample = F.col("msg_type") == "record"
    records = messages.where(is_sample).select("payload", "record")
    positions = records.groupBy("payload").agg(has_position("record").alias("has_position"))
    files = (
        messages.where(~is_sample).select("payload", "seq", "file_id", "session")
        .unionByName(positions, allowMissingColumns=True)
        .groupBy("payload")
        .agg(
            _latest_fields("file_id", schemas.FILE_ID),
            _latest_fields("session", schemas.SESSION),
            F.coalesce(F.bool_or("has_position"), F.lit(False)).alias("has_position"),
        )
        .withColumn("error", F.lit(None).cast("string"))
    )
    return RawPayloads(files, records)


def has_position(record: str) -> Column:
    """Aggregate: whether any sample carries a position."""
    lat, lon = F.col(f"{record}.position_lat"), F.col(f"{record}.position_long")
    return F.coalesce(F.bool_or(lat.isNotNull() & lon.isNotNull()), F.lit(False))


def union_raw(*parts: RawPayloads) -> RawPayloads:
    """Union of payloads of several formats; all share one schema."""
    files, records = parts[0]
    for part in parts[1:]:
        files = files.unionByName(part.files)
        records = records.unionByName(part.records)
    return RawPayloads(files, records)


def _shape(schema, values: dict[str, Column]) -> Column:
    return F.struct(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def _latest_fields(message: str, schema) -> Column:
    def latest(name: str) -> Column:
        value = F.col(f"{message}.{name}")
        return F.max_by(value, F.when(value.isNotNull(), F.col("seq"))).alias(name)

    return F.struct(*[latest(f.name) for f in schema]).alias(message)
