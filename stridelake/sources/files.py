"""Scans of JSON, Parquet and CSV inputs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stridelake import schemas


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a file, folder or glob) matches anything on its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def read_activities(
    spark: SparkSession, path: str, athlete_id: int | None = 0, multi_line: bool = True
) -> DataFrame:
    """Activity records, one JSON object per file, or per line without ``multi_line``.

    The records carry no athlete; ``athlete_id`` names the one they belong to, and ``None`` keeps
    an ``athlete_id`` field that is present in the files.
    """
    df = spark.read.schema(schemas.ACTIVITY).option("multiLine", multi_line).json(path)
    if athlete_id is not None:
        df = df.withColumn("athlete_id", F.lit(athlete_id).cast("long"))
    return df


def read_texts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``text`` and ``file``: JSON records as they are written, one per file, or per line without
    ``multi_line``; for :mod:`operators.rules`."""
    return spark.read.text(path, wholetext=multi_line).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"))


def read_activity_table(spark: SparkSession, path: str) -> DataFrame:
    """Activity records after compaction to Parquet, where filters and columns are pushed down."""
    return spark.read.schema(schemas.ACTIVITY).parquet(path)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TRACK_POINT).parquet(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array file as one row per element, with its position in the file as ``entry``."""
    return (
        spark.read.schema(schema).option("multiLine", True).json(path)
        .withColumn("entry", F.monotonically_increasing_id())
    )


def read_activity_index(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """The activity index CSV: the five used columns plus ``position``, the order of its rows.

    A missing file gives an empty index, so that names degrade to null instead of failing the run.
    A header may lack a used column, which is then null, or repeat it; then the last one counts.
    """
    columns = schemas.ACTIVITY_INDEX
    if missing_ok and not path_exists(spark, path):
        empty = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return spark.createDataFrame([], empty.add("position", index_position_type()))
    df = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )

    def used(name: str) -> Column:
        # The reader numbers repeated names: "Elapsed Time5", "Elapsed Time16".
        found = [c for c in df.columns if re.fullmatch(re.escape(name) + r"\d*", c)]
        return (F.col(f"`{found[-1]}`") if found else F.lit(None).cast("string")).alias(name)

    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select(*map(used, columns), position.alias("position"))


def index_position_type() -> T.StructType:
    return T.StructType([
        T.StructField("file", T.StringType()), T.StructField("row", T.LongType())])
