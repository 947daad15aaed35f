"""Payload discovery and triage of input entries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stridelake.functions import text as X
from stridelake.session import materialize

PARSE, SKIPPED, FAILED, SUCCEEDED = "parse", "skipped", "failed", "succeeded"

# Reasons shown in summaries.
EMPTY_FOLDER = "folder holds no supported payload"
UNSUPPORTED = "unsupported file type"
NO_PAYLOAD = "no supported payload found in this entry"  # fixed value
PLACEHOLDER = ".gitkeep"  # fixed value: never a candidate

LISTED = "path string, length long, modified timestamp"
_LEVEL = f"{LISTED}, deeper boolean"


def list_tree(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """``path``, ``length`` and ``modified`` of everything below ``root``, relative to it, or of
    what is in ``folders`` (their ``path``, ending in a slash).

    Folders end in a slash; file contents are not read. Names may begin with ``_`` or a dot, which
    a Spark scan would hide. Level by level the folders are dealt to tasks, which list them and
    write what they find to the shared folder, so no name passes the driver, and a lost executor
    costs the folders it was listing. ``root`` is a path or URI that :mod:`pyarrow.fs` opens.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(uri_of(root))
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(f"{top}/{folder}", allow_not_found=True))
                is_folder = [info.type == fs.FileType.Directory for info in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array([folder + info.base_name + "/" * deep
                              for info, deep in zip(found, is_folder)], pa.string()),
                    pa.array([None if deep else info.size
                              for info, deep in zip(found, is_folder)], pa.int64()),
                    pa.array([None if deep else info.mtime
                              for info, deep in zip(found, is_folder)], pa.timestamp("us", "UTC")),
                    pa.array(is_folder, pa.bool_())],
                    names=["path", "length", "modified", "deeper"])

    todo = spark.createDataFrame([("",)], "path string") if folders is None else folders
    levels = []
    while not levels or not todo.isEmpty():
        dealt = todo.repartition(spark.sparkContext.defaultParallelism, "path")
        levels.append(materialize(dealt.mapInArrow(listed, _LEVEL), "listed"))
        todo = levels[-1].where("deeper").select("path")
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.drop("deeper")


def qualified_folder(spark: SparkSession, root: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/") + "/"


def relative_path(spark: SparkSession, root: str) -> Column:
    """The scan's ``path`` column without the folder ``root``."""
    return F.substring("path", len(qualified_folder(spark, root)) + 1, 1 << 30)


def uri_of(root: str) -> str:
    """``root`` as pyarrow takes it: a URI, or an absolute path."""
    if root.startswith("file:"):
        return root.removeprefix("file:").replace("///", "/", 1).rstrip("/")
    return root.rstrip("/")


def triage_entries(
    listing: DataFrame,
    supported: tuple[str, ...] = X.SUPPORTED_SUFFIXES,
    unsupported: tuple[str, ...] = X.UNSUPPORTED_SUFFIXES,
) -> DataFrame:
    """``entry``, ``payload``, ``status``, ``reason`` per top-level entry, and the payload's
    ``length`` and ``modified``.

    An entry is a file, or a folder whose alphabetically first supported file is the payload
    (``payload`` is its path relative to the root, like ``entry``).
    ``listing`` holds relative paths; a path that ends in a slash is a folder. It may lack
    ``length`` and ``modified``, which are then null.
    """
    for name, kind in (("length", "long"), ("modified", "timestamp")):
        if name not in listing.columns:
            listing = listing.withColumn(name, F.lit(None).cast(kind))
    path = F.col("path")
    usable = F.when(X.has_suffix(path, supported), F.struct(
        F.split(path, "/").alias("parts"), "length", "modified"))
    entries = (
        listing.withColumn("entry", F.substring_index(path, "/", 1))
        .where(F.col("entry") != PLACEHOLDER)
        .groupBy("entry")
        .agg(
            F.bool_or(path.contains("/")).alias("is_folder"),
            F.min(usable).alias("first"),
        )
        .withColumn("payload", F.array_join("first.parts", "/"))
    )
    skip = (
        F.when(F.col("is_folder") & F.col("payload").isNull(), F.lit(EMPTY_FOLDER))
        .when(~F.col("is_folder") & X.has_suffix(F.col("entry"), unsupported), F.lit(UNSUPPORTED))
    )
    return entries.withColumn("skip", skip).select(
        "entry",
        "payload",
        F.when(F.col("skip").isNotNull(), F.lit(SKIPPED))
        .when(F.col("payload").isNull(), F.lit(FAILED))
        .otherwise(F.lit(PARSE)).alias("status"),
        F.when(F.col("skip").isNotNull(), F.col("skip"))
        .when(F.col("payload").isNull(), F.lit(NO_PAYLOAD)).alias("reason"),
        F.col("first.length").alias("length"),
        F.col("first.modified").alias("modified"),
    )
