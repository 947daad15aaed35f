"""Parquet tables that grow by whole versions.

A version is a folder of rows that is never changed once it is written. Which versions count is said
by the newest commit, a small file that is put in place last by a rename. So a writer that dies leaves
the table as it was, whatever it had written, and running it again gives the same table: a version
belongs to a named batch, and a batch that is stored again takes the place of its earlier version.

A :class:`Table` has one row per key. Of several rows with a key, within a batch or over many, the
one that comes last in an explicit order counts; when they were stored does not matter. That is
settled on reading, for the keys that came since the table was last compacted only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stridelake.functions import text as X

BASE = ""  # the batch that a compaction leaves


def activity_partitions() -> dict[str, Column]:
    """A handful of values a year, whatever sources there are."""
    return {
        "part_class": F.when(X.is_class(F.col("original_source")), "class").otherwise("other"),
        "part_year": F.coalesce(F.year("start_time"), F.lit(0)),
    }


def track_partitions() -> dict[str, Column]:
    return {"track_year": F.coalesce(F.year("timestamp"), F.lit(0))}


def write_partitioned(df: DataFrame, path: str, partition_by: dict[str, Column]) -> None:
    """Write rows in few files per partition; a large partition is written by many tasks."""
    parts = list(partition_by)
    rows = df.withColumns(partition_by)
    if parts:
        rows = rows.hint("rebalance", *[F.col(p) for p in parts])
    rows.write.mode("overwrite").partitionBy(*parts).parquet(path)


def compact(df: DataFrame, path: str, partition_by: dict[str, Column]) -> None:
    """Write many small records as a partitioned table of ordinary file sizes."""
    write_partitioned(df, path, partition_by)


class Versions:
    """The commits of one table: which folder holds the rows of which batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop, self.conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self.fs = self.hadoop.Path(self.path).getFileSystem(self.conf)

    def _commits(self) -> list[str]:
        folder = self.hadoop.Path(f"{self.path}/commits")
        if not self.fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self.fs.listStatus(folder)]
        return sorted(name for name in names if name.endswith(".json"))

    def live(self) -> dict[str, str]:
        """Folder of each batch that counts, in the order in which they were stored."""
        commits = self._commits()
        if not commits:
            return {}
        source = self.fs.open(self.hadoop.Path(f"{self.path}/commits/{commits[-1]}"))
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def next_number(self) -> int:
        """The number of the next commit."""
        commits = self._commits()
        return int(commits[-1].removesuffix(".json")) + 1 if commits else 0

    def fresh_folder(self) -> str:
        return f"{self.path}/data/{uuid.uuid4().hex}"

    def commit(self, live: dict[str, str]) -> None:
        """Make ``live`` the state of the table. Fails if another writer was faster."""
        number = self.next_number()
        hidden = self.hadoop.Path(f"{self.path}/commits/.{uuid.uuid4().hex}")
        out = self.fs.create(hidden)
        try:
            out.write(bytearray(json.dumps(live).encode()))
        finally:
            out.close()
        self._put_in_place(hidden, self.hadoop.Path(f"{self.path}/commits/{number:012}.json"))

    def _put_in_place(self, hidden: JavaObject, target: JavaObject) -> None:
        options = self.hadoop.Options.Rename
        self.hadoop.FileContext.getFileContext(hidden.toUri(), self.conf).rename(
            hidden, target, self.spark.sparkContext._gateway.new_array(options, 0))

    def store(self, rows: DataFrame, batch: str, partition_by: dict[str, Column]) -> None:
        """Write ``rows`` as the version of ``batch``."""
        folder = self.fresh_folder()
        write_partitioned(rows, folder, partition_by)
        self.commit({b: f for b, f in self.live().items() if b != batch} | {batch: folder})

    def vacuum(self) -> None:
        """Remove the folders and commits that no longer count. Only when nobody reads them."""
        live, commits = set(self.live().values()), self._commits()
        for name in commits[:-1]:
            self.fs.delete(self.hadoop.Path(f"{self.path}/commits/{name}"), False)
        data = self.hadoop.Path(f"{self.path}/data")
        if self.fs.exists(data):
            for status in self.fs.listStatus(data):
                if status.getPath().getName() not in {f.rpartition("/")[2] for f in live}:
                    self.fs.delete(status.getPath(), True)


@dataclass(frozen=True)
class Log:
    """A table that only grows: all rows of all batches."""

    path: str
    schema: StructType

    def read(self, spark: SparkSession) -> DataFrame:
        return read_folders(spark, self.schema, list(Versions(spark, self.path).live().values()))

    def batches(self, spark: SparkSession) -> set[str]:
        """The batches that are stored and not compacted yet."""
        return set(Versions(spark, self.path).live()) - {BASE}

    def store(self, rows: DataFrame, batch: str) -> None:
        Versions(rows.sparkSession, self.path).store(_typed(rows, self.schema), batch, {})

    def compact(self, spark: SparkSession) -> None:
        """Put all versions into one. Batches stored so far can no longer be replaced."""
        versions = Versions(spark, self.path)
        folder = versions.fresh_folder()
        write_partitioned(self.read(spark), folder, {})
        versions.commit({BASE: folder})


@dataclass(frozen=True)
class Table:
    """One row per ``key``: the last by the columns ``order``, nulls first."""

    path: str
    schema: StructType
    key: str
    order: tuple[str, ...]
    partition_by: dict[str, Column]

    def _last(self, rows: DataFrame) -> DataFrame:
        # Rows alike in key and order are told apart by all they hold, so no repeat can change it.
        columns = [F.col(f.name) for f in self.schema]
        digest = F.xxhash64(*[F.to_json(F.struct(c)) for c in columns])
        last = F.max_by(F.struct(*columns), F.struct(*self.order, digest))
        return rows.groupBy(F.col(self.key).alias("_key")).agg(last.alias("_row")).select("_row.*")

    def all_rows(self, spark: SparkSession) -> DataFrame:
        """What is stored, with the rows that no longer count."""
        return read_folders(spark, self.schema, list(Versions(spark, self.path).live().values()))

    def read(self, spark: SparkSession) -> DataFrame:
        live = Versions(spark, self.path).live()
        base = read_folders(spark, self.schema, [live[BASE]] if BASE in live else [])
        fresh = read_folders(spark, self.schema, [f for b, f in live.items() if b != BASE])
        if set(live) <= {BASE}:
            return base
        if BASE not in live:
            return self._last(fresh)
        keys = fresh.select(F.col(self.key).alias("_key")).distinct()
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        return base.join(keys, same, "left_anti").unionByName(
            self._last(base.join(keys, same, "left_semi").unionByName(fresh)))

    def store(self, rows: DataFrame, batch: str) -> None:
        """Add ``rows``. Storing the same batch again replaces what it brought before."""
        Versions(rows.sparkSession, self.path).store(
            self._last(_typed(rows, self.schema)), batch, self.partition_by)

    def compact(self, spark: SparkSession) -> None:
        """Write the last rows of all keys as one version, which later reads need not settle.

        Batches stored so far can no longer be replaced, but their rows still are, by order.
        """
        versions = Versions(spark, self.path)
        folder = versions.fresh_folder()
        write_partitioned(self.read(spark), folder, self.partition_by)
        versions.commit({BASE: folder})


@dataclass(frozen=True)
class Details:
    """Rows that belong to a row of another table: many per key of ``owner``.

    They carry the key (as ``key``) and the order of the owner's row, and count only while that row
    is the last of its key. So a key that comes back takes its old details away, also if it has no
    new ones, and nothing is rewritten for it.
    """

    path: str
    schema: StructType
    key: str
    owner: Table
    partition_by: dict[str, Column]

    def read(self, spark: SparkSession) -> DataFrame:
        rows = read_folders(spark, self.schema, list(Versions(spark, self.path).live().values()))
        owners = self.owner.read(spark).select(
            F.col(self.owner.key).alias("_key"),
            *[F.col(c).alias(f"_{c}") for c in self.owner.order])
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        for c in self.owner.order:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        return rows.join(owners, same, "left_semi")

    def store(self, rows: DataFrame, batch: str) -> None:
        Versions(rows.sparkSession, self.path).store(
            _typed(rows, self.schema), batch, self.partition_by)

    def compact(self, spark: SparkSession) -> None:
        """Keep only what counts, as one version."""
        versions = Versions(spark, self.path)
        folder = versions.fresh_folder()
        write_partitioned(self.read(spark), folder, self.partition_by)
        versions.commit({BASE: folder})


def _typed(rows: DataFrame, schema: StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_folders(spark: SparkSession, schema: StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
