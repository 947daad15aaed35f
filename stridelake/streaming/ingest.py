"""Resumable, idempotent ingest of payload files.

A ledger keeps the outcome of every entry with the fingerprint of its payload (name, length and time
of change). What succeeded or was skipped is done as long as its payload stays as it is; what failed
comes back with the next run. Of several records with one id the one of the last entry by name
counts, and of one entry the one changed last, whichever batch brought it. So it does not matter how
entries are dealt to batches, and a run that dies half-way is simply repeated.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from stridelake import schemas
from stridelake.functions import text as X
from stridelake.operators import lookup, normalize, quality
from stridelake.session import materialize
from stridelake.sinks import daily, tables
from stridelake.sources import files, listing, payloads

NOT_DECODED = "payload could not be decoded"
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
FINGERPRINT = ("entry", "payload", "length", "modified")


class IngestResult(NamedTuple):
    activities: DataFrame
    tracks: DataFrame
    outcomes: DataFrame


@dataclass(frozen=True)
class Store:
    """Where inputs are found and tables are kept."""

    inputs: str
    activities: str
    tracks: str
    ledger: str
    index: str = ""
    messages: str = ""
    checkpoint: str = ""
    daily: str = ""  # the daily table of states, if one is to be kept


    @property
    def activity_table(self) -> tables.Table:
        return tables.Table(
            self.activities, schemas.STORED_ACTIVITY, "id", schemas.ORIGIN,
            tables.activity_partitions())

    @property
    def track_table(self) -> tables.Details:
        return tables.Details(
            self.tracks, schemas.STORED_POINT, "activity_id", self.activity_table,
            tables.track_partitions())

    @property
    def daily_table(self) -> daily.DailyTable:
        return daily.DailyTable(self.daily)

    @property
    def ledger_table(self) -> tables.Log:
        return tables.Log(self.ledger, schemas.OUTCOME)


def batch_name(moment: datetime | None = None) -> str:
    return (moment or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def pending_entries(
    triaged: DataFrame, ledger: DataFrame, batch_size: int | None = None
) -> DataFrame:
    """Entries that are not done yet, or whose payload has changed; the first ``batch_size`` by
    name. Either side may lack parts of the fingerprint, which are then null."""
    def printed(df: DataFrame) -> DataFrame:
        for name, kind in (("length", "long"), ("modified", "timestamp")):
            if name not in df.columns:
                df = df.withColumn(name, F.lit(None).cast(kind))
        return df

    done = printed(ledger.where(F.col("status") != listing.FAILED)).select(
        *[F.col(c).alias(f"_{c}") for c in FINGERPRINT]).distinct()
    same = F.lit(True)
    for c in FINGERPRINT:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    pending = printed(triaged).join(done, same, "left_anti")
    return pending if batch_size is None else pending.orderBy("entry").limit(batch_size)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return tables.Log(path, schemas.OUTCOME).read(spark)


def ingest(
    triaged: DataFrame, raw: payloads.RawPayloads, names: DataFrame, batch_id: str
) -> IngestResult:
    """Activities, track points and the outcome of every entry of one batch.

    A bad entry is a row with a reason, never an exception, so it cannot harm the others.
    Activities and track points also have the ``entry`` they come from and when it was
    ``modified``.
    """
    todo = triaged.where(F.col("status") == listing.PARSE).select(*FINGERPRINT)
    titled = lookup.find_titles(todo, names, X.basename(F.col("payload")))
    found = titled.join(raw.files.withColumn("_found", F.lit(True)), "payload", "left")
    error = F.when(F.col("_found").isNull(), F.lit(NOT_DECODED)).otherwise(F.col("error"))
    mapped = normalize.to_activity(found.withColumn("error", error)).withColumn(
        "name", F.col("title"))
    checked = materialize(quality.apply_rules(mapped, normalize.activity_rules()), "checked")

    reason = F.coalesce(
        "error", F.nullif(F.array_join("violations", "; "), F.lit("")))
    outcomes = checked.select(
        *FINGERPRINT,
        F.when(reason.isNull(), F.lit(listing.SUCCEEDED)).otherwise(F.lit(listing.FAILED))
        .alias("status"),
        reason.alias("reason"),
    ).unionByName(
        triaged.where(F.col("status") != listing.PARSE)
        .select(*FINGERPRINT, "status", "reason"))
    # Several entries may have the same id, e.g. one ride in two formats. The last by name stays.
    valid = checked.where(reason.isNull())
    last = valid.groupBy("id").agg(F.max("entry").alias("entry"))
    good = valid.join(last, ["id", "entry"], "left_semi")
    records = raw.records.join(
        good.select("payload", F.col("id").alias("activity_id"), *schemas.ORIGIN), "payload")
    points = normalize.to_track_points(records, schemas.ORIGIN)
    return IngestResult(
        normalize.conform(good, schemas.STORED_ACTIVITY),
        normalize.conform(points, schemas.STORED_POINT),
        normalize.conform(outcomes.withColumn("batch_id", F.lit(batch_id)), schemas.OUTCOME),
    )


def store_result(result: IngestResult, store: Store, batch_id: str) -> None:
    """Track points first, then the activities that make them count, the daily table, and last the
    ledger, so that a run that dies in between is made again as a whole."""
    spark = result.activities.sparkSession
    store.track_table.store(result.tracks, batch_id)
    if store.daily:
        days = materialize(
            daily.replaced_days(store.activity_table.all_rows(spark), result.activities)
            .unionByName(store.daily_table.days_of(spark, batch_id)), "replaced-days")
        store.activity_table.store(result.activities, batch_id)
        if days.isEmpty():
            store.daily_table.add(result.activities, batch_id)
        else:
            store.daily_table.renew(
                store.activity_table.read(spark),
                days.unionByName(result.activities.select(F.to_date("start_time").alias("day"))),
                batch_id)
    else:
        store.activity_table.store(result.activities, batch_id)
    store.ledger_table.store(result.outcomes, batch_id)


def read_activities(spark: SparkSession, store: Store) -> DataFrame:
    return normalize.conform_activity(store.activity_table.read(spark))


def read_tracks(spark: SparkSession, store: Store) -> DataFrame:
    return normalize.conform(store.track_table.read(spark), schemas.TRACK_POINT)


def _raw(spark: SparkSession, store: Store, todo: DataFrame) -> payloads.RawPayloads:
    """Raw payloads of the entries in ``todo``: XML files opened by name, device files from the
    table of decoded messages."""
    wanted = todo.where(F.col("status") == listing.PARSE).select("payload")
    xml = wanted.where(X.has_suffix(F.col("payload"), X.TCX_SUFFIXES))
    raw = payloads.tcx_to_raw(payloads.read_tcx(xml, store.inputs))
    if not store.messages:
        return raw
    messages = payloads.read_messages(spark, store.messages, wanted)
    return payloads.union_raw(payloads.collapse_messages(messages), raw)


def _names(spark: SparkSession, store: Store) -> DataFrame:
    return lookup.dedupe_lookup(files.read_activity_index(spark, store.index or "missing.csv"))


def _run(spark: SparkSession, store: Store, todo: DataFrame, batch_id: str) -> IngestResult:
    todo = materialize(todo, "todo")
    result = ingest(todo, _raw(spark, store, todo), _names(spark, store), batch_id)
    store_result(result, store, batch_id)
    return result


def run_batch(
    spark: SparkSession, store: Store, batch_size: int | None = None, batch_id: str | None = None
) -> DataFrame:
    """One resumable batch over the input folder; returns its summary.

    Only the files of this batch are opened. A batch that died may be run again under its name; the
    name of one that ended is taken.
    """
    taken = store.ledger_table.batches(spark)
    name = batch_id or batch_name()
    while name in taken:
        if batch_id:
            raise ValueError(f"there is a batch {batch_id} already")
        name += "_"
    triaged = listing.triage_entries(listing.list_tree(spark, store.inputs))
    todo = pending_entries(triaged, read_ledger(spark, store.ledger), batch_size)
    return quality.batch_summary(_run(spark, store, todo, name).outcomes)


def run_available_now(spark: SparkSession, store: Store, max_files: int = 10_000) -> None:
    """Ingest what belongs to the files that arrived since the last run, then stop.

    The stream only says which entries to look at; what an entry holds is read from its folder, and
    the ledger says whether it is done. So the tables do not depend on how many files a micro-batch
    takes. Checkpoint and batch number name the batch, so a repeated micro-batch replaces what it
    stored. A stream never sees a file twice: retries of failed entries are what
    :func:`run_batch` is for.
    """
    stream = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
        .load(store.inputs)
        .select(listing.relative_path(spark, store.inputs).alias("path"), "length",
                F.col("modificationTime").alias("modified"))
    )

    mark = f"{zlib.crc32(store.checkpoint.encode()):08x}"

    def process_batch(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, f"stream-{mark}-{number}"
        in_folder = F.col("path").contains("/")
        folders = batch.where(in_folder).select(
            F.concat(F.substring_index("path", "/", 1), F.lit("/")).alias("path")).distinct()
        arrived = batch.where(~in_folder).unionByName(
            listing.list_tree(session, store.inputs, folders))
        todo = pending_entries(
            listing.triage_entries(arrived),
            read_ledger(session, store.ledger).where(F.col("batch_id") != name))
        _run(session, store, todo, name)

    run_once(stream.writeStream.foreachBatch(process_batch), store.checkpoint)


def upsert_available_now(
    stream: DataFrame, path: str, schema: StructType, key: str, order: tuple[str, ...],
    partition_by: dict[str, Column], checkpoint: str,
) -> None:
    """Bring a table up to date with all rows that arrived since the last run, then stop.

    The last row of a key by ``order`` counts, so a repeated micro-batch changes nothing.
    """
    table = tables.Table(path, schema, key, order, partition_by)
    run_once(stream.writeStream.foreachBatch(
        lambda batch, number: table.store(batch, f"{checkpoint}-{number}")), checkpoint)


def run_once(writer: DataStreamWriter, checkpoint: str) -> None:
    """Run a stream over all that has arrived, then stop."""
    writer.option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
