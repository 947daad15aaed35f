"""Bundles as a stream: rides are put together while they arrive, in any order.

Keyed state holds the rides whose place in the order may still change and, per athlete, the end and
start of the bundle that is open. Rides wait until the watermark has passed their start, when no
earlier one can come any more; a timer then settles them in order, as :mod:`operators.sessions` does
for a whole table, and each leaves with the start of its bundle. A bundle that no later ride can go
on with is forgotten. So state is bounded by the rides of one delay, however long the stream runs.
Rides later than the delay are not taken in, as with any watermark.

A key of state is a share of the athletes, not one of them: a call into Python and back costs far more
than to settle a ride, so there are as many calls as shares, however many athletes there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stridelake.operators.sessions import GAP_S, arrivals
from stridelake.streaming.ingest import run_once

SHARES = 1024  # of the athletes; fixed once a checkpoint exists
CHUNK = 10_000  # rides in one value of the state

_AT = pa.timestamp("us")
RIDE = pa.schema(
    [("athlete", pa.string()), ("id", pa.string()), ("start", _AT), ("end", _AT)])
OPEN = pa.schema([("athlete", pa.string()), ("end", _AT), ("bundle_start", _AT)])
PACKED = "packed binary"  # rows as an Arrow stream
PLACED = "athlete_id long, id string, start timestamp, bundle_start timestamp"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _pack(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema) as writer:
        writer.write(pa.RecordBatch.from_pandas(rows, schema, preserve_index=False))
    return out.getvalue().to_pybytes()


def _unpack(packed: Iterable[tuple], schema: pa.Schema) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(bytes(one)).read_all() for one, in packed]
    return pa.concat_tables([schema.empty_table(), *tables]).to_pandas()


class Bundler(StatefulProcessor):
    """Settles the rides of a share of the athletes, each athlete's in order of start and id."""

    def __init__(self, gap_s: float) -> None:
        self.gap = pd.Timedelta(seconds=gap_s)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PACKED)
        self.open = handle.getValueState("open", PACKED)

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            rides = batch[batch["id"].notna()]  # a row without an id only moves the watermark
            if len(rides):
                self.waiting.appendList(_chunks(rides))
                earliest = rides["start"].min()
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            self.handle.registerTimer(_due(first))
        yield from ()

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        passed = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        rides = _unpack(self.waiting.get(), RIDE)
        settled = rides["start"] <= passed
        if not settled.any():
            return
        later = rides[~settled]
        if len(later):
            self.waiting.put(_chunks(later))
            self.handle.registerTimer(_due(later["start"].min()))
        else:
            self.waiting.clear()
        yield self._place(rides[settled].sort_values(["athlete", "start", "id"]), passed)

    def _place(self, rides: pd.DataFrame, passed: pd.Timestamp) -> pd.DataFrame:
        known = _unpack([self.open.get()] if self.open.exists() else [], OPEN)
        before = known.set_index("athlete")
        athlete = rides["athlete"]
        previous_end = rides["end"].shift().where(
            athlete == athlete.shift(), athlete.map(before["end"]))
        opens = previous_end.isna() | (rides["start"] - previous_end > self.gap)
        bundle_start = rides["start"].where(opens).groupby(athlete).ffill()
        bundle_start = bundle_start.fillna(athlete.map(before["bundle_start"]))
        last = rides.assign(bundle_start=bundle_start)[list(OPEN.names)]
        now_open = pd.concat([known, last]).drop_duplicates("athlete", keep="last")
        # What starts from now on opens a bundle of its own where the gap is over already.
        self.open.update((_pack(
            now_open[~(now_open["end"] + self.gap < passed)], OPEN),))
        return pd.DataFrame({
            "athlete_id": pd.array([int(a) if a else None for a in athlete], "Int64"),
            "id": rides["id"].array,
            "start": rides["start"].array, "bundle_start": bundle_start.array})

    def close(self) -> None:
        pass


def _chunks(rides: pd.DataFrame) -> list[tuple[bytes]]:
    return [(_pack(rides[at:at + CHUNK], RIDE),) for at in range(0, len(rides), CHUNK)]


def _due(start: pd.Timestamp) -> int:
    """The first whole millisecond that is not before ``start``."""
    return -(-pd.Timestamp(start).value // 1_000_000)


def stream_bundles(
    activities: DataFrame, delay: str = "7 days", gap_s: float = GAP_S, shares: int = SHARES
) -> DataFrame:
    """``athlete_id, id, start, bundle_start`` of the rides of a stream of activities.

    ``delay`` is how much later than a ride that starts after it a ride may arrive. A row without
    an id belongs to no bundle, but moves the watermark: with one from time to time the last rides
    of a quiet source leave too. ``shares`` of the athletes are settled together; a stream that goes
    on from a checkpoint must keep their number.
    """
    spark = activities.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    share = F.pmod(F.xxhash64("athlete"), F.lit(shares)).cast("int")
    return (
        arrivals(activities).withColumn("share", share).withWatermark("start", delay)
        .groupBy("share")
        .transformWithStateInPandas(
            statefulProcessor=Bundler(gap_s), outputStructType=PLACED, outputMode="Append",
            timeMode="EventTime")
    )


def bundles_available_now(
    activities: DataFrame, path: str, checkpoint: str, delay: str = "7 days",
    gap_s: float = GAP_S,
) -> None:
    """Settle what can be settled of the rides that arrived since the last run, then stop.

    Placed rides are appended to the folder ``path``, each once, also after a restart.
    """
    placed = stream_bundles(activities, delay, gap_s)
    run_once(
        placed.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """The rides that have left the stream."""
    return spark.read.schema(PLACED).parquet(path)
