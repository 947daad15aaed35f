"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stridelake.session import configure, discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
BITMAP_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def map_batches(
    df: DataFrame, function: Callable[[dict[str, pa.Array]], dict], schema: str
) -> DataFrame:
    """The columns that ``function`` makes of each Arrow batch, given by name."""
    return map_tasks(df, lambda: (function, None), schema)


def map_tasks(
    df: DataFrame, start: Callable[[], tuple[Callable, Callable[[], dict] | None]], schema: str
) -> DataFrame:
    """As :func:`map_batches`, by functions that may remember what a task has seen.

    ``start`` makes two for each task: one for its batches, and one (or None) for columns that
    come after them.
    """
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def rows(made: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(made[f.name], type=f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, last = start()
        for batch in batches:
            yield rows(each(dict(zip(batch.schema.names, batch.columns, strict=True))))
        if last:
            yield rows(last())

    return df.mapInArrow(run, fields)


def lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow list column from flat ``values`` and the row ``offsets`` in them."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, dtype: type) -> np.ndarray:
    """Rows of a list column whose lists all have ``width`` elements without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), width)


def n_blocks(rows: int, per_block: int) -> int:
    return max(1, -(-rows // per_block))


def dealt(blocks: int, *columns: str | Column) -> Column:
    """A block number from a hash of the row, so that a repeated task deals as before."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def id_bitmap(ids: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of fixed size in which the hashed bit of every (non-null) id is set.

    It lets a scan skip most rows that a later exact join would drop, whatever the number of ids;
    ``bits / 8`` bytes reach the driver.
    """
    bit = F.pmod(F.xxhash64(F.col(ids.columns[0]).cast("long")), F.lit(bits))
    words = (
        ids.where(F.col(ids.columns[0]).isNotNull())
        .select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 5).cast("int").alias("word"))
        .agg(F.bit_or(F.call_function(
            "shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int"))).alias("set"))
    )
    out = np.zeros(bits // 32, np.uint32)
    found = words.toArrow()  # bits / 32 rows at most
    out[found["word"].to_numpy()] = found["set"].to_numpy()
    return out


def in_bitmap(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    bits = bits.astype(np.int64, copy=False)
    return (bitmap[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1 == 1


def bitmap_bit(column: str, bits: int = BITMAP_BITS) -> Column:
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of an undirected edge list.

    ``edges`` has long columns ``a`` and ``b``. Alternating star steps: every node first hands its
    larger neighbours to its smallest one, then its smaller ones. Stars stay as they are, long
    chains shrink by half and more, and a hub costs one row per neighbour. Each step is written to
    the shared folder, so lost executors repeat one step only.
    """
    def normal(df: DataFrame) -> DataFrame:
        low, high = F.least("a", "b"), F.greatest("a", "b")
        return df.select(high.alias("a"), low.alias("b")).where("a <> b").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first())

    current = materialize(normal(edges), "edges")
    seen = mark(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        large = normal(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        before = current
        current = materialize(
            normal(small.select("b", "m").withColumnsRenamed({"b": "a", "m": "b"})
                   .unionByName(down.select("a", F.col("m").alias("b")))), "edges")
        discard(before)
        now = mark(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots)
