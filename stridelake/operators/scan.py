"""Ordered logic over any number of rows per key, as a scan in segments.

Rows are stored in ranges of key and order, so a range holds about as many rows as any other and a
large key spans several. Within a segment (the rows of one key in one range) a window does the work.
What a segment needs to know of those before it is one row, found by a window over the segments of
the keys that reach over the end of a range; there are two such keys a range at most. That row is
handed back by a join with a table of that size. All keys take this way: large, small and null ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from stridelake.session import materialize

PART = "_part"


def segments(
    df: DataFrame, keys: list[str], order: list[str], parts: int | None = None
) -> DataFrame:
    """``df`` stored by ranges of ``keys`` and ``order`` (nulls first), numbered in ``_part``.

    There are as many ranges as shuffle partitions, or ``parts``.
    """
    sort = [F.asc_nulls_first(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(*sort) if parts is None else df.repartitionByRange(parts, *sort)
    return materialize(ranged.withColumn(PART, F.spark_partition_id()), "segments")


def within(keys: list[str], order: list[str]) -> WindowSpec:
    """The rows of a segment in order."""
    return W.partitionBy(PART, *keys).orderBy(*order)


def before(keys: list[str]) -> WindowSpec:
    """All earlier segments of a segment's key."""
    return W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)


def reaching(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of segments that may go on in another range: those of its first and last key."""
    key = F.struct(*keys)
    ends = stored.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    edges = ends.select(
        PART, F.explode(F.array_distinct(F.array("first", "last"))).alias("key")).select(
        PART, "key.*")
    return match(stored, edges, [PART, *keys], "left_semi")


def match(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with a table of at most two rows a range, where null keys equal null keys."""
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same &= F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return left.join(F.broadcast(renamed), same, how).drop(*[f"_on_{c}" for c in on])


def carry_forward(
    points: DataFrame, keys: list[str], ts: str, value: str, out: str, parts: int | None = None
) -> DataFrame:
    """Add ``out``: the latest non-null ``value`` at or before ``ts`` within ``keys``.

    ``points`` must be unique on ``keys`` and ``ts``.
    """
    stored = segments(points, keys, [ts], parts)
    so_far = within(keys, [ts]).rowsBetween(W.unboundedPreceding, W.currentRow)
    known = F.when(F.col(value).isNotNull(), F.col(ts))
    ends = reaching(stored, keys).groupBy(PART, *keys).agg(F.max_by(value, known).alias("_end"))
    carries = ends.select(
        PART, *keys, F.last("_end", ignorenulls=True).over(before(keys)).alias("_carry"))
    local: Column = F.last(value, ignorenulls=True).over(so_far)
    return (
        match(stored.withColumn("_local", local), carries, [PART, *keys], "left")
        .withColumn(out, F.coalesce("_local", "_carry")).drop("_local", "_carry", PART))
