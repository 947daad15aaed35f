"""Sharding of indivisible groups by Karmarkar-Karp differencing.

A group (all rows with one text) goes to one shard as a whole, and the shards' bytes should be as
even as possible. Differencing starts with one partial partition per unit, takes the two with the
largest spread, and joins them oppositely ordered: the fullest shard of the one with the emptiest
of the other. What stays is one partition whose spread is tiny against any unit.

Spark finds the units. A group above ``1 / packs`` of all bytes is a unit of its own; fewer than
``packs`` such groups can exist. The others are dealt to ``packs`` packs by a hash of their text.
So at most ``2 * packs`` numbers are differenced on the driver, whatever the size of the input, and
the resulting table is small enough to broadcast. Rows never move to find their shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.llm.common import n_blocks
from stridelake.session import materialize

PACKS = 8192
CHUNK_ROWS = 65_536


def difference(weights: Sequence[int], ways: int) -> list[int]:
    """The shard of every weight, by Karmarkar-Karp differencing over ``ways`` shards.

    A partial partition is a list of (bytes, members) in falling order of bytes. Members are kept
    as a tree of pairs, so a join costs ``ways`` steps.
    """
    heap = []
    for at, weight in enumerate(weights):
        slots = [(weight, at)] + [(0, None)] * (ways - 1)
        heap.append((-weight, at, slots))
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        slots = []
        for (a, left), (b, right) in zip(one, reversed(other), strict=True):
            members = left if right is None else right if left is None else (left, right)
            slots.append((a + b, members))
        slots.sort(key=lambda slot: -slot[0])
        number += 1
        heapq.heappush(heap, (slots[-1][0] - slots[0][0], number, slots))
    shard = [0] * len(weights)
    for label, (_, members) in enumerate(heap[0][2] if heap else []):
        todo = [] if members is None else [members]
        while todo:
            top = todo.pop()
            if isinstance(top, tuple):
                todo.extend(top)
            else:
                shard[top] = label
    return shard


def text_key(text: str = "text") -> Column:
    """Equal for equal texts only; null for a null text."""
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def byte_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard_of(
    rows: DataFrame, shards: int, key: str = "key", size: str = "size", packs: int = PACKS
) -> DataFrame:
    """``rows`` with an int column ``shard``; rows with one ``key`` (null included) stay together.

    ``shard`` must not be a column yet, nor may names begin with ``_kk_``.
    """
    spark = rows.sparkSession
    groups = rows.groupBy(F.col(key).alias("_kk_key")).agg(F.sum(size).alias("_kk_bytes"))
    total = rows.agg(F.sum(size)).first()[0] or 0
    heavy = F.col("_kk_bytes") * F.lit(packs) > F.lit(total)
    pack = F.pmod(F.xxhash64("_kk_key"), F.lit(packs)).cast("int")
    units = (
        groups.select(
            F.when(heavy, F.col("_kk_key")).alias("key"),
            F.when(~heavy, pack).alias("pack"), "_kk_bytes")
        .groupBy("key", "pack").agg(F.sum("_kk_bytes").alias("bytes"))
        .collect()  # at most 2 * packs rows, see above
    )
    units.sort(key=lambda u: (-u["bytes"], -1 if u["pack"] is None else u["pack"], u["key"] or b""))
    labels = difference([u["bytes"] for u in units], shards)
    of_pack = spark.createDataFrame(
        [(u["pack"], s) for u, s in zip(units, labels, strict=True) if u["pack"] is not None],
        "_kk_pack int, _kk_light int")
    of_key = spark.createDataFrame(
        [(u["key"], s) for u, s in zip(units, labels, strict=True) if u["pack"] is None],
        "_kk_group binary, _kk_heavy int")
    return (
        rows.withColumn("_kk_pack", F.pmod(F.xxhash64(key), F.lit(packs)).cast("int"))
        .join(F.broadcast(of_pack), "_kk_pack", "left")
        .join(F.broadcast(of_key), F.col(key).eqNullSafe(F.col("_kk_group")), "left")
        .withColumn("shard", F.coalesce("_kk_heavy", "_kk_light"))
        .drop("_kk_pack", "_kk_light", "_kk_group", "_kk_heavy")
    )


def assign_shards(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text",
    packs: int = PACKS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Shard and slot of every row of ``docs``: law ``bytes``, groups of equal texts.

    ``size`` is the UTF-8 length plus one (null text: one), ``text_crc32`` is null for a null
    text. All null texts form one group, all empty texts another. ``slot`` counts a shard's rows
    from 0 in order of a hash chunk, then id; repeated rows get slots of their own. An empty table
    gives no rows. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    """
    light = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"), byte_size(text).alias("size"),
            F.crc32(F.col(text).cast("binary")).alias("text_crc32"), text_key(text).alias("key")),
        "shard-rows")
    rows = shard_of(light, shards, packs=packs)
    # A shard holds a sixteenth of all rows or more, so its rows are numbered in chunks.
    chunks = max(64, n_blocks(light.count(), chunk_rows))
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "key"), F.lit(chunks)))
    place = ["shard", "chunk"]
    before = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = chunked.groupBy(*place).agg(F.count("*").alias("rows")).select(
        *place, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy(*place).orderBy("doc_id", "text_crc32", "size", "key")
    return (
        chunked.withColumn("nth", F.row_number().over(within) - 1)
        .join(starts, place)
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"))
    )


def shard_documents(
    docs: DataFrame, shards: int = 16, text: str = "text", packs: int = PACKS
) -> DataFrame:
    """``docs`` with a column ``shard`` (in place of one they have), balanced by text bytes."""
    rows = docs.drop("shard").withColumns(
        {"_kk_text": text_key(text), "_kk_size": byte_size(text)})
    return shard_of(rows, shards, "_kk_text", "_kk_size", packs).drop("_kk_text", "_kk_size")
