"""Vectors in blocks: what the two searches share.

A search compares a stated set of queries with all rows. Both are dealt into blocks of bounded
size, and one task handles one block of rows with one block of queries. Vectors of different
lengths never meet.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.llm.common import dealt, n_blocks

ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    number = F.col(vector).cast("array<double>")
    return F.coalesce(F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
        F.lit(False))


def blocks(
    rows: DataFrame, every: int, per_block: int = ROWS_PER_BLOCK,
    per_query_block: int = QUERIES_PER_BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Rows and queries (those whose ``vec_id`` is divisible by ``every``), dealt to block pairs.

    ``rows`` (stored) has ``vec_id``, ``v`` and ``row``, a number of its own for each row, so that
    rows with equal ids and vectors are spread like others. Both results add ``size`` (of the
    vector), ``block`` and ``query_block``. An id asks once: where rows with one id hold several
    vectors, the smallest by its components in order is the query.
    """
    sized = rows.withColumn("size", F.size("v"))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min("v").alias("v")).withColumn("size", F.size("v"))
    counts = sized.agg(
        F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    n, q = n_blocks(counts["n"], per_block), n_blocks(counts["q"], per_query_block)

    def each(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    return (
        sized.withColumn("block", dealt(n, "row")).drop("row").withColumn("query_block", each(q)),
        queries.withColumn("query_block", dealt(q, "vec_id", "v")).withColumn("block", each(n)))


def meet(
    rows: DataFrame, queries: DataFrame, compare: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str, keys: tuple[str, ...] = ("size", "block", "query_block"),
) -> DataFrame:
    """What ``compare`` finds for each block of queries in each block of rows."""
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # one table, two sides
    return rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(compare, schema)


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """The first ``k`` of each query by ``order``, ties to the smaller ``vec_id``."""
    ranked = W.partitionBy("query_id", "query").orderBy(order, "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
