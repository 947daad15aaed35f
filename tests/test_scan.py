"""Scans in segments, and joins on keys that hold many rows."""

import pytest
from pyspark.sql import functions as F, types as T

from stridelake.operators import lookup, quality, scan

POINTS = "k string, s bigint, v int"


@pytest.mark.parametrize("parts", [1, 2, 5, 40])
def test_carry_forward(spark, parts):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 50, None), ("a", 3600, None), ("a", 7200, 2), ("a", 7201, None),
         ("b", 10, None), ("b", 4000, 3), (None, 1, None), (None, 2, 7), (None, 3, None)],
        POINTS).withColumn("ts", F.timestamp_seconds("s"))
    got = scan.carry_forward(df, ["k"], "ts", "v", "latest", parts).orderBy("k", "ts").collect()
    assert [r.latest for r in got] == [None, 7, 7, 1, 1, 1, 2, 2, None, 3]


@pytest.mark.parametrize("hot", ["x", None])
def test_a_hot_key_spans_ranges_and_only_they_are_handed_on(spark, hot):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.lit(hot).cast(T.StringType()))
        .otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds("id").alias("ts"), F.when(F.col("id") == 1, 5).alias("v"))
    stored = scan.segments(df, ["k"], ["ts"], 12)
    sizes = [r["count"] for r in stored.groupBy(scan.PART).count().collect()]
    assert len(sizes) > 6 and max(sizes) < 1500
    reaching = scan.reaching(stored, ["k"]).select(scan.PART, "k").distinct().collect()
    assert len(reaching) <= 24
    got = scan.carry_forward(df, ["k"], "ts", "v", "latest", 12)
    assert got.where("latest = 5").count() == 4000


def test_no_rows(spark):
    df = spark.createDataFrame([], POINTS).withColumn("ts", F.timestamp_seconds("s"))
    assert scan.carry_forward(df, ["k"], "ts", "v", "latest").count() == 0


def test_lookup_with_missing_and_repeated_files(spark):
    acts = spark.createDataFrame(
        [("1", None, "f"), ("2", "", "f"), ("3", "Own", "f"), ("4", None, None), ("5", None, "g")],
        "id string, name string, raw_file_reference string")
    index = spark.createDataFrame(
        [("x/f", " First ", 1), ("f", "Last", 2), ("f", "  ", 3), ("g", "", 4), ("", "No", 5),
         (None, "No", 6)], "Filename string, `Activity Name` string, position int")
    names = lookup.enrich_names(acts, lookup.dedupe_lookup(index))
    assert [tuple(r) for r in names.orderBy("id").select("name", "name_status").collect()] == [
        ("Last", "updated"), ("Last", "updated"), ("Own", "already_named"), (None, "no_match"),
        (None, "no_match")]
    assert tuple(lookup.name_counts(names).first()) == (2, 1, 2)


def test_duplicates_name_the_first_position(spark):
    df = spark.createDataFrame(
        [("a", 0), ("b", 1), ("a", 2), ("a", 3), (None, 4), (None, 5)], "id string, entry int")
    got = quality.duplicate_ids(df, "id", "entry")
    assert sorted((r.id, r.entry, r.first_position) for r in got.collect()) == [
        ("a", 2, 0), ("a", 3, 0)]


def test_reconciliation_verdict(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id string")
    assert tuple(lookup.reconcile_ids(ids("1", "2", "3", "9"), ids("1", "2", "3"), "id").first()) \
        == (4, 3, 1, "IDs match")
    assert tuple(lookup.reconcile_ids(ids("1", "2"), ids("1", "2", "3"), "id").first()) == (
        2, 2, 0, "IDs do not match")
    assert tuple(lookup.reconcile_ids(ids(), ids("1"), "id").first()) == (
        0, 0, 0, "IDs do not match")
    sides = lookup.match_ids(ids("1", "1", "2"), ids("2", "3"), "id")
    assert sorted(map(tuple, sides.collect())) == [("1", "left"), ("2", "both"), ("3", "right")]
