"""Name lookup and reconciliation of id sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions import text as X

MIN_MATCHES = 3  # fixed value
UPDATED, ALREADY_NAMED, NO_MATCH = "updated", "already_named", "no_match"


def dedupe_lookup(index: DataFrame) -> DataFrame:
    """File name to title: blank names and files are skipped, the last row of a file wins."""
    title = F.regexp_replace(F.col("Activity Name"), r"\A\s+|\s+\z", "")
    return (
        index.select(
            X.basename(F.col("Filename")).alias("file"), title.alias("title"), "position")
        .where((F.coalesce(F.col("file"), F.lit("")) != "") & (F.col("title") != ""))
        .groupBy("file").agg(F.max_by("title", "position").alias("title"))
    )


def find_titles(df: DataFrame, lookup: DataFrame, file: Column) -> DataFrame:
    """``df`` with ``title``, the lookup's entry for ``file``, or null."""
    return df.withColumn("file", file).join(lookup, "file", "left").drop("file")


def enrich_names(acts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Fill empty names from the lookup and record what happened in ``name_status``.

    Named activities are left alone and do not take part in the lookup at all.
    """
    unnamed = F.coalesce(F.col("name"), F.lit("")) == ""
    file = F.when(unnamed, F.col("raw_file_reference"))
    joined = find_titles(acts, lookup, file)
    status = (
        F.when(~unnamed, F.lit(ALREADY_NAMED))
        .when(F.col("title").isNotNull(), F.lit(UPDATED))
        .otherwise(F.lit(NO_MATCH))
    )
    name = F.when(unnamed & F.col("title").isNotNull(), F.col("title")).otherwise(F.col("name"))
    return (
        joined.withColumn("name_status", status).withColumn("name", name)
        .select(*acts.columns, "name_status")
    )


def name_counts(enriched: DataFrame) -> DataFrame:
    """One row: how many activities were updated, already named, or not found."""
    return enriched.agg(*[
        F.count_if(F.col("name_status") == s).alias(s)
        for s in (UPDATED, ALREADY_NAMED, NO_MATCH)])


def match_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every distinct id of either side with ``side``: both, left or right."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    side = (
        F.when((F.col("l") == 1) & (F.col("r") == 1), "both")
        .when(F.col("l") == 1, "left").otherwise("right")
    )
    return (
        tagged.where(F.col(key).isNotNull())
        .groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
        .select(key, side.alias("side"))
    )


def reconcile_ids(
    left: DataFrame, right: DataFrame, key: str, min_matches: int = MIN_MATCHES
) -> DataFrame:
    """One row: how many left ids exist on the right, and the verdict.

    Counts left rows, duplicates included. Both sides shrink to one row per id first.
    """
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = right.where(F.col(key).isNotNull()).select(key).distinct().withColumn(
        "found", F.lit(True))
    matched = F.coalesce(F.sum(F.when(F.col("found"), F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return counts.join(known, key, "left").agg(
        total.alias("checked"), matched.alias("matched"), (total - matched).alias("unmatched"),
        F.when(matched >= min_matches, F.lit("IDs match"))
        .otherwise(F.lit("IDs do not match")).alias("verdict"),
    )
