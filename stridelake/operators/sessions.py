"""Gap sessions: rides that a device stored as several rows, put back together.

Rows of one athlete, in order of start, belong to the same bundle while each begins at most
``gap_s`` seconds after the end of the row before it. What counts is the previous row's own end,
not the latest end so far.

The order is a scan in segments (:mod:`operators.scan`): a hot athlete spans many ranges, and from
one to the next travel only the last end and the start of the bundle that is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.functions import numeric as N, text as X, times
from stridelake.operators import scan

GAP_S = 600  # fixed value
FAR = "2200-01-01"
KEY = ["athlete_id", "bundle_start"]


def _prepare(acts: DataFrame) -> DataFrame:
    """The columns the session logic needs, under short names.

    An activity without a start has no place in the order and is left out.
    """
    elapsed = F.coalesce("elapsed_time_s", F.lit(0.0))
    return acts.where(F.col("start_time").isNotNull()).select(
        "athlete_id", "id",
        F.col("start_time").alias("start"),
        times.end_time(F.col("start_time"), elapsed).alias("end"),
        elapsed.alias("elapsed_s"),
        X.ascii_only(F.col("name")).alias("name"),
        F.col("average_heart_rate").alias("hr"),
        F.col("max_heart_rate").alias("max_hr"),
        "calories",
        F.col("class_metrics.output_kj").try_cast("double").alias("kj"),
    )


def arrivals(acts: DataFrame) -> DataFrame:
    """What a stream of activities needs to place rides: ``athlete`` (the id as text, empty for
    none, since keys of state should not be null), ``id``, ``start``, ``end``.

    A start in the far future would move the watermark past all that is still to come, so rides
    from ``FAR`` on are left out.
    """
    return _prepare(acts).where(F.col("start") < F.lit(FAR).cast("timestamp")).select(
        F.coalesce(F.col("athlete_id").cast("string"), F.lit("")).alias("athlete"),
        "id", "start", "end")


def _main_candidate() -> Column:
    """Aggregate: the longest row; on equal length the earliest, then the lowest id."""
    rank = F.struct(
        (-F.col("elapsed_s")).alias("rank"), "start", "id", "name", "elapsed_s", "hr", "max_hr",
        "calories", "kj",
    )
    return F.min(rank)


def _opens(previous_end: Column, start: Column, gap_s: float) -> Column:
    return previous_end.isNull() | (times.seconds_between(previous_end, start) > gap_s)


def _place(
    rows: DataFrame, gap_s: float, parts: int | None = None
) -> DataFrame:
    """Add ``bundle_start``: the start of the latest bundle opened so far by the athlete."""
    keys, order = ["athlete_id"], ["start", "id"]
    stored = scan.segments(rows, keys, order, parts)
    ordered = scan.within(keys, order)
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    previous = F.lag("end").over(ordered)

    def opened(df: DataFrame) -> DataFrame:
        """``_open``: the latest start that surely opened a bundle within the segment. Its first row
        is not decided here: that takes the end of the segment before."""
        opens = previous.isNotNull() & _opens(previous, F.col("start"), gap_s)
        return df.withColumn("_opens", F.when(opens, F.col("start"))).withColumn(
            "_open", F.last("_opens", ignorenulls=True).over(so_far)).drop("_opens")

    summary = opened(scan.reaching(stored, keys)).groupBy(scan.PART, *keys).agg(
        F.min("start").alias("_first"),
        F.max_by("end", F.struct(*order)).alias("_end"),
        F.max("_open").alias("_last_open"))
    across = W.partitionBy(*keys).orderBy(scan.PART)
    opens_here = _opens(F.lag("_end").over(across), F.col("_first"), gap_s)
    carries = (
        summary.withColumn("_head", F.when(opens_here, F.col("_first")))
        .withColumn("_tail", F.coalesce("_last_open", "_head"))
        .withColumn("_before", F.last("_tail", ignorenulls=True).over(scan.before(keys)))
        .select(scan.PART, *keys, F.coalesce("_head", "_before").alias("_carry")))
    first = F.first("start").over(so_far)
    return (
        scan.match(opened(stored).withColumn("_first", first), carries, [scan.PART, *keys], "left")
        .withColumn("bundle_start", F.coalesce("_open", "_carry", "_first"))
        .drop("_open", "_carry", "_first", scan.PART))


def _beside_main(placed: DataFrame) -> DataFrame:
    """Every row with ``main`` and ``n_rows`` of its bundle.

    A bundle may be large, so its rows meet the summary in a join, which adaptive execution splits.
    """
    mains = placed.groupBy(*[F.col(c).alias(f"_{c}") for c in KEY]).agg(
        _main_candidate().alias("main"), F.count("*").alias("n_rows"))
    same = F.col("athlete_id").eqNullSafe(F.col("_athlete_id")) & (
        F.col("bundle_start") == F.col("_bundle_start"))
    return placed.join(mains, same).drop(*[f"_{c}" for c in KEY])


def bundle_by_gap(
    acts: DataFrame, gap_s: float = GAP_S, parts: int | None = None
) -> DataFrame:
    """Every activity with ``bundle_start``; together with the athlete it names the bundle."""
    return _place(_prepare(acts), gap_s, parts)


def mark_main(acts: DataFrame, gap_s: float = GAP_S, parts: int | None = None) -> DataFrame:
    """Every activity with its bundle, ``role`` (main, warmup, cooldown, same_start) and
    ``is_orphan``."""
    marked = _beside_main(_place(_prepare(acts), gap_s, parts))
    start, main_start = F.col("start"), F.col("main.start")
    role = (
        F.when(F.col("id") == F.col("main.id"), "main")
        .when(start < main_start, "warmup")
        .when(start > main_start, "cooldown")
        .otherwise("same_start")
    )
    orphan = _is_orphan(F.col("n_rows"), F.col("main.name"))
    return marked.withColumn("role", role).withColumn("is_orphan", orphan).drop("main", "n_rows")


def _is_orphan(n_rows: Column, name: Column) -> Column:
    named = X.name_matches(name, X.WARM_UP) | X.name_matches(name, X.COOL_DOWN)
    return (n_rows == 1) & named


def bundle_records(acts: DataFrame, gap_s: float = GAP_S, parts: int | None = None) -> DataFrame:
    """One row per bundle: ``main``, ``bundle_end``, ``n_rows``, ``elapsed_sum``, ``kj_sum``, and
    the mean heart rates before and after the main segment."""
    kj = N.zero_to_null(F.col("kj"))
    # Rows that start with the main segment are on neither side of it.
    sides = {
        "warmup_hr": F.col("start") < F.col("main.start"),
        "cooldown_hr": F.col("start") > F.col("main.start"),
    }
    return _beside_main(_place(_prepare(acts), gap_s, parts)).groupBy(*KEY).agg(
        F.min("main").alias("main"),
        F.max("end").alias("bundle_end"),
        F.count("*").alias("n_rows"),
        N.exact_sum(F.col("elapsed_s")).alias("elapsed_sum"),
        N.exact_sum(kj).alias("kj_sum"),
        *[N.exact_avg(F.when(side, F.col("hr"))).alias(name) for name, side in sides.items()],
    ).withColumns({name: N.round_half_even(F.col(name), 1) for name in sides})


def summarize_bundles(bundles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split :func:`bundle_records` into ``(sessions, orphans)`` in report form.

    An orphan is a bundle of a single row whose name says warm-up or cool-down. Power uses the
    main segment only, energy and total minutes the whole bundle.
    """
    main = F.col("main")
    orphan = _is_orphan(F.col("n_rows"), main["name"])
    watts = N.mean_watts(main["kj"], main["elapsed_s"])
    common = [
        "athlete_id", "bundle_start", "bundle_end",
        main["id"].alias("id"),
        F.to_date(main["start"]).alias("date"),
        main["name"].alias("name"),
        N.round_half_even(main["hr"], 1).alias("hr"),
        N.round_half_even(N.s_to_min(main["elapsed_s"]), 1).alias("minutes"),
    ]
    sessions = bundles.where(~orphan).select(
        *common,
        main["max_hr"].alias("max_hr"),
        N.round_half_even(N.s_to_min(F.col("elapsed_sum")), 1).alias("total_minutes"),
        N.round_half_even(watts, 1).alias("watts"),
        N.round_half_even(F.nullif(F.col("kj_sum"), F.lit(0.0)), 1).alias("kj"),
        main["calories"].alias("calories"),
        X.high_intensity(main["hr"], watts).alias("high_intensity"),
        "warmup_hr", "cooldown_hr",
        N.round_half_even(main["hr"] - F.col("cooldown_hr"), 1).alias("hr_recovery"),
    )
    return sessions, bundles.where(orphan).select(*common)
