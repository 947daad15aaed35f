"""The daily table against rollups of the activities themselves."""

import random

import pytest
from pyspark.sql import functions as F

from checks import adapters
from stridelake import schemas
from stridelake.operators import normalize, rollups, states
from stridelake.plans import reports
from stridelake.sinks import daily
from stridelake.streaming import ingest
from tests.helpers import activities, activity

SF_DIR = "/root/testdata/sf0.001"
START = "2024-01-08"

SECTIONS = {
    "stats": lambda acts, lifts: rollups.header_stats(acts),
    "stats by athlete": lambda acts, lifts: rollups.header_stats(acts, ["athlete_id"]),
    "years": lambda acts, lifts: rollups.by_year(acts),
    "years by athlete": lambda acts, lifts: rollups.by_year(acts, ["athlete_id"]),
    "hours": lambda acts, lifts: rollups.by_local_hour(acts),
    "class": lambda acts, lifts: rollups.class_by_year(acts),
    "months": lambda acts, lifts: rollups.trailing_months(acts),
    "recovery": lambda acts, lifts: rollups.recovery_weeks(acts, lifts, START),
    "weekly": lambda acts, lifts: rollups.weekly_volume(acts, lifts, START),
    "monthly": lambda acts, lifts: rollups.monthly_by_class(acts, START),
    "monthly by athlete": lambda acts, lifts: rollups.monthly_by_class(acts, START, ["athlete_id"]),
    "headline": lambda acts, lifts: rollups.window_headline(acts, lifts, START),
}


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    acts = adapters.activities(spark, SF_DIR)
    odd = activities(
        spark, activity("n", None), activity("s", "2024-01-09 23:30:00", source=None, kj=1.5),
        activity("t", "2024-01-07 12:00:00", distance_m=-2.5, elapsed_time_s=None))
    acts = acts.unionByName(odd)
    return acts, reports.daily_states(acts), adapters.strength(spark, SF_DIR)


@pytest.mark.parametrize("name", SECTIONS)
def test_every_section_from_the_daily_table(tables, name):
    acts, stored, lifts = tables
    assert rows(SECTIONS[name](stored, lifts)) == rows(SECTIONS[name](acts, lifts))


def test_no_activities(spark):
    none = activities(spark, activity(1, "2024-01-01")).where("false")
    stored = reports.daily_states(none)
    for name in ("stats", "years", "class", "months", "monthly", "headline"):
        lifts = adapters.strength(spark, SF_DIR)
        assert rows(SECTIONS[name](stored, lifts)) == rows(SECTIONS[name](none, lifts)), name


def stored_acts(spark, *given):
    return normalize.conform(activities(spark, *[a for a, _ in given]).withColumn(
        "entry", F.col("id")).join(spark.createDataFrame(
            [(a["id"], m) for a, m in given], "id string, modified timestamp"), "id"),
        schemas.STORED_ACTIVITY)


def test_refreshes_equal_the_whole(spark, tmp_path):
    rng = random.Random(3)
    store = ingest.Store("", *(str(tmp_path / n) for n in ("acts", "tracks", "ledger")),
                         daily=str(tmp_path / "daily"))
    moments = [f"2026-0{rng.randint(5, 7)}-0{rng.randint(1, 5)} 0{rng.randint(0, 9)}:00:00"
               for _ in range(60)]
    from tests.helpers import utc
    batches = [range(0, 20), range(20, 30), [3, 4, 40, 41], [], [4, 50], range(51, 55)]
    for n, ids in enumerate(batches):
        given = [(activity(i, rng.choice(moments), rng.choice(["peloton", "garmin", None]),
                           athlete_id=i % 3, distance_m=rng.random() * 1e4),
                  utc(f"2026-08-01 00:00:0{n}")) for i in ids]
        made = stored_acts(spark, *given) if given else spark.createDataFrame(
            [], schemas.STORED_ACTIVITY)
        result = ingest.IngestResult(
            made, spark.createDataFrame([], schemas.STORED_POINT),
            spark.createDataFrame([], schemas.OUTCOME))
        for _ in range(2 if n in (1, 2) else 1):  # some batches are stored twice
            ingest.store_result(result, store, f"batch {n}")
        if n == 3:
            store.daily_table.compact(spark)
        acts = ingest.read_activities(spark, store)
        held = store.daily_table.read(spark)
        for name in ("stats by athlete", "years", "hours", "monthly", "class"):
            lifts = adapters.strength(spark, SF_DIR)
            assert rows(SECTIONS[name](held, lifts)) == rows(SECTIONS[name](acts, lifts)), (n, name)


def test_a_batch_of_new_activities_reads_only_itself(spark, tmp_path):
    table = daily.DailyTable(str(tmp_path))
    table.add(activities(spark, activity(1, "2026-06-01")), "a")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    table.add(activities(spark, activity(2, "2026-06-01")), "b")
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert before.items() < after.items()
    row = rollups.header_stats(table.read(spark)).first()
    assert row.total_rides == 2
    new = daily.replaced_days(activities(spark, activity(1, "2026-06-01")),
                              activities(spark, activity(2, "2026-06-01")))
    assert new.isEmpty()
    old = daily.replaced_days(activities(spark, activity(1, "2026-06-01")),
                              activities(spark, activity(1, "2026-06-03")))
    assert sorted(str(r.day) for r in old.collect()) == ["2026-06-01", "2026-06-03"]
    assert states.STATE == table.read(spark).states.schema


def test_activities_are_dealt_before_they_become_states(spark, tmp_path):
    acts = activities(spark, *[activity(n, f"2026-06-0{n}", distance_m=1.0) for n in range(1, 5)])
    plan = states.daily(acts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("Generate") < plan.index("Exchange")  # the plan is read from the top
    table = daily.DailyTable(str(tmp_path))
    table.add(acts, "a")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = table.read(spark).states._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_compaction_adds_up_only_days_of_several_versions(spark, tmp_path):
    table = daily.DailyTable(str(tmp_path))
    given = [activity(n, f"2026-06-0{day} 10:00:00", distance_m=float(n))
             for n, day in enumerate([1, 1, 2, 3])]
    table.add(activities(spark, *given[:3]), "a")
    table.add(activities(spark, given[3], activity(9, "2026-06-02 10:10:00", distance_m=5.0)), "b")
    counting = table._counting(spark)
    whole = {str(r.day) for r in counting.where("_whole").select("day").distinct().collect()}
    assert whole == {"2026-06-01", "2026-06-03"}
    before = rows(rollups.header_stats(table.read(spark)))
    table.compact(spark)
    stored = table.read(spark).states
    assert rows(rollups.header_stats(table.read(spark))) == before
    assert stored.count() == stored.select("athlete_id", "day", "hour", "kind", "measure").distinct(
        ).count()
