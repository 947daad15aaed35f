"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from checks import adapters, registry
from stridelake import schemas
from stridelake.operators import rollups, sessions
from stridelake.sources import files
from stridelake.plans import reports
from stridelake.sinks import tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The adapters' activities and tracks as the engine's own tables."""
    root = tmp_path_factory.mktemp("tables")
    acts, tracks = str(root / "acts"), str(root / "tracks")
    tables.compact(adapters.long_activities(spark, SF_DIR), acts, tables.activity_partitions())
    tables.compact(adapters.tracks(spark, SF_DIR), tracks, tables.track_partitions())
    return files.read_activity_table(spark, acts), files.read_tracks(spark, tracks)


def test_filters_and_columns_reach_the_scan(stored):
    acts, _ = stored
    text = plan(rollups.by_year(acts))
    assert "Not(EqualTo(original_source,peloton))" in text
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "average_heart_rate" in schema and "distance_m" in schema
    assert "calories" not in schema and "class_metrics" not in schema
    assert "average_cadence" not in schema                      # pruned inside the struct
    monthly = plan(rollups.monthly_by_class(acts, "1999-06-01"))
    assert "GreaterThanOrEqual(start_time,1999-01-01" in monthly


def test_tracks_are_reduced_before_they_meet_the_activities(stored):
    acts, tracks = stored
    text = plan(rollups.moving_averages_by_year(tracks, acts))
    scan = re.findall(r"ReadSchema: (\S+)", text)
    assert any(
        s.startswith("struct<activity_id:string,timestamp:timestamp,cadence:int,speed_mps:double")
        and "altitude" not in s for s in scan)
    # Reading from the leaves: the points are aggregated below the join.
    join = next(i for i, line in enumerate(text.splitlines()) if "Join" in line)
    below = text.splitlines()[join:]
    assert sum("HashAggregate" in line for line in below) >= 2


def test_bundles_shuffle_once_within_stored_ranges(spark):
    """After the ranges are stored, the rows move once to their segments; carries are broadcast."""
    rides = adapters.activities(spark, SF_DIR)
    text = plan(sessions.bundle_by_gap(rides, parts=4))
    assert "rangepartitioning" not in text and "CartesianProduct" not in text
    moved = re.findall(r"Exchange hashpartitioning\(_part#\d+, athlete_id#\d+L?,.*", text)
    assert moved and "SortMergeJoin" not in text


def test_a_report_bundle_reads_the_activities_once(stored, spark):
    acts, tracks = stored
    strength = adapters.strength(spark, SF_DIR)
    sections = reports.dashboard(acts, tracks, strength, "1999-06-01")
    folder = acts.inputFiles()[0].rsplit("/part_class", 1)[0]
    for name, section in sections.items():
        assert name == "cadence_speed_by_year" or not any(
            f.startswith(folder) for f in section.inputFiles()), name
    report = reports.training_report(acts, strength, "1999-06-01")
    for name in ("weeks", "weekly", "monthly", "headline"):
        assert not any(f.startswith(folder) for f in report[name].inputFiles()), name


def test_summaries_need_no_global_window_or_cross_join(spark):
    cheap = [
        "header_stats", "rides_by_year", "rides_by_local_hour", "class_rides_by_year",
        "rides_in_trailing_months", "weekly_volume", "window_headline",
        "weekly_volume_with_mean_weight", "activities_during_life_events",
        "strength_ride_matches", "ride_roles", "names_filled", "id_reconciliation"]
    for name in cheap:
        text = plan(registry.ALL[name][0](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert not re.search(r"Window \[.*\], \[\w+#\d+ ASC[^\]]*\]$", text), name
        assert "BatchEvalPython" not in text, name


def test_calendar_bounds_read_the_start_time_only(stored):
    acts, _ = stored
    for df in (rollups.class_by_year(acts), rollups.trailing_months(acts),
               rollups.by_local_hour(acts)):
        scans = re.findall(r"ReadSchema: (\S+)", plan(df))
        assert all("elapsed" not in s and "metrics" not in s for s in scans)


def test_no_schema_is_inferred(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1"}')
    df = files.read_activities(spark, str(tmp_path / "a.json"))
    assert df.schema["average_heart_rate"].dataType == schemas.D
