from stridelake import schemas
from stridelake.operators import quality
from stridelake.sources import files
from tests.helpers import utc

WEIGHT = (
    "entry bigint, id string, source string, original_source string, recorded_at timestamp, "
    "weight_kg double, weight_lb double")


def test_weight_rules(spark):
    at = utc("2026-06-01")
    df = spark.createDataFrame([
        (0, "a", "google_fit", "hevy", at, 70.0, 154.3),
        (1, "a", "google_fit", "hevy", at, 30.0, None),
        (2, "b", "google_fit", "hevy", at, 29.99, 66.1),
        (3, "c", "google_fit", "hevy", at, 250.0, 551.1),      # 551.2 expected: close enough
        (4, "d", "google_fit", "hevy", at, 100.0, 220.0),      # 220.5 expected
        (5, "a", "google_fit", None, at, 999.0, 1.0),          # malformed: nothing else checked
        (6, None, "google_fit", "hevy", at, 70.0, None),
    ], WEIGHT)
    got = {(r.entry, r.label, r.message) for r in quality.validate_weight(df).collect()}
    assert got == {
        (1, "a", "id is taken already by entry #0"),
        (2, "b", "weight_kg is outside 30 to 250"),
        (4, "d", "weight_lb does not match weight_kg"),
        (5, "a", "original_source is required"),
        (6, "entry #6", "id is required"),
    }
    report = {r.kind: r.n for r in quality.violations_report(
        quality.validate_weight(df)).collect()}
    assert report["id is taken already by entry #"] == 1


def test_life_event_rules(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text("""[
      {"id": "a", "date": "2026-06-01", "category": "health", "title": "t", "description": "d",
       "related_event_ids": ["b", "gone"]},
      {"id": "b", "date": "2026-06-02", "date_end": "2026-06-01", "category": "other",
       "title": "t", "description": "d", "tags": ["x"]},
      {"id": "c", "date": "2026-06-02", "category": "else", "title": "t", "description": "d",
       "related_event_ids": ["c", "a"]},
      {"id": "a", "date": "2026-06-02", "category": "other", "title": "t", "description": "d"},
      {"date": "2026-06-02", "category": "other", "title": "t", "description": "d",
       "related_event_ids": ["nowhere"]}
    ]""")
    df = files.read_json_array(spark, str(path), schemas.LIFE_EVENT)
    got = {(r.label, r.message) for r in quality.validate_life_events(df).collect()}
    assert got == {
        ("a", "references unknown id gone"),
        ("a", "id is taken already by entry #0"),
        ("b", "date_end is before date"),
        ("c", "category is unknown"),
        ("c", "references unknown id c"),        # malformed events do not count as existing
        ("entry #4", "id is required"),
    }


def test_valid_file_gives_no_rows(spark):
    df = spark.createDataFrame(
        [(0, "a", "google_fit", "hevy", utc("2026-06-01"), 70.0, 154.3)], WEIGHT)
    assert quality.violations_report(quality.validate_weight(df)).isEmpty()


def test_split_ok(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "id string, n int")
    good, bad = quality.split_ok(quality.apply_rules(df, quality.required("id")))
    assert [r.n for r in good.collect()] == [1]
    assert [(r.n, r.violations) for r in bad.collect()] == [(2, ["id is required"])]
