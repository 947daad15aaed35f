"""Rules compiled from a record schema."""

import json

import pytest
from pyspark.sql import types as T

from stridelake.operators import normalize, rules
from stridelake.sources import files

def struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, WHOLE, NUMBER = T.StringType(), T.LongType(), T.DoubleType()
SCHEMA = struct(
    id=TEXT, n=WHOLE, x=NUMBER, ok=T.BooleanType(), at=T.TimestampType(), day=T.DateType(),
    tags=T.ArrayType(TEXT), inner=struct(a=NUMBER, b=struct(c=TEXT)), other=struct(d=WHOLE))
SPEC = rules.Spec(
    SCHEMA, required=("id", "inner.a"), ranges={"x": (0.0, 9.5), "n": (None, 5)},
    enums={"id": ("p", "q")}, exclusive=(("inner.b", "other"),))
GOOD = {"id": "p", "n": 1, "x": 2, "ok": True, "at": "2026-06-01T10:00:00Z", "day": "2026-06-01",
        "tags": ["s"], "inner": {"a": 1.5, "b": {"c": "t"}}}


@pytest.mark.parametrize("change, want", [
    ({}, []),
    ({"x": None, "n": None, "tags": [], "ok": None}, []),
    ({"id": None}, ["id is required"]),
    ({"inner": {"b": None}}, ["inner.a is required"]),
    ({"inner": None}, ["inner.a is required"]),
    ({"id": 5}, ["id is not text", "id is unknown"]),
    ({"id": "z"}, ["id is unknown"]),
    ({"n": 4.5}, ["n is not a whole number"]),
    ({"n": "3"}, ["n is not a whole number"]),
    ({"n": 6}, ["n is out of range"]),
    ({"x": "2.5"}, ["x is not a number"]),
    ({"x": -0.5}, ["x is out of range"]), ({"x": 1e300}, ["x is out of range"]),
    ({"ok": "true"}, ["ok is not true or false"]),
    ({"at": "soon"}, ["at is not a time"]), ({"at": 5}, ["at is not a time"]),
    ({"day": "2026-13-01"}, ["day is not a date"]),
    ({"tags": "s"}, ["tags is not a list"]), ({"tags": [1]}, ["tags holds other items"]),
    ({"inner": [1]}, ["inner is not an object", "inner.a is required"]),
    ({"inner": {"a": 1, "z": 2}}, ["inner has unknown fields"]),
    ({"more": 1}, ["record has unknown fields"]),
    ({"other": {"d": 1}}, ["more than one of inner.b, other"]),
    ({"other": {"d": 1}, "inner": {"a": 1}}, []),
])
def test_rules_of_each_kind(spark, change, want):
    df = spark.createDataFrame([(json.dumps({**GOOD, **change}),)], "text string")
    assert rules.check(df, SPEC).first().violations == want


@pytest.mark.parametrize("text", [None, "", "{", "5", "[]", "null", '{"id": "p", "inner": {"a"'])
def test_what_is_no_object(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert rules.check(df, SPEC).first().violations == [rules.BROKEN]


def test_good_records_are_typed_and_bad_ones_keep_their_text(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(GOOD, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({**GOOD, "x": "much"}))
    (tmp_path / "c.json").write_text(json.dumps(GOOD)[:-9])
    good, bad = rules.read_checked(files.read_texts(spark, str(tmp_path)), SPEC)
    row = good.first()
    assert good.count() == 1 and row.file.endswith("a.json") and row.inner.b.c == "t"
    assert good.drop("file").schema == SCHEMA
    assert {r.file[-6:]: r.violations for r in bad.collect()} == {
        "b.json": ["x is not a number"], "c.json": [rules.BROKEN]}


def test_a_written_activity_passes(spark):
    record = {
        "id": "1", "source": "strava", "original_source": "garmin", "activity_type": "cycling",
        "name": None, "start_time": "2026-06-01T10:00:00", "timezone": None,
        "elapsed_time_s": 780.532, "moving_time_s": 700, "calories": 100, "ingested_at":
        "2026-08-04T21:41:53Z", "strength_metrics": None, "raw_file_reference": "1.fit.gz",
        "endurance_metrics": {"distance_m": 5, "gps_track_available": True}}
    df = spark.createDataFrame([(json.dumps(record),)], "text string")
    assert rules.check(df, normalize.activity_spec()).first().violations == []


def test_no_rows(spark):
    df = spark.createDataFrame([], "text string, more int")
    good, bad = rules.read_checked(df, SPEC)
    assert good.count() == bad.count() == 0 and good.columns[0] == "more"


def test_a_record_is_parsed_once_for_all_rules(spark):
    texts = spark.createDataFrame([("{}",), (None,), ('{"id": "1"}',)], "text string")
    good, bad = rules.read_checked(texts, normalize.activity_spec())
    for df in (good, bad):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1
    assert good.isEmpty() and bad.count() == 3
