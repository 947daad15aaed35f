"""Sources, normalisation, the resumable batch and the file stream on synthetic folders."""

import gzip
import io
import json
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from stridelake import schemas
from stridelake.operators import normalize, quality
from stridelake.sinks import tables
from stridelake.sources import files, lapfiles, listing, payloads
from stridelake.streaming import ingest
from tests.helpers import activities, activity, records, utc

LAP = """<Lap StartTime="2026-06-01T10:00:00Z"><TotalTimeSeconds>600.0</TotalTimeSeconds>
<Calories>100</Calories><AverageHeartRateBpm><Value>0.0</Value></AverageHeartRateBpm>
<Track><Trackpoint><Time>2026-06-01T10:00:00Z</Time><DistanceMeters>1.5</DistanceMeters>
<HeartRateBpm><Value>0.0</Value></HeartRateBpm><Cadence>87.52</Cadence><Extensions>
<TPX xmlns="urn:extension"><Speed>7.5</Speed><Watts>120</Watts></TPX></Extensions></Trackpoint>
<Trackpoint><Time>2026-06-01T10:00:01Z</Time><HeartRateBpm><Value>99.5</Value></HeartRateBpm>
<Cadence>0.0</Cadence></Trackpoint></Track><Extensions><TPX xmlns="urn:extension">
<TotalPower>35519.28</TotalPower></TPX></Extensions></Lap>"""


def xml(inner=LAP, creator="Peloton Bike+", blanks=""):
    return (
        f'{blanks}<?xml version="1.0"?><TrainingCenterDatabase xmlns="urn:training"><Activities>'
        f'<Activity Sport="Biking"><Id>2026-06-01T09:59:00Z</Id>{inner}<Creator><Name>{creator}'
        "</Name></Creator></Activity></Activities></TrainingCenterDatabase>")


def parse(spark, **contents):
    rows = [(name.replace("__", "."), bytearray(
        c if isinstance(c, bytes) else c.encode())) for name, c in contents.items()]
    return payloads.parse_tcx(spark.createDataFrame(rows, "payload string, content binary"))


def test_xml_variants(spark):
    parsed = parse(
        spark, plain__tcx=xml(), blanks__tcx=xml(blanks="    \n"), mark__tcx=xml(blanks="\ufeff"),
        zipped__tcx__gz=gzip.compress(xml(blanks="  ").encode()), broken__tcx__gz=b"not gzip",
        UPPER__TCX__GZ=gzip.compress(xml().encode()), cut__tcx=xml()[:-40],
        no_lap__tcx=xml(inner=""), no_start__tcx=xml(LAP.replace(
            ' StartTime="2026-06-01T10:00:00Z"', "")),
        no_activity__tcx="<TrainingCenterDatabase><Activities/></TrainingCenterDatabase>",
        bad_number__tcx=xml(LAP.replace("600.0", "abc")), empty__tcx="")
    rows = {r.payload: r for r in parsed.files.collect()}
    good = {"plain.tcx", "blanks.tcx", "mark.tcx", "zipped.tcx.gz", "no_start.tcx"}
    assert {k for k, r in rows.items() if r.error is None} == good
    assert rows["no_lap.tcx"].error == lapfiles.NO_LAP
    assert rows["no_activity.tcx"].error == lapfiles.NO_ACTIVITY
    assert rows["no_start.tcx"].start == "2026-06-01T09:59:00Z"
    assert "gzip" in rows["broken.tcx.gz"].error.lower()
    raw = payloads.tcx_to_raw(parsed)
    first = raw.files.where("payload = 'plain.tcx'").first()
    assert first.file_id.manufacturer == "peloton"
    assert first.session.total_work == pytest.approx(35.51928)
    assert (first.session.avg_heart_rate, first.session.total_timer_time) == (None, None)
    points = raw.records.where("payload = 'blanks.tcx'").select("record.*").orderBy("timestamp")
    assert records(points, "heart_rate", "cadence", "speed", "distance", "power") == [
        (None, 88, 7.5, 1.5, 120.0), (100, 0, None, None, None)]


def test_only_the_first_lap_counts_and_no_track_gives_no_points(spark):
    second = "<Lap StartTime='2026-06-01T11:00:00Z'><TotalTimeSeconds>5</TotalTimeSeconds></Lap>"
    parsed = parse(spark, two__tcx=xml(LAP + second), bare__tcx=xml(second))
    raw = payloads.tcx_to_raw(parsed)
    elapsed = {r.payload: r.session.total_elapsed_time for r in raw.files.collect()}
    assert elapsed == {"two.tcx": 600.0, "bare.tcx": 5.0}
    assert {r.payload for r in raw.records.collect()} == {"two.tcx"}
    assert raw.files.where("payload = 'bare.tcx'").first().session.total_work is None


def message(payload, msg_type, seq, **fields):
    return {"payload": payload, "msg_type": msg_type, "seq": seq,
            **{k: (fields if k == msg_type else None) for k in ("file_id", "session", "record")}}


def test_later_messages_override_field_by_field(spark):
    df = spark.createDataFrame([
        message("a", "session", 5, total_calories=9.0),
        message("a", "session", 1, sport="cycling", total_calories=7.0),
        message("a", "file_id", 2, manufacturer="garmin", garmin_product="3122"),
        message("a", "record", 3, position_lat=1, position_long=None),
        message("b", "record", 1, position_lat=2 ** 30, position_long=-(2 ** 29)),
        message("c", "record", 1, distance=5.0),
    ], schemas.MESSAGE)
    raw = payloads.collapse_messages(df)
    by_payload = {r.payload: r for r in raw.files.collect()}
    assert by_payload["a"].session.sport == "cycling"
    assert by_payload["a"].session.total_calories == 9.0
    assert by_payload["a"].file_id.garmin_product == "3122"
    # Half a position, a whole one, and only a distance.
    assert {k: r.has_position for k, r in by_payload.items()} == {"a": False, "b": True, "c": False}
    points = normalize.to_track_points(raw.records.withColumnRenamed("payload", "activity_id"))
    assert {r.activity_id: (r.lat, r.lon) for r in points.collect()} == {
        "a": (2 ** 31 and 180.0 / 2 ** 31, None), "b": (90.0, -45.0), "c": (None, None)}
    assert normalize.conform(points, schemas.TRACK_POINT).schema == schemas.TRACK_POINT


def test_enhanced_fields_win(spark):
    df = spark.createDataFrame([
        message("a", "record", 1, altitude=1.0, enhanced_altitude=2.0, speed=0.0),
    ], schemas.MESSAGE).withColumnRenamed("payload", "activity_id")
    row = normalize.to_track_points(df).first()
    assert (row.altitude_m, row.speed_mps) == (2.0, 0.0)


@pytest.mark.parametrize("maker,sport,block", [
    ("garmin", "Cycling", "endurance_metrics"), ("garmin", "training", "strength_metrics"),
    ("garmin", "fitness_equipment", "class_metrics"), ("garmin", "curling", None),
    ("garmin", "Biking", None), ("peloton", "cycling", "class_metrics"), ("garmin", None, None),
])
def test_metrics_routing(spark, maker, sport, block):
    df = spark.createDataFrame([
        message("1.fit.gz", "file_id", 1, manufacturer=maker),
        message("1.fit.gz", "session", 2, sport=sport, total_distance=5.0, total_work=8.0),
    ], schemas.MESSAGE)
    raw = payloads.collapse_messages(df).files.withColumn("entry", F.col("payload"))
    row = normalize.conform_activity(normalize.to_activity(raw)).first()
    blocks = ("endurance_metrics", "strength_metrics", "class_metrics")
    assert [b for b in blocks if row[b] is not None] == ([block] if block else [])
    assert row.id == "1" and row.activity_type == (sport or "unknown")
    if block == "strength_metrics":
        assert row.strength_metrics.exercises == []


def test_weight_stream(spark, tmp_path):
    path = tmp_path / "w.json"
    user, synced = normalize.WEIGHT_ORIGINS
    point = lambda origin, kg: {
        "originDataSourceId": origin, "startTimeNanos": "1700000000123456789",
        "fitValue": [{"value": {"fpVal": kg}}]}
    path.write_text(json.dumps({"Data Points": [
        point(user, 70.125), point(synced, 70.005), point("other", 1.0)]}))
    raw = spark.read.schema(schemas.WEIGHT_STREAM).option("multiLine", True).json(str(path))
    good, unknown = quality.split_ok(normalize.normalize_weight(raw))
    assert sorted(records(good, "original_source", "weight_kg", "weight_lb")) == [
        ("google_fit_manual_entry", 70.12, 154.6), ("hevy", round(70.005, 2), 154.3)]
    assert unknown.count() == 1
    with pytest.raises(Exception, match="unrecognized value: other"):
        normalize.normalize_weight(raw, strict=True).collect()


INDEX = (
    'Activity Date,Activity Name,Activity Type,Elapsed Time,Filename,Elapsed Time\n'
    '"Jun 1, 2026, 6:15:00 AM","""A"" Trainer Session 3 ❤",Weight Training,9,,300\n'
    '"Jun 2, 2026, 6:15:00 PM","Week 1\nDay 2",Weight Training,9,,3603\n'
    '"May 2, 2026, 6:15:00 PM",Old,Weight Training,,,\n'
    'soon,Odd,Weight Training,,,\n'
    '"Jun 3, 2026, 6:15:00 PM",Morning,Ride,10,activities/1.fit.gz,1\n'
    '"Jun 3, 2026, 6:15:00 PM",Evening,Ride,10,activities/1.fit.gz,1\n')


def test_index_csv(spark, tmp_path):
    path = tmp_path / "activities.csv"
    path.write_text(INDEX, encoding="utf-8")
    index = files.read_activity_index(spark, str(path))
    lifts = normalize.strength_sessions(index, "2026-06-01").orderBy("start")
    assert records(lifts, "name", "minutes", "logged_minutes", "trainer_led") == [
        ('"A" Trainer Session 3', 60.0, 5.0, True), ("Week 1\nDay 2", 60.0, None, False)]  # 60.05 lies below the tie
    assert normalize.strength_sessions(index).count() == 3
    names = ingest.lookup.dedupe_lookup(index)
    assert records(names) == [("1.fit.gz", "Evening")]
    missing = files.read_activity_index(spark, str(tmp_path / "none.csv"))
    assert missing.isEmpty() and missing.columns == index.columns
    path.write_text("Filename,Activity Name\n1.fit,Short\n")
    assert files.read_activity_index(spark, str(path)).first()["Activity Type"] is None


def test_activity_records_are_read_by_schema(spark, tmp_path):
    for i, suffix in enumerate(("", "Z")):
        (tmp_path / f"{i}.json").write_text(json.dumps({
            "id": str(i), "start_time": "2026-06-01T10:00:00" + suffix, "timezone": None,
            "endurance_metrics": {"distance_m": 5, "gps_track_available": True},
            "class_metrics": None}, indent=2))
    df = files.read_activities(spark, str(tmp_path / "*.json"))
    assert df.schema.simpleString() == schemas.ACTIVITY.simpleString()
    assert {r.start_time.isoformat() for r in df.collect()} == {"2026-06-01T10:00:00"}
    tables.compact(df, str(tmp_path / "table"), tables.activity_partitions())
    assert files.read_activity_table(spark, str(tmp_path / "table")).count() == 2


def test_triage(spark):
    paths = ["1.fit.gz", "2.GPX", "3.txt", "empty/", "f/z.fit", "f/a/b.TCX", "g/x.gpx", ".gitkeep"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.entry: (r.payload, r.status) for r in listing.triage_entries(df).collect()}
    assert got == {
        "1.fit.gz": ("1.fit.gz", "parse"), "2.GPX": (None, "skipped"), "3.txt": (None, "failed"),
        "empty": (None, "skipped"), "f": ("f/a/b.TCX", "parse"), "g": (None, "skipped")}


@pytest.fixture
def store(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "100.fit.gz").write_bytes(b"decoded elsewhere")
    (folder / "101.fit.gz").write_bytes(b"nothing decoded")
    (folder / "102.tcx.gz").write_bytes(gzip.compress(xml(blanks="  ").encode()))
    (folder / "103.gpx").write_text("x")
    (folder / "Processed").mkdir()
    (folder / ".gitkeep").write_text("")
    spark.createDataFrame([
        message("100.fit.gz", "file_id", 0, manufacturer="garmin"),
        message("100.fit.gz", "session", 1, sport="cycling", start_time=utc("2026-06-02 10:00:00"),
                total_elapsed_time=780.532),
        message("100.fit.gz", "record", 2, timestamp=utc("2026-06-02 10:00:00"), heart_rate=100),
    ], schemas.MESSAGE).write.parquet(str(tmp_path / "messages"))
    (tmp_path / "activities.csv").write_text(
        "Filename,Activity Name,Activity Type,Activity Date,Elapsed Time\n"
        "activities/102.tcx.gz,Evening class,Ride,,\n")
    return ingest.Store(
        inputs=str(folder), activities=str(tmp_path / "acts"), tracks=str(tmp_path / "tracks"),
        ledger=str(tmp_path / "ledger"), index=str(tmp_path / "activities.csv"),
        messages=str(tmp_path / "messages"), checkpoint=str(tmp_path / "progress"))


def stored_names(spark, store):
    return {r.id: r.name for r in ingest.read_activities(spark, store).collect()}


def test_batch_isolates_bad_entries_and_resumes(spark, store):
    summary = ingest.run_batch(spark, store, batch_id="first").first()
    assert summary.asDict() == dict(
        batch_id="first", attempted=5, succeeded=2, failed=1, skipped=2)
    assert stored_names(spark, store) == {"100": None, "102": "Evening class"}
    assert ingest.read_tracks(spark, store).count() == 3
    bad = quality.quarantine(ingest.read_ledger(spark, store.ledger))
    assert {(r.entry, r.status) for r in bad.collect()} == {
        ("101.fit.gz", "failed"), ("103.gpx", "skipped"), ("Processed", "skipped")}

    # What failed is tried again, what is done is not.
    spark.createDataFrame([
        message("101.fit.gz", "session", 1, sport="cycling", start_time=utc("2026-06-02"))],
        schemas.MESSAGE).write.mode("append").parquet(store.messages)
    summary = ingest.run_batch(spark, store, batch_id="second").first()
    assert (summary.attempted, summary.succeeded) == (1, 1)
    assert set(stored_names(spark, store)) == {"100", "101", "102"}
    assert ingest.run_batch(spark, store, batch_id="third").isEmpty()


def test_two_entries_with_one_id(spark, store, tmp_path):
    (tmp_path / "in" / "100.tcx").write_text(xml())
    summary = ingest.run_batch(spark, store, batch_id="both").first()
    assert summary.succeeded == 3
    kept = ingest.read_activities(spark, store).where("id = '100'").collect()
    assert [r.raw_file_reference for r in kept] == ["100.tcx"]
    points = ingest.read_tracks(spark, store).where("activity_id = '100'").collect()
    assert sorted(p.cadence for p in points) == [0, 88]


def test_batch_size_and_missing_index(spark, store, tmp_path):
    bare = ingest.Store(**{**vars(store), "index": str(tmp_path / "none.csv")})
    summary = ingest.run_batch(spark, bare, batch_size=3, batch_id="b1").first()
    assert (summary.attempted, summary.succeeded, summary.failed) == (3, 2, 1)
    assert stored_names(spark, bare) == {"100": None, "102": None}


def test_repeated_batch_changes_nothing(spark, store):
    ingest.run_batch(spark, store, batch_id="one")
    tracks = ingest.read_tracks(spark, store).count()
    fresh = ingest.Store(**{**vars(store), "ledger": store.ledger + "_lost"})
    ingest.run_batch(spark, fresh, batch_id="one")
    assert ingest.read_tracks(spark, store).count() == tracks
    assert len(stored_names(spark, store)) == 2


def test_the_name_of_a_batch_that_ended_is_taken(spark, store, tmp_path):
    ingest.run_batch(spark, store, batch_id="one")
    (tmp_path / "in" / "9.tcx").write_text(xml())
    with pytest.raises(ValueError, match="already"):
        ingest.run_batch(spark, store, batch_id="one")
    assert set(stored_names(spark, store)) == {"100", "102"}


@pytest.mark.parametrize("step", ["track_table", "activity_table", "ledger_table"])
def test_a_batch_that_dies_is_made_again(spark, store, monkeypatch, step):
    class Died(Exception):
        pass

    class Dying:
        def __init__(self, table):
            self.table = table

        def __getattr__(self, name):
            return getattr(self.table, name)

        def store(self, *_):
            raise Died

    before = getattr(ingest.Store, step).fget
    with monkeypatch.context() as m:
        m.setattr(ingest.Store, step, property(lambda self: Dying(before(self))))
        with pytest.raises(Died):
            ingest.run_batch(spark, store, batch_id="one")
    summary = ingest.run_batch(spark, store, batch_id="one").first()
    assert (summary.attempted, summary.succeeded) == (5, 2)
    assert set(stored_names(spark, store)) == {"100", "102"}
    assert ingest.read_tracks(spark, store).count() == 3


def test_stream_of_files(spark, store):
    ingest.run_available_now(spark, store, max_files=2)
    assert set(stored_names(spark, store)) == {"100", "102"}
    ledger = ingest.read_ledger(spark, store.ledger)
    assert {(r.entry, r.status) for r in ledger.collect()} == {
        ("100.fit.gz", "succeeded"), ("101.fit.gz", "failed"), ("102.tcx.gz", "succeeded"),
        ("103.gpx", "skipped")}
    assert ledger.select("batch_id").distinct().count() > 1
    ingest.run_available_now(spark, store)
    assert len(stored_names(spark, store)) == 2


def test_names_that_a_scan_hides_are_ingested(spark, store, tmp_path):
    for name in ("_7.tcx", ".8.tcx", "_folder/9.tcx"):
        (tmp_path / "in" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(xml())
    (tmp_path / "in" / "_notes.txt").write_text("x")
    summary = ingest.run_batch(spark, store, batch_id="hidden").first()
    assert (summary.attempted, summary.succeeded, summary.failed) == (9, 5, 2)
    ledger = {r.entry: r.status for r in ingest.read_ledger(spark, store.ledger).collect()}
    assert {ledger[n] for n in ("_7.tcx", ".8.tcx", "_folder")} == {"succeeded"}
    assert ledger["_notes.txt"] == "failed" and ".gitkeep" not in ledger


def test_paths_are_cut_at_the_first_root(spark, tmp_path):
    root = tmp_path / "in"
    inner = root / "x" / str(root).lstrip("/")
    inner.mkdir(parents=True)
    (inner / "y.tcx").write_text(xml())
    (root / "hollow").mkdir()
    found = {r.path: r.length for r in listing.list_tree(spark, str(root)).collect()}
    want = f"x{root}/y.tcx"
    assert found[want] == len(xml()) and found["hollow/"] is None and found["x/"] is None
    assert set(found) == {want, "hollow/"} | {
        "/".join(want.split("/")[:n]) + "/" for n in range(1, want.count("/") + 1)}
    names = spark.createDataFrame([(want,)], "payload string")
    read = payloads.read_tcx(names, f"file://{root}")
    assert [(r.payload, r.error) for r in read.files.collect()] == [(want, None)]
    assert read.points.count() == 2


def test_files_are_opened_by_their_exact_names(spark, tmp_path):
    names = ["ride[1].tcx", "a b*.tcx", "{x,y}.tcx", "%41?#.tcx", "ü\n.tcx", "gone.tcx"]
    for name in names[:-1]:
        (tmp_path / name).write_text(xml())
    read = payloads.read_tcx(
        spark.createDataFrame([(n,) for n in names], "payload string"), str(tmp_path))
    errors = {r.payload: r.error for r in read.files.collect()}
    assert set(errors) == set(names)
    assert {n for n, e in errors.items() if e} == {"gone.tcx"}
    assert "could not be read" in errors["gone.tcx"]


def test_only_folders_of_wanted_payloads_are_read(spark, tmp_path):
    path = str(tmp_path / "messages")
    rows = [message(f"{i}.fit", "record", n, distance=float(n)) for i in range(60) for n in (1, 2)]
    for part in (rows[:50], rows[50:]):
        payloads.write_messages(spark.createDataFrame(part, schemas.MESSAGE), path)
    wanted = spark.createDataFrame([("7.fit",), ("31.fit",), ("none.fit",)], "payload string")
    found = payloads.read_messages(spark, path, wanted)
    assert sorted(r.payload for r in found.collect()) == ["31.fit"] * 2 + ["7.fit"] * 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN", plan)
    nothing = payloads.read_messages(spark, path, wanted.where("false"))
    assert nothing.count() == 0


def points(n):
    return "".join(f"<Trackpoint><Time>2026-06-01T10:00:00Z</Time><Cadence>{i % 200}</Cadence>"
                   "</Trackpoint>" for i in range(n))


def lap_of(n, end="</TrainingCenterDatabase>"):
    return ("<TrainingCenterDatabase><Activities><Activity Sport='Biking'><Id>x</Id>"
            f"<Lap StartTime='2026-06-01T10:00:00Z'><Track>{points(n)}</Track></Lap></Activity>"
            f"</Activities>{end}")


@pytest.mark.parametrize("held", [1, 7, 20_000])
def test_long_files_leave_in_batches_and_broken_ones_leave_nothing(spark, monkeypatch, held):
    monkeypatch.setattr(lapfiles, "HELD", held)
    monkeypatch.setattr(lapfiles, "PIECE", 501)
    whole, cut, zipped = lap_of(40).encode(), lap_of(40, "").encode(), gzip.compress(
        lap_of(30).encode())
    given = {"whole.tcx": whole, "cut.tcx": cut, "z.tcx.gz": zipped, "half.tcx.gz": zipped[:-9],
             "two.tcx.gz": gzip.compress(whole[:99]) + gzip.compress(whole[99:])}

    def opened():
        for name, data in given.items():
            yield name, lambda data=data: io.BytesIO(data)

    batches = list(lapfiles.rows(opened()))
    assert all(b.num_rows <= held + 20 for b in batches)
    rows = [r for b in batches for r in b.to_pylist()]
    errors = {r["payload"]: r["error"] for r in rows if r["is_file"]}
    assert errors == {"whole.tcx": None, "cut.tcx": lapfiles.MALFORMED, "z.tcx.gz": None,
                      "half.tcx.gz": "gzip stream ends early", "two.tcx.gz": None}
    found = {}
    for r in rows:
        if not r["is_file"]:
            found.setdefault(r["payload"], []).append(r["cadence"])
    assert found == {"whole.tcx": list(range(40)), "z.tcx.gz": list(range(30)),
                     "two.tcx.gz": list(range(40))}


def test_memory_does_not_grow_with_a_file():
    class Endless:
        """A file of a given number of samples that is made while it is read."""

        def __init__(self, n):
            head, _, tail = lap_of(1).partition(points(1))
            self.left, self.next = n, [head.encode()]
            self.tail, self.piece = tail.encode(), points(1).encode() * 1000

        def read(self, size):
            if self.next:
                return self.next.pop()
            if self.left > 0:
                self.left -= 1000
                return self.piece
            tail, self.tail = self.tail, b""
            return tail

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

    tracemalloc.start()
    rows = sum(b.num_rows for b in lapfiles.rows(iter([("e.tcx", lambda: Endless(400_000))])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 400_001 and peak < 60e6


def test_over_long_files_are_rows_with_a_reason(monkeypatch):
    monkeypatch.setattr(lapfiles, "LONGEST_FILE", 10_000)
    bomb = gzip.compress(b" " * 10_000_000)
    rows = [r for b in lapfiles.rows(iter([("b.tcx.gz", lambda: io.BytesIO(bomb))]))
            for r in b.to_pylist()]
    assert [(r["payload"], r["error"]) for r in rows] == [("b.tcx.gz", "payload is too long")]


def test_an_empty_folder_that_is_filled_later_is_ingested(spark, store, tmp_path):
    ingest.run_batch(spark, store, batch_id="one")
    (tmp_path / "in" / "Processed" / "9.tcx").write_text(xml())
    (tmp_path / "in" / "103.gpx").write_text("changed, but never a payload")
    summary = ingest.run_batch(spark, store, batch_id="two").first()
    assert (summary.attempted, summary.succeeded, summary.failed, summary.skipped) == (2, 1, 1, 0)
    assert set(stored_names(spark, store)) == {"100", "102", "Processed"}


def test_a_changed_payload_is_read_again(spark, store, tmp_path):
    ingest.run_batch(spark, store, batch_id="one")
    late = xml().replace("2026-06-01T10:00:00Z", "2026-06-03T10:00:00Z")
    (tmp_path / "in" / "102.tcx.gz").write_bytes(gzip.compress(late.encode()))
    summary = ingest.run_batch(spark, store, batch_id="two").first()
    assert (summary.attempted, summary.succeeded) == (2, 1)  # with the one that failed
    starts = {r.id: r.start_time.day for r in ingest.read_activities(spark, store).collect()}
    assert starts == {"100": 2, "102": 3}
    days = {(r.activity_id, r.timestamp.day) for r in ingest.read_tracks(spark, store).collect()}
    assert days == {("100", 2), ("102", 3), ("102", 1)}  # its second sample kept its time


@pytest.mark.parametrize("how", ["one", "many", "batch", "batches"])
def test_batch_borders_choose_no_winner(spark, store, tmp_path, how):
    for name, creator in (("7.tcx.gz", "last by name"), ("7.tcx", "first by name"),
                          ("8/b.tcx", "second in folder"), ("8/a.tcx", "first in folder"),
                          ("8.tcx.gz", "file beside the folder")):
        path = tmp_path / "in" / name
        path.parent.mkdir(exist_ok=True)
        data = xml(creator=creator).encode()
        path.write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    if how in ("one", "many"):
        ingest.run_available_now(spark, store, max_files=1 if how == "one" else 100)
    elif how == "batch":
        ingest.run_batch(spark, store, batch_id="all")
    else:
        for n in range(9):
            ingest.run_batch(spark, store, batch_size=2 + n, batch_id=f"b{n}")
    got = {r.id: (r.raw_file_reference, r.original_source)
           for r in ingest.read_activities(spark, store).collect()}
    assert got == {
        "100": ("100.fit.gz", "garmin"), "102": ("102.tcx.gz", "peloton"),
        "7": ("7.tcx.gz", "last by name"), "8": ("8.tcx.gz", "file beside the folder")}
    counts = ingest.read_tracks(spark, store).groupBy("activity_id").count().collect()
    assert {r.activity_id: r["count"] for r in counts} == {"100": 1, "102": 2, "7": 2, "8": 2}


def test_an_activity_that_comes_back_without_samples_loses_its_track(spark, store, tmp_path):
    ingest.run_batch(spark, store, batch_id="one")
    second = ingest.Store(**{**vars(store), "ledger": store.ledger + "_lost"})
    bare = xml('<Lap StartTime="2026-06-01T10:00:00Z"><TotalTimeSeconds>5</TotalTimeSeconds></Lap>')
    (tmp_path / "in" / "102.tcx.gz").write_bytes(gzip.compress(bare.encode()))
    ingest.run_batch(spark, second, batch_id="two")
    points = ingest.read_tracks(spark, store).collect()
    assert {p.activity_id for p in points} == {"100"}


def test_files_are_parsed_by_many_tasks_however_short_their_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lapfiles, "DEALT", 4)
    for n in range(64):
        (tmp_path / f"{n}.tcx").write_text(xml())
    names = spark.createDataFrame([(f"{n}.tcx",) for n in range(64)], "payload string")
    rows = lapfiles.parse_stored(names, str(tmp_path)).select("payload", F.spark_partition_id())
    found = rows.collect()
    assert len({task for _, task in found}) > 8
    assert len(found) == 64 * 3 and len({payload for payload, _ in found}) == 64
