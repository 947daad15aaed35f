"""Bundles of a stream against those of the whole table."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from stridelake import schemas
from stridelake.operators import sessions
from stridelake.streaming import bundles
from tests.helpers import activities, activity, utc


def rides(n=160, seed=5):
    rng = random.Random(seed)
    base = utc("2026-03-01")
    made = []
    for i in range(n):
        start = base + timedelta(minutes=rng.choice([0, 3, 9, 11, 40]) + 12 * rng.randint(0, 500))
        made.append(activity(i, start, athlete_id=rng.choice([0, 0, 0, 1, 2 ** 60 + 1, None]),
                             elapsed_time_s=float(rng.choice([30, 600, 1200]))))
    return made


def batches(rows, n, rng):
    """Rows in order of an arrival up to a day after their start, in ``n`` batches."""
    late = sorted(rows, key=lambda r: r["start_time"] + timedelta(hours=24 * rng.random()))
    size = -(-len(late) // n)
    return [late[i:i + size] for i in range(0, len(late), size)]


def heartbeat(at):
    return {**activity(0, at), "id": None, "athlete_id": None}


@pytest.mark.parametrize("seed", [1, 2])
def test_a_stream_places_rides_like_the_whole_table(spark, tmp_path, seed):
    rows, (source, out, progress) = rides(seed=seed), (
        str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(some):
        activities(spark, *some).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.ACTIVITY).parquet(source)
        bundles.bundles_available_now(stream, out, progress, delay="2 days")

    def placed():
        return sorted(map(tuple, bundles.read_placed(spark, out).collect()), key=str)

    for some in batches(rows, 3, random.Random(seed)):
        arrive(some)
        assert len(placed()) < len(rows)  # the latest rides may still get one before them
    arrive([heartbeat("2026-06-01")])
    whole = sessions.bundle_by_gap(activities(spark, *rows)).select(
        "athlete_id", "id", "start", "bundle_start")
    assert placed() == sorted(map(tuple, whole.collect()), key=str)
    stream = spark.readStream.schema(schemas.ACTIVITY).parquet(source)
    bundles.bundles_available_now(stream, out, progress, delay="2 days")  # nothing new
    assert len(placed()) == len(rows)


def test_state_goes_when_rides_are_settled(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for some in ([activity(1, "2026-03-01"), activity(2, "2026-03-02")],
                 [heartbeat("2026-03-20")], [activity(3, "2026-03-01 00:05:00")]):
        activities(spark, *some).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.ACTIVITY).parquet(source)
        bundles.bundles_available_now(stream, out, progress, delay="1 day")
    # The third ride came after the watermark.
    assert {r.id for r in bundles.read_placed(spark, out).collect()} == {"1", "2"}
    assert bundles.read_placed(spark, out).where(F.col("start") != F.col("bundle_start")).isEmpty()


def test_many_athletes_are_settled_in_few_calls(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = [activity(f"{a}-{n}", utc("2026-03-01") + timedelta(minutes=7 * n + a % 5),
                     athlete_id=a, elapsed_time_s=60.0 * (n % 3))
            for a in range(40) for n in range(30)]
    activities(spark, *rows, heartbeat("2026-06-01")).write.parquet(source)
    stream = spark.readStream.schema(schemas.ACTIVITY).parquet(source)
    placed = bundles.stream_bundles(stream, "1 day", shares=3)
    query = placed.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()
    held = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    assert 0 < held < 40  # one value per athlete before
    whole = sessions.bundle_by_gap(activities(spark, *rows)).select(
        "athlete_id", "id", "start", "bundle_start")
    assert sorted(map(tuple, bundles.read_placed(spark, out).collect())) == sorted(
        map(tuple, whole.collect()))
