"""Tables that grow by versions: order decides, repeats and crashes change nothing."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from stridelake.sinks import tables

ROW = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("v", T.LongType()),
    T.StructField("rank", T.LongType())])
POINT = T.StructType([T.StructField("key", T.StringType()), T.StructField("rank", T.LongType()),
                      T.StructField("x", T.LongType())])


def table(path):
    return tables.Table(str(path), ROW, "id", ("rank",), {"part": F.col("rank") % 2})


def rows(spark, *given):
    return spark.createDataFrame(list(given), ROW)


def held(spark, some):
    return sorted(map(tuple, some.read(spark).collect()), key=str)


def test_the_last_by_order_counts(spark, tmp_path):
    some = table(tmp_path)
    assert held(spark, some) == []
    some.store(rows(spark, ("a", 1, 5), ("a", 2, 7), ("a", 3, 6), ("b", 4, None), (None, 5, 1)), "x")
    assert held(spark, some) == [("a", 2, 7), ("b", 4, None), (None, 5, 1)]
    some.store(rows(spark, ("a", 9, 6), ("b", 9, 0), ("c", 9, 0), (None, 6, 0)), "y")
    want = [("a", 2, 7), ("b", 9, 0), ("c", 9, 0), (None, 5, 1)]
    assert held(spark, some) == want
    some.compact(spark)
    assert held(spark, some) == want
    some.store(rows(spark, ("a", 8, 8), (None, 8, 8), ("b", 1, None)), "z")
    assert held(spark, some) == [("a", 8, 8), ("b", 9, 0), ("c", 9, 0), (None, 8, 8)]


def test_a_batch_that_comes_again_replaces_what_it_brought(spark, tmp_path):
    some = table(tmp_path)
    some.store(rows(spark, ("a", 1, 1), ("b", 1, 1)), "x")
    some.store(rows(spark, ("a", 0, 0)), "x")
    assert held(spark, some) == [("a", 0, 0)]


def test_the_deal_to_batches_does_not_matter(spark, tmp_path):
    rng = random.Random(2)
    given = [(rng.choice("abcdef"), i, rng.randint(0, 9)) for i in range(60)]
    results = []
    for case in range(3):
        some = table(tmp_path / str(case))
        rng.shuffle(given)
        for n in range(0, 60, 20):
            some.store(rows(spark, *given[n:n + 20]), str(n))
            if case == n / 20:
                some.compact(spark)
        results.append(held(spark, some))
    assert results[0] == results[1] == results[2] and len(results[0]) == 6


STEPS = ["write_partitioned", "commit", "rename"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("action", ["store", "compact"])
def test_a_crash_changes_nothing_and_the_rerun_ends_it(spark, tmp_path, monkeypatch, step, action):
    some = table(tmp_path)
    some.store(rows(spark, ("a", 1, 1), ("b", 1, 1)), "x")
    some.store(rows(spark, ("a", 2, 2)), "y")
    before = held(spark, some)

    def act():
        some.store(rows(spark, ("b", 3, 3)), "z") if action == "store" else some.compact(spark)

    class Died(Exception):
        pass

    def die(*_):
        raise Died

    with monkeypatch.context() as m:
        if step == "write_partitioned":
            write = tables.write_partitioned
            m.setattr(tables, "write_partitioned", lambda *a: (write(*a), die()))
        elif step == "commit":
            m.setattr(tables.Versions, "commit", die)
        else:  # the commit is written, but not in place
            m.setattr(tables.Versions, "_put_in_place", die)
        with pytest.raises(Died):
            act()
    assert held(spark, some) == before
    act()
    want = [("a", 2, 2), ("b", 3, 3)] if action == "store" else before
    assert held(spark, some) == want
    tables.Versions(spark, str(tmp_path)).vacuum()
    assert held(spark, some) == want
    folders = {p.name for p in (tmp_path / "data").iterdir()}
    assert folders == {f.rpartition("/")[2] for f in tables.Versions(
        spark, str(tmp_path)).live().values()}


def test_a_second_writer_is_turned_away(spark, tmp_path):
    some = table(tmp_path)
    some.store(rows(spark, ("a", 1, 1)), "x")
    versions = tables.Versions(spark, str(tmp_path))
    seen = versions._commits()
    some.store(rows(spark, ("b", 1, 1)), "y")
    versions._commits = lambda: seen
    with pytest.raises(Exception, match="FileAlreadyExists|already exists"):
        versions.commit({})
    assert held(spark, some) == [("a", 1, 1), ("b", 1, 1)]


def test_details_count_while_their_owner_does(spark, tmp_path):
    owner = table(tmp_path / "owner")
    details = tables.Details(str(tmp_path / "details"), POINT, "key", owner, {})

    def put(batch, owners, points):
        details.store(spark.createDataFrame(points, POINT), batch)
        owner.store(rows(spark, *owners), batch)

    def there():
        return sorted(map(tuple, details.read(spark).collect()))

    put("x", [("a", 0, 1), ("b", 0, 1)], [("a", 1, 1), ("a", 1, 2), ("b", 1, 3), ("none", 1, 4)])
    assert there() == [("a", 1, 1), ("a", 1, 2), ("b", 1, 3)]
    put("y", [("a", 0, 2)], [])
    assert there() == [("b", 1, 3)]
    put("z", [("b", 0, 0), ("a", 0, 2)], [("b", 0, 9), ("a", 2, 5)])
    assert there() == [("a", 2, 5), ("b", 1, 3)]
    details.compact(spark)
    assert there() == [("a", 2, 5), ("b", 1, 3)]


def test_a_log_keeps_all_rows(spark, tmp_path):
    log = tables.Log(str(tmp_path), ROW)
    log.store(rows(spark, ("a", 1, 1)), "x")
    log.store(rows(spark, ("a", 1, 1), ("b", 1, 1)), "y")
    log.store(rows(spark, ("c", 1, 1)), "x")
    log.compact(spark)
    assert sorted(r.id for r in log.read(spark).collect()) == ["a", "b", "c"]
