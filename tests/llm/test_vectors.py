import numpy as np
import pytest

from pyspark.sql import functions as F

from stridelake.llm import ann, topk, vectors as blocks

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def vectors(spark, n=700, width=16, seed=0):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, width)).astype("f4")
    points[5] = points[0]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(7, points[7].tolist()), (900, None), (1000, [0.0] * width), (950, [1.0, None] * 8),
             (1050, [float("nan")] * width), (1100, [float("inf")] * width), (None, [1.0] * width),
             (1200, [1.0, 2.0]), (1201, [1.0, 2.5])]
    return rows, spark.createDataFrame([(*r, 0, "x", "x") for r in rows], SCHEMA)


def good(rows, zero):
    return [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()
            and (zero or any(v))]


def asked(points, every):
    """The vector that each query id asks with."""
    found = {}
    for i, v in points:
        if i % every == 0 and (i not in found or tuple(v) < tuple(found[i])):
            found[i] = v
    return found


@pytest.mark.parametrize("first", [0, 1])
def test_an_id_with_several_vectors_asks_once(spark, first):
    both = [(100, [3.0, 4.0]), (100, [-3.0, 4.0])]
    rows = [both[first], both[1 - first], (1, [-3.0, 3.0]), (2, [3.0, 3.0]), (2, [3.0, 3.0])]
    df = spark.createDataFrame([(*r, 0, "x", "x") for r in rows], SCHEMA)
    near = [tuple(r) for r in ann.search(df).orderBy("rank").collect()]
    assert [r[:3] for r in near] == [(100, 1, 1), (100, 2, 2), (100, 3, 2)] and near[0][3] == 1.0
    high = [tuple(r)[:3] for r in topk.search(df).orderBy("rank").collect()]
    assert high == [(100, 1, 1), (100, 2, 2), (100, 3, 2)]


def test_topk_is_exact(spark):
    rows, df = vectors(spark)
    got = sorted(map(tuple, topk.search(df, per_block=200).collect()))
    want = []
    points = [(i, np.floor(256 * v).astype(int)) for i, v in good(rows, True)]
    for i, q in asked(points, 50).items():
        found = sorted((-int(q @ v), j) for j, v in points if j != i and len(v) == len(q))[:5]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    assert got == sorted(want)


@pytest.mark.parametrize("big", [1e30, -1e17, 1e8])
def test_scores_that_may_not_fit_a_long_are_refused(spark, big):
    rows = [(0, [big, 1.0], 0, "", ""), (1, [1.0, 1.0], 0, "", "")]
    with pytest.raises(ValueError, match="too large"):
        topk.search(spark.createDataFrame(rows, SCHEMA))


def test_equal_rows_are_spread_over_blocks(spark):
    df = spark.range(2000).select(
        F.lit(7).cast("long").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"),
        F.monotonically_increasing_id().alias("row"))
    some, _ = blocks.blocks(df, 50, 100)
    sizes = [r["count"] for r in some.groupBy("block").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 160


def test_cover_tree_covers():
    points = np.random.default_rng(1).normal(size=(500, 3))
    points[100:200] = points[0]
    seen = []

    def check(node):
        away = np.sqrt(((points[node.rows] - node.center) ** 2).sum(1))
        assert away.max() <= node.radius + 1e-9
        if node.children:
            below = np.concatenate([c.rows for c in node.children])
            assert sorted(below) == sorted(node.rows)
            for child in node.children:
                check(child)
        else:
            seen.extend(node.rows)

    check(topk.cover_tree(points))
    assert sorted(seen) == list(range(500))


def test_large_integers_stay_exact():
    rows = np.array([[2 ** 30, 1], [2 ** 30, 2], [1, 1]], np.int64)
    pair = topk.DualTree(rows, np.array([1, 2, 3]), rows[:1], np.array([0]), 2,
                         np.array([np.iinfo(np.int64).min]))
    assert not pair.exact
    pair.walk(topk.cover_tree(pair.q), topk.cover_tree(pair.x))
    assert pair.found[0][0].tolist() == [2 ** 60 + 2, 2 ** 60 + 1]


@pytest.mark.parametrize("per_block", [250, 4096])
def test_ann_recall_and_scores(spark, per_block):
    rows, df = vectors(spark, 1500)
    found = ann.search(df, per_block=per_block).collect()
    points = good(rows, False)
    hit = total = 0
    for i, q in asked(points, 100).items():
        near = sorted((float(np.sqrt(((v - q) ** 2).sum())), j)
                      for j, v in points if j != i and len(v) == len(q))[:10]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == i)
        assert [r[0] for r in mine] == list(range(1, len(near) + 1))
        assert [(s, j) for _, j, s in mine] == sorted((s, j) for _, j, s in mine)
        exact = {j: s for s, j in near}
        hit += sum(j in exact for _, j, _ in mine)
        total += len(near)
        for _, j, s in mine:
            assert j not in exact or abs(s - exact[j]) < 1e-9
    assert hit >= 0.9 * total


def test_footrule_is_that_of_the_definition():
    points = np.random.default_rng(2).normal(size=(60, 5))
    index = ann.PermutationIndex(points, pivots=12, places=6)
    order = ann.nearest_pivots(points, index.pivots, 6)
    query = points[3] + 0.1
    mine = ann.nearest_pivots(query[None], index.pivots, 6)[0].tolist()
    for row, own in zip(index.footrule(query), order.tolist()):
        far = sum(abs((mine.index(p) if p in mine else 6) - (own.index(p) if p in own else 6))
                  for p in range(12))
        assert row == far


def test_empty_and_tiny_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ann.search(none).count() == 0 and topk.search(none).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, "", ""), (1, [0.5, 0.5], 0, "", "")], SCHEMA)
    assert [tuple(r)[:3] for r in ann.search(few).collect()] == [(0, 1, 1)]
    assert [tuple(r) for r in topk.search(few).collect()] == [(0, 1, 1, 256 * 128)]
