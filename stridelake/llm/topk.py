"""Exact top-k inner products by a dual-tree search over cover trees.

Rows and queries are dealt into blocks, and each block gets a cover tree: a node stands for points
within a radius of its center, its children cover them with half the radius and centers further
apart than that. Two trees are walked together. The score of any query below one node with any row
below another is at most

    <cq, cr> + rq |cr| + rr |cq| + rq rr

for centers c and covering radii r. Where that is below the worst k-th score among the node's
queries, the pair of nodes is pruned with all that stands below it.

Spark walks in two rounds. First every block of queries meets one block of rows, which gives each
query a k-th score. Then it meets the other blocks and starts from these scores, so most of the
walk ends early and a block only reports rows that beat them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stridelake.llm import vectors
from stridelake.llm.common import matrix
from stridelake.session import materialize

FOUND = "query_id long, query long, vec_id long, score long"
LEAF = 64
PER_BLOCK = 2048
EXACT = 2.0 ** 53  # doubles hold integers below this exactly


@dataclass
class Node:
    """Points within ``radius`` of ``center``: ``rows`` of a leaf, or those of the children."""

    center: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)

    @property
    def norm(self) -> float:
        return float(np.sqrt(self.center @ self.center))


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """The cover tree of ``points``; nodes of ``LEAF`` points or of one place are leaves.

    Children are chosen greedily: the first point that no child covers becomes the next center.
    Children that cover nothing but their center are kept together as one leaf.
    """
    rows = np.arange(len(points)) if rows is None else rows
    center = points[rows[0]]
    away = np.sqrt(((points[rows] - center) ** 2).sum(axis=1))
    node = Node(center, float(away.max()), rows)
    if len(rows) <= LEAF or node.radius == 0:
        return node
    half, left, alone = node.radius / 2, rows, []
    while len(left):
        near = np.sqrt(((points[left] - points[left[0]]) ** 2).sum(axis=1)) <= half
        if near.sum() == 1:
            alone.append(left[0])
        else:
            node.children.append(cover_tree(points, left[near]))
        left = left[~near]
    if alone:
        few = np.array(alone)
        mean = points[few].mean(axis=0)
        spread = np.sqrt(((points[few] - mean) ** 2).sum(axis=1))
        node.children.append(Node(mean, float(spread.max()), few))
    return node


class DualTree:
    """Walks the trees of a block of queries and a block of rows."""

    def __init__(self, rows, ids, queries, query_ids, k, at_least):
        self.rows, self.ids, self.queries, self.query_ids, self.k = rows, ids, queries, query_ids, k
        largest = max(np.abs(rows).max(initial=0), np.abs(queries).max(initial=0))
        # Integer products are exact in doubles while they are small; else longs multiply.
        self.exact = float(largest) ** 2 * max(1, rows.shape[1]) < EXACT
        self.x, self.q = (rows.astype(np.float64), queries.astype(np.float64))
        self.worst = at_least.astype(np.float64)  # of each query: a score it has k times already
        self.found = [([], []) for _ in query_ids]

    def bound(self, a: Node, b: Node) -> float:
        most = a.center @ b.center + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return float(most) + 1e-9 * (abs(most) + 1)

    def walk(self, a: Node, b: Node) -> None:
        if self.bound(a, b) < self.worst[a.rows].min():
            return
        if not a.children and not b.children:
            self.compare(a.rows, b.rows)
        elif not b.children or (a.children and a.radius > b.radius):
            for child in a.children:
                self.walk(child, b)
        else:
            for child in sorted(b.children, key=lambda c: -self.bound(a, c)):
                self.walk(a, child)

    def compare(self, asked: np.ndarray, rows: np.ndarray) -> None:
        if self.exact:
            scores = (self.q[asked] @ self.x[rows].T).astype(np.int64)
        else:
            scores = self.queries[asked] @ self.rows[rows].T
        ids = self.ids[rows]
        for i, line in zip(asked, scores, strict=True):
            good = np.flatnonzero((line >= self.worst[i]) & (ids != self.query_ids[i]))
            if not len(good):
                continue
            old_scores, old_ids = self.found[i]
            score = np.concatenate([np.array(old_scores, np.int64), line[good]])
            where = np.concatenate([np.array(old_ids, np.int64), ids[good]])
            top = np.lexsort((where, -score))[:self.k]
            self.found[i] = (score[top], where[top])
            if len(top) == self.k:
                self.worst[i] = max(self.worst[i], score[top[-1]])


def search(
    rows: DataFrame, k: int = 5, every: int = 50, scale: int = 256, vec_id: str = "vec_id",
    vector: str = "embedding", per_block: int = PER_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products, exactly.

    Components count as ``floor(scale * x)``. Where the components are so large that a score might
    not fit a long, the search fails before it begins. Queries are the rows
    whose id is divisible by ``every``; rows with a query's id are none of its candidates. Null
    vectors, those with a null or non-finite component and rows without an id take no part.
    Repeated rows count each as candidates. An id asks once: if its rows hold several (integer)
    vectors, with the smallest by its components in order. Ties go to the smaller id. With fewer candidates all are returned; an empty table gives no rows. Only the
    two named columns are read.
    """
    points = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("raw"))
    scaled = F.transform(F.col("raw").cast("array<double>"), lambda x: x * float(scale))
    points = points.where(F.col("vec_id").isNotNull() & vectors.finite("raw")).select(
        "vec_id", F.transform(scaled, lambda x: F.floor(x)).alias("v"),
        F.array_max(F.transform(scaled, lambda x: F.abs(x))).alias("most"),
        F.monotonically_increasing_id().alias("row"))
    points = materialize(points, "integer-vectors")
    most, size = points.agg(F.max("most"), F.max(F.size("v"))).first()
    if ((most or 0.0) + 1) ** 2 * (size or 0) >= 2.0 ** 63:
        raise ValueError("components are too large: a score might not fit a long")
    points = points.drop("most")

    def compare(some: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if some.num_rows and asked.num_rows:
            width = some["size"][0].as_py()
            order = np.argsort(some["vec_id"].to_numpy(), kind="stable")
            x = matrix(some["v"], width, np.int64)[order]
            q = matrix(asked["v"], width, np.int64)
            floor = np.array([
                np.iinfo(np.int64).min if s is None else s for s in asked["at_least"].to_pylist()])
            pair = DualTree(x, some["vec_id"].to_numpy()[order], q,
                            asked["vec_id"].to_numpy(), k, floor)
            pair.walk(cover_tree(pair.q), cover_tree(pair.x))
            for i, (scores, ids) in enumerate(pair.found):
                out["query_id"] += [asked["vec_id"][i].as_py()] * len(ids)
                out["query"] += [asked["query"][i].as_py()] * len(ids)
                out["vec_id"] += list(map(int, ids))
                out["score"] += list(map(int, scores))
        return pa.table({c: pa.array(values, pa.int64()) for c, values in out.items()})

    some, asked = vectors.blocks(points, every, per_block)
    asked = asked.withColumn("query", F.xxhash64("v"))
    home = F.col("block") == F.lit(0)
    first = materialize(
        vectors.meet(some.where(home), asked.where(home).withColumn(
            "at_least", F.lit(None).cast("long")), compare, FOUND), "first-round")
    kth = first.groupBy("query_id", "query").agg(
        F.min("score").alias("at_least"), F.count("*").alias("rows"))
    kth = kth.where(F.col("rows") >= k).select(
        F.col("query_id").alias("vec_id"), "query", "at_least")
    second = vectors.meet(
        some.where(~home), asked.where(~home).join(kth, ["vec_id", "query"], "left"),
        compare, FOUND)
    return vectors.best(first.unionByName(second), k, F.desc("score"))
