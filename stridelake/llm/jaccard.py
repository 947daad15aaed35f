"""Exact n-gram Jaccard join by set relations.

Two documents link when the Jaccard similarity of their sets of word shingles reaches a threshold.
The join returns every document's component under links; it loses no link between different sets,
has no cap and draws no sample.

1. Sets. A set is an array of 64-bit shingle hashes. Documents with one set (same 128-bit digest)
   form a class, and one class is one node from here on.
2. Groups of highly similar sets. Min-hashes that agree put sets into buckets; every set is compared
   with the most central one of its buckets, its leader, and the exact overlap is kept. This only
   saves work below: a set that finds no leader is a group of its own.
3. Index. Under one global order of shingles (rare first) two linked sets share a shingle of their
   prefixes. Postings are (shingle, group, set size, what is left from the position on). A list with
   one group alone is skipped. In the others, entries fall into blocks by size; a block meets only
   the blocks of its own and the next size, and entries whose positions leave too little for the
   needed overlap are skipped, as are pairs with too few entries in common. Members of one group share an entry, so a list that holds thousands
   of near copies is as short as the number of its groups.
4. Answers. For each pair of groups that meet, the leaders' overlap is computed once. Answers for
   members x and y follow: their overlap is at most x's overlap with its leader plus the shingles
   that x has beyond its leader and y has too; the same from y's side; and at most the leaders'
   overlap plus both. Sets that are connected already need no answer. What is left is settled in
   blocks of bounded size: near copies rarely share what they have beyond their leader, so most
   answers need only a look at those few shingles. Pairs are never written; only links are.

The global order sorts by counts per hash bucket (a table of fixed size). It decides which shingles
are looked up, never whether a pair is found.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.llm.common import (
    bitmap_bit, connected, id_bitmap, in_bitmap, lists, map_batches, map_tasks,
)
from stridelake.llm.words import MIX, random_numbers, word_hashes
from stridelake.session import discard, materialize

WORDS = 5
PERCENT = 80
SKETCH = 16  # min-hashes of a set; eight bits of each are kept
KEYS = 4  # of them, those that also make buckets
AGREE = 6  # equal min-hashes for a leader to be tried
NEAR = 50  # least similarity to a leader, in percent; without effect on the result
BLOCK = 1024  # sets of one group that a task compares with as many others
BUCKETS = 1 << 17  # of the table of shingle counts
POSTED = 1 << 16  # sets that a task remembers to have posted
SLICE = 4 << 20  # bytes of a long text that are hashed at once

_ORDER = random_numbers(WORDS + 300)[300:] | np.uint64(1)
_ODD = (random_numbers(SKETCH + 600)[600:] | np.uint64(1))[:, None]


def _slices(text: bytes) -> list[bytes]:
    """``text`` in parts of about ``SLICE`` bytes that cut no word."""
    parts, at = [], 0
    while len(text) - at > SLICE:
        white = re.compile(rb"[\x20\x09-\x0d]").search(text, at + SLICE)
        end = white.start() if white else len(text)
        parts.append(text[at:end])
        at = end
    return [*parts, text[at:]]


def shingles(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text.

    Fewer words than ``size`` make one shingle; no words make none. Hashes have 64 bits: within a
    pair of sets, a chance collision is of the order of 1e-13.
    """
    if not text:
        return np.empty(0, np.uint64)
    hashes = (word_hashes(text) if len(text) <= SLICE
              else np.concatenate([word_hashes(part) for part in _slices(text)]))
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    factors = random_numbers(size + 300)[300:] | np.uint64(1) if size > WORDS else _ORDER
    out = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        out += hashes[i:len(hashes) - width + 1 + i] * factors[i]
    out = np.sort((out ^ (out >> np.uint64(32))) * MIX)
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def digest(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def sketch(shingle_set: np.ndarray) -> np.ndarray:
    """Min-hashes: the least of the set under ``SKETCH`` multiplicative hashes."""
    spread = shingle_set ^ (shingle_set >> np.uint64(31))
    if len(spread) > SLICE // 64:
        return np.array([(spread * odd).min() for odd in _ODD], np.uint64)
    return (spread * _ODD).min(axis=1)


def prefix_length(n: int, percent: int) -> int:
    """How many shingles of a set must be looked up: ``n`` less the least overlap, plus one."""
    return n - -(-n * percent // 100) + 1


def _linked(overlap: str | Column, n_a: str | Column, n_b: str | Column, percent: int) -> Column:
    overlap, n_a, n_b = (F.col(c) if isinstance(c, str) else c for c in (overlap, n_a, n_b))
    return F.lit(100 + percent) * overlap >= F.lit(percent) * (n_a + n_b)


def describe_sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``n``, ``sig``, ``keys`` and ``sketch`` (null for an empty set) of each document,
    and its ``mark`` if ``docs`` has one.

    Each task also adds rows with a ``bucket`` and the number of ``hits``, its shingles there.
    """
    marked = "mark" in docs.columns

    def start():
        hits = np.zeros(BUCKETS, np.int64)

        def run(columns):
            sets = [shingles(t, words) for t in columns["text"].to_pylist()]
            np.add(hits, np.bincount(
                (np.concatenate(sets) & np.uint64(BUCKETS - 1)).view(np.int64),
                minlength=BUCKETS), out=hits)
            least = [sketch(s) if len(s) else None for s in sets]
            blank = [None] * len(sets)
            return {
                "doc_id": columns["doc_id"], "mark": columns["mark"] if marked else None,
                "n": [len(s) for s in sets], "sig": [digest(s) for s in sets],
                "keys": [m if m is None else m[:KEYS].view(np.int64) for m in least],
                "sketch": [m if m is None else (m >> np.uint64(20)).astype(np.int8)
                           for m in least],
                "bucket": blank, "hits": blank}

        def last():
            used = np.flatnonzero(hits)
            blank = [None] * len(used)
            return {"doc_id": blank, "mark": blank, "n": blank, "sig": blank, "keys": blank,
                    "sketch": blank, "bucket": used, "hits": hits[used]}

        return run, last

    return map_tasks(
        docs, start, "doc_id long, n long, sig binary, keys array<long>, sketch array<tinyint>, "
                     "bucket int, hits long" + (", mark binary" if marked else ""))


def bucket_counts(described: DataFrame) -> np.ndarray:
    """How many shingles of all documents fall into each of ``BUCKETS`` hash buckets."""
    found = (
        described.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("hits").alias("hits"))
        .toArrow())  # BUCKETS rows at most
    out = np.zeros(BUCKETS, np.int64)
    out[found["bucket"].to_numpy()] = found["hits"].to_numpy()
    return out


def sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node`` and ``items``, the shingle array, of the given ``nodes`` (``node, rep, sig``).

    A bitmap of fixed size keeps the scan from shipping most other sets; the join is exact.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(nodes.select("rep")))

    def run(columns):
        hit = in_bitmap(bitmap.value, columns["bit"].to_numpy())
        ids = columns["doc_id"].to_numpy()[hit]
        found = [shingles(t, words) for t, h in zip(columns["text"].to_pylist(), hit) if h]
        ends = np.cumsum([0, *map(len, found)])
        flat = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
        return {"rep": ids, "sig": [digest(s) for s in found], "items": lists(ends, flat)}

    rows = map_batches(
        docs.select("doc_id", bitmap_bit("doc_id").alias("bit"), "text"), run,
        "rep long, sig binary, items array<long>")
    return (
        rows.join(nodes, ["rep", "sig"]).select("node", "items")
        .dropDuplicates(["node"])  # repeated rows of a document
    )


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``a``, ``b`` and more) with ``overlap``, the exact intersection size."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("items").alias(f"items_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    size = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    return both.withColumn("overlap", size).drop("items_a", "items_b")


def lead(
    nodes: DataFrame, docs: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Node ``a``, its leader ``b``, their ``overlap`` and whether they are ``linked``, for every
    node that has a leader; all links that were seen; and the sets of all nodes that were tried.

    The leader of a bucket is the set whose min-hashes are the most common ones: near copies of one
    text resemble it more than each other. Sets that are held together by leaders are then compared
    with the most central one of them all. Linear in the nodes: each is compared with at most
    ``KEYS + 1`` others.
    """
    bucket = ["nth", "key"]
    marks = nodes.select("node", F.posexplode("keys").alias(*bucket))
    shared = marks.groupBy(*bucket).agg(F.count("*").alias("rows")).where("rows > 1")
    marks = materialize(marks.join(shared, bucket), "bucket-marks")
    score = marks.groupBy("node").agg(F.sum("rows").alias("score"))
    central = marks.join(score, "node").groupBy(*bucket).agg(
        F.max(F.struct("score", -F.col("node"), "node"))["node"].alias("b"))
    pairs = marks.join(central, bucket).select(F.col("node").alias("a"), "b").where(
        "a <> b").distinct()

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                            F.col("sketch").alias(f"sketch_{name}"))

    agree = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: (x == y).cast("int")),
        F.lit(0), lambda s, x: s + x)
    close = (
        (agree >= AGREE) & (F.col("n_a") * 100 >= F.col("n_b") * NEAR)
        & (F.col("n_b") * 100 >= F.col("n_a") * NEAR))
    tried = materialize(
        pairs.join(side("a"), "a").join(side("b"), "b").where(close)
        .select("a", "b", "n_a", "n_b"), "tried")
    discard(marks)
    wanted = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = materialize(
        sets_of(docs, nodes.select("node", "rep", "sig").join(wanted, "node"), words), "tried-sets")
    def compared(pairs: DataFrame) -> DataFrame:
        return overlaps(pairs, sets).where(_linked("overlap", "n_a", "n_b", NEAR)).withColumn(
            "linked", _linked("overlap", "n_a", "n_b", percent))

    first = materialize(compared(tried), "first-leaders")
    discard(tried)
    again = materialize(compared(_central(first, sets)), "second-leaders")
    best = (
        first.withColumn("second", F.lit(False))
        .unionByName(again.withColumn("second", F.lit(True)))
        .groupBy("a").agg(F.max(F.struct("second", "overlap", "b", "linked")).alias("best")))
    led = best.select("a", "best.b", "best.overlap", "best.linked")
    links = first.where("linked").select("a", "b").union(again.where("linked").select("a", "b"))
    return led, links, sets


def _central(first: DataFrame, sets: DataFrame) -> DataFrame:
    """Each node of a cluster of first leaders, paired with the cluster's most central set.

    That is the set whose shingles most others of the cluster have and which lacks few of theirs;
    an eighth of all shingles, by their hash, is enough to choose it.
    """
    cluster = materialize(connected(first.select("a", "b")), "clusters")
    rows = cluster.groupBy("component").agg(F.count("*").alias("rows")).where("rows > 2")
    tokens = (
        cluster.join(rows, "component").join(sets, "node")
        .select("component", "rows", "node", F.size("items").cast("long").alias("n"),
                F.explode(F.filter("items", lambda t: F.pmod(t, F.lit(8)) == 0)).alias("token")))
    tokens = materialize(tokens, "cluster-tokens")
    counts = tokens.groupBy("component", "token").agg(F.count("*").alias("holders"))
    scored = tokens.join(counts, ["component", "token"]).groupBy("component", "node", "n").agg(
        F.sum(2 * F.col("holders") - F.col("rows")).alias("score"))
    center = scored.groupBy("component").agg(
        F.max(F.struct("score", -F.col("node"), "node", "n")).alias("center"))
    sizes = sets.select("node", F.size("items").cast("long").alias("n"))
    pairs = materialize(
        cluster.join(center, "component").where("node <> center.node").join(sizes, "node")
        .select(F.col("node").alias("a"), F.col("center.node").alias("b"),
                F.col("n").alias("n_a"), F.col("center.n").alias("n_b")), "central-pairs")
    discard(cluster, tokens)
    return pairs


def short(sig: Column) -> Column:
    """The first 64 bits of a digest."""
    return F.conv(F.hex(F.substring(sig, 1, 8)), 16, -10).cast("long")


def postings(
    docs: DataFrame, members: DataFrame, order: np.ndarray, words: int, percent: int
) -> DataFrame:
    """``token, grp, n, rest`` of the prefix of every node, without lists of one set alone.

    A task that remembers a set, of ``POSTED`` and a batch at most, does not post it again, so copies
    cannot make a list long.
    """
    table = docs.sparkSession.sparkContext.broadcast(order)

    def start():
        seen = set()

        def run(columns):
            tokens, size, name, rest = [], [], [], []
            if len(seen) > POSTED:
                seen.clear()
            for text in columns["text"].to_pylist():
                items = shingles(text, words)
                short_name = int.from_bytes(digest(items)[:8], "big", signed=True)
                if not len(items) or short_name in seen:
                    continue
                seen.add(short_name)
                seldom = np.lexsort((items, table.value[items & np.uint64(BUCKETS - 1)]))
                own = items[seldom[:prefix_length(len(items), percent)]]
                tokens.append(own)
                size.append(len(items))
                name.append(short_name)
                rest.append(len(items) - np.arange(len(own)))
            each = [len(t) for t in tokens]
            return {
                "token": np.concatenate([*tokens, np.empty(0, np.uint64)]).view(np.int64),
                "name": np.repeat(np.array(name, np.int64), each),
                "n": np.repeat(np.array(size, np.int32), each),
                "rest": np.concatenate([*rest, np.empty(0)]).astype(np.int32)}

        return run, None

    flat = map_tasks(docs.select("text"), start, "token long, name long, n int, rest int")
    whole = W.partitionBy("token")
    live = (
        flat.withColumn("lo", F.min("name").over(whole)).withColumn("hi", F.max("name").over(whole))
        .where("lo <> hi").drop("lo", "hi"))
    names = members.select(short(F.col("sig")).alias("name"), "grp")
    return live.join(names, "name").select("token", "grp", "n", "rest")


def meetings(index: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups ``a < b`` whose index entries may belong to linked sets.

    At least one common entry must leave enough behind its position, and the number of common
    entries must make up for what two sets of these sizes lack beyond their prefixes.
    """
    entries = index.groupBy("token", "grp").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest"))

    def block(n: str) -> Column:
        return F.floor(F.log(F.col(n)) / F.log(F.lit(100 / percent)) + F.lit(1e-9)).cast("int")

    left = entries.select(
        "token", F.col("grp").alias("a"), "low", "high", "rest",
        F.explode(F.sequence(block("low"), block("high"))).alias("block"))
    right = entries.select(
        "token", F.col("grp").alias("b"), F.col("low").alias("low_b"),
        F.col("high").alias("high_b"), F.col("rest").alias("rest_b"),
        F.explode(F.sequence(block("low") - 1, block("high") + 1)).alias("block"))
    sizes_fit = (
        (F.col("a") < F.col("b"))
        & (F.col("high") * 100 >= F.col("low_b") * percent)
        & (F.col("high_b") * 100 >= F.col("low") * percent))
    rest_fits = _linked(F.least("rest", "rest_b").cast("long"), "low", "low_b", percent)
    least, most = F.least("low", "low_b").cast("long"), F.greatest("high", "high_b").cast("long")
    # Beyond its prefix a set of n has less than n * percent / 100 shingles, so the overlap stays
    # below that of the larger set plus the entries in common. ``gap`` is what those must make up.
    gap = F.lit(percent) * (F.lit(100) * least - F.lit(percent) * most)
    return (
        left.join(right, ["token", "block"]).where(sizes_fit)
        .select("a", "b", F.when(rest_fits, gap).alias("gap"))
        .groupBy("a", "b").agg(F.count("*").alias("common"), F.min("gap").alias("gap"))
        .where(F.lit(100 * (100 + percent)) * F.col("common") > F.col("gap")).select("a", "b"))


def components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Null, empty and white texts have no shingles and link with nothing; their component is their
    own id, as for every unlinked document. Rows with shingles that repeat an id are one document:
    it is linked with whatever any of its texts is. A row without an id links with nothing and has a null
    component. Ids are longs. An empty table gives no rows; other columns are not read.
    """
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows, named = _classes(source, words, percent, join_repeated=True)
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    # Unlinked nodes, the bulk, need no second look-up.
    of_class = named.join(least, "component").select("sig", "n", "component_id")
    own = rows.select("doc_id", "n", "sig")
    return own.join(of_class, ["sig", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        .alias("component_id"))


def _classes(
    source: DataFrame, words: int, percent: int, join_repeated: bool
) -> tuple[DataFrame, DataFrame]:
    """The described rows of ``source``, and ``sig, n, rep, component`` of every class of rows with
    an id and one set. With ``join_repeated`` texts that repeat an id belong together."""
    described = materialize(describe_sets(source, words), "sets")
    rows = described.where("bucket IS NULL")
    known = source.where("doc_id IS NOT NULL")
    nodes = materialize(
        rows.where("doc_id IS NOT NULL AND n > 0").groupBy("sig", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"),
             F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")  # written, so they stay
    led, links, tried_sets = lead(nodes, known, words, percent)
    own_leader = led.select(
        F.col("a").alias("node"), F.col("b").alias("leader"), "overlap", "linked")
    members = materialize(
        nodes.select("node", "rep", "sig", "n").join(own_leader, "node", "left")
        .select("node", "rep", "sig", "n", F.coalesce("leader", "node").alias("grp"),
                F.coalesce("overlap", "n").alias("overlap"),
                F.coalesce("linked", F.lit(True)).alias("linked")), "members")
    index = materialize(
        postings(known, members, bucket_counts(described), words, percent), "postings")
    met = materialize(meetings(index, percent), "meetings")
    discard(index)

    wanted = met.select(F.col("a").alias("node")).union(met.select("b")).distinct()
    missing = wanted.join(tried_sets, "node", "left_anti")
    plain = nodes.select("node", "rep", "sig", "n")
    sets = tried_sets.unionByName(materialize(
        sets_of(known, plain.drop("n").join(missing, "node"), words), "group-sets"))
    sizes = plain.select("node", "n")
    answered = materialize(
        overlaps(met, sets)
        .join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b"), "answers")
    same_rep = plain.groupBy("rep").agg(F.min("node").alias("b"), F.max("node").alias("last"))
    repeated = plain.join(same_rep.where("b <> last"), "rep").select(F.col("node").alias("a"), "b")
    edges = links.union(
        answered.where(_linked("overlap", "n_a", "n_b", percent)).select("a", "b"))
    if join_repeated:
        edges = edges.union(repeated)
    found = materialize(connected(edges), "components")
    more = materialize(open_links(members, answered, found, sets, percent), "open-links")
    if not more.isEmpty():
        found = connected(edges.union(more))

    return rows, plain.join(found, "node", "left").select(
        "sig", "n", "rep", F.coalesce("component", "node").alias("component"))


def open_links(
    members: DataFrame, answered: DataFrame, found: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links ``a, b`` between components among the pairs whose answer is still open.

    ``members`` are nodes with their group and their overlap with its leader, ``answered`` pairs of
    groups with the leaders' overlap, ``found`` components so far. Each group meets, in blocks of
    bounded size, its own members outside its main component and the members of groups that its
    own may be linked with. Only links leave a block.
    """
    # Written once: what follows reads it many times over.
    each = materialize(members.join(found, "node", "left").select(
        "node", "n", "grp", "overlap", F.coalesce("component", "node").alias("component")),
        "placed-members")
    parts = each.groupBy("grp", "component").agg(
        F.count("*").alias("rows"), F.max(F.col("n") - F.col("overlap")).alias("most"),
        F.min("n").alias("least"))
    groups = materialize(parts.groupBy("grp").agg(
        F.sum("rows").alias("rows"), F.max("most").alias("most"), F.min("least").alias("least"),
        F.max(F.struct("rows", "component"))["component"].alias("main"),
        (F.min("component") == F.max("component")).alias("whole")), "groups")

    def of(name: str) -> DataFrame:
        return groups.select(F.col("grp").alias(name), *[
            F.col(c).alias(f"{c}_{name}") for c in groups.columns if c != "grp"])

    pairs = (
        answered.select("a", "b", "overlap").join(of("a"), "a").join(of("b"), "b")
        # All members of both in one component: nothing is left to answer.
        .where("NOT (whole_a AND whole_b AND main_a = main_b)")
        .where(_linked(F.col("overlap") + F.col("most_a") + F.col("most_b"), "least_a", "least_b",
                       percent)))
    swap = F.col("rows_a") > F.col("rows_b")
    toward = pairs.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("grp"),
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("into"))
    own = each.join(groups.where("NOT whole").select("grp", "main"), "grp").where(
        "component <> main").select(F.col("grp").alias("into"), *each.columns)
    left = materialize(
        each.join(toward, "grp").select("into", *each.columns).union(own).distinct(), "open-left")
    blocks = (
        left.groupBy("into").agg(F.count("*").alias("rows_left"))
        .join(groups.select(F.col("grp").alias("into"), F.col("rows").alias("rows_right")), "into")
        .select("into", F.ceil(F.col("rows_left") / BLOCK).alias("left_blocks"),
                F.ceil(F.col("rows_right") / BLOCK).alias("right_blocks")))

    def deal(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.join(blocks, "into").withColumns({
            f"{mine}_block": F.pmod(F.xxhash64("node"), F.col(f"{mine}_blocks")),
            f"{other}_block": F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))})

    of_leader = sets.select(F.col("node").alias("grp"), F.col("items").alias("of_leader"))
    keys = ["into", "left_block", "right_block"]
    # A set that is its own leader has nothing beyond it.
    xs = left.join(sets, "node").join(of_leader, "grp").withColumn(
        "beyond", F.array_except("items", "of_leader"))
    xs = deal(xs, "left", "right").select(
        *keys, "node", "n", "overlap", "component", "items", "beyond")
    asked = each.withColumnRenamed("grp", "into").join(blocks.select("into"), "into", "left_semi")
    ys = deal(materialize(asked, "open-right").join(sets, "node"), "right", "left").select(
        *keys, "node", "n", "component", "items")
    ys = ys.select(*[F.col(c).alias(c) for c in ys.columns])  # both sides stem from one table

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        links = [] if not one.num_rows or not other.num_rows else _links(one, other, percent)
        return pa.table({
            "a": pa.array([a for a, _ in links], pa.int64()),
            "b": pa.array([b for _, b in links], pa.int64())})

    return xs.groupBy(*keys).cogroup(ys.groupBy(*keys)).applyInArrow(compare, "a long, b long")


def _links(one: pa.Table, other: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between the sets of two blocks, one per set of ``one`` and component of ``other``."""
    items = other["items"].combine_chunks()
    token = items.flatten().to_numpy()
    owner = np.repeat(np.arange(len(items)), np.diff(items.offsets.to_numpy()))
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]

    def held(tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each set of ``other`` has."""
        low, high = np.searchsorted(token, tokens), np.searchsorted(token, tokens, "right")
        length = high - low
        at = np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())
        return np.bincount(owner[at], minlength=len(items))

    n, component = other["n"].to_numpy(), other["component"].to_numpy()
    links = []
    for x in one.to_batches(max_chunksize=256):
        for node, size, overlap, own, whole, beyond in zip(
                *(x[c].to_pylist() for c in ("node", "n", "overlap", "component")),
                x["items"], x["beyond"], strict=True):
            need = percent * (size + n)
            # The overlap with any set is at most that with the leader and what it has beyond.
            most = overlap + held(beyond.values.to_numpy())
            maybe = (component != own) & ((100 + percent) * most >= need)
            if maybe.any():
                exact = held(whole.values.to_numpy())
                hits = np.flatnonzero(maybe & ((100 + percent) * exact >= need))
                firsts = np.unique(component[hits], return_index=True)[1]
                links += [(node, int(y)) for y in other["node"].to_numpy()[hits[firsts]]]
    return links


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component of linked texts: one with its smallest id.

    Rows are told apart by id and text, so an id that comes with different texts stays once for each
    component that it leads. Of several such texts in one component the one with the least digest
    stays, and of equal rows one. Rows without an id, and without a shingle, stay. Columns and their
    order are kept.
    """
    mark = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    marks = placed_texts(docs, doc_id, text, mark, **options)
    best = marks.groupBy("component").agg(
        F.min(F.struct("doc_id", "mark")).alias("best"), F.count("*").alias("texts"))
    leave = materialize(
        marks.join(best.where("texts > 1"), "component")
        .where("doc_id <> best.doc_id OR mark <> best.mark").select("doc_id", "mark"), "leave")
    again = marks.where("rows > 1").select("doc_id", "mark").join(
        leave, ["doc_id", "mark"], "left_anti")

    def without(df: DataFrame, texts: DataFrame) -> DataFrame:
        return df.join(_named(texts), ["_jaccard_id", "_jaccard_mark"], "left_anti")

    keyed = docs.withColumns({"_jaccard_id": F.col(doc_id).cast("long"), "_jaccard_mark": mark})
    # Equal rows meet after each task has reduced its own to one.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (
        keyed.join(_named(again), ["_jaccard_id", "_jaccard_mark"], "left_semi")
        .groupBy("_jaccard_id", "_jaccard_mark")
        .agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row")).select("row.*"))
    single = without(keyed, leave.unionByName(again))
    return single.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(one)


def _named(texts: DataFrame) -> DataFrame:
    return texts.select(F.col("doc_id").alias("_jaccard_id"), F.col("mark").alias("_jaccard_mark"))


def placed_texts(
    docs: DataFrame, doc_id: str, text: str, mark: Column, words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, mark, rows, component`` of every distinct id and text that has a shingle.

    Components are made by links alone: texts are not held together by an id.
    """
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"),
        mark.alias("mark"))
    rows, named = _classes(source, words, percent, join_repeated=False)
    texts = rows.where("doc_id IS NOT NULL AND n > 0").groupBy("doc_id", "mark", "sig", "n").agg(
        F.count("*").alias("rows"))
    return materialize(
        texts.join(named, ["sig", "n"]).select("doc_id", "mark", "rows", "component"), "placed")
