"""Secret scans over a ledger of text blobs.

Every version of a document is addressed by the hash of its content. The ledger remembers which
blob was scanned by which version of which rule, and what was found. A run scans only the pairs of
blob and rule version that the ledger lacks, adds them, and joins the findings of all blobs back to
every row (path) that holds them. A second run over the same rows, a copy of a known document or a
document that returns to an old version scans nothing; a new rule scans known blobs for that rule
alone.

The ledger is a folder that outlives the application (:func:`standing_ledger`). Each run adds a
folder of its own to it, so runs may overlap; a pair that two of them scanned counts once. A rule is
known by its kind, version and pattern, so one that is changed without a new version is scanned anew
too.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stridelake.llm.common import map_batches, unused
from stridelake.session import materialize, shared_dir
from stridelake.sources.files import path_exists

LEDGER = "blob binary, rule string, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` is long enough.

    A shorter match is dropped after it was found, so it still uses up its characters.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    at_least: int = 0
    base: bool = True

    @property
    def name(self) -> str:
        """What the ledger calls this rule."""
        exact = f"{self.pattern}/{self.group}/{self.at_least}".encode()
        return f"{self.kind}:{self.version}:{zlib.crc32(exact):08x}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [
            m.span() for m in re.finditer(self.pattern, text)
            if m.end(self.group) - m.start(self.group) >= self.at_least]


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(
    [*map(_either_case, ("password", "passwd", "secret", "token")),
     _either_case("api") + "_?" + _either_case("key")])

RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # A run of 24 or more; shorter runs would be found and dropped one by one.
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    # An added rule: the whole block of a private key.
    Rule("key", 1, r"-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=,:\x20\x09-\x0D-]*?"
                   r"-----END ([A-Z0-9]+ )*PRIVATE KEY-----", base=False),
)


def blob_of(text: Column) -> Column:
    """The address of a text; a null text is the empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def standing_ledger(spark: SparkSession) -> str:
    """The ledger below ``spark.checkpoint.dir`` that all applications share."""
    return shared_dir(spark).rpartition("/")[0] + "/blob-ledger"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the ledger; a pair may be there more than once, always with the same spans."""
    if not path_exists(spark, f"{path}/run-*"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{path}/run-*")


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob`` and ``kinds``: the rules whose present version did not scan it yet."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    done = ledger.groupBy("blob").agg(F.collect_set("rule").alias("done"))  # rules are few
    missing = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return (
        blobs.join(done, "blob", "left").select(
            "blob", *[c for c in blobs.columns if c != "blob"], missing.alias("kinds"))
        .where(F.size("kinds") > 0)
    )


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``texts`` (``blob``, ``text``, ``kinds``): one per blob and rule, also
    where nothing was found. Offsets count code points; the end is exclusive."""
    def run(columns):
        blobs, names, spans = [], [], []
        rows = zip(columns["blob"].to_pylist(), columns["text"].to_pylist(),
                   columns["kinds"].to_pylist(), strict=True)
        for blob, text, wanted in rows:
            for rule in rules:
                if rule.name in wanted:
                    blobs.append(blob)
                    names.append(rule.name)
                    spans.append(
                        [{"start": a, "end": b} for a, b in rule.spans(text)] if text else [])
        return {"blob": blobs, "rule": names, "spans": spans}

    return map_batches(texts, run, LEDGER)


def update(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Scan what the ledger at ``path`` lacks of ``docs`` and add it; gives the paths.

    The result has one row per row of ``docs``: ``doc_id`` and ``blob``. One row of each unseen
    blob brings its text to the scan; copies, however many, are known by their address alone, and
    where nothing is unseen no text is read again. A run that dies leaves whole ledger rows or
    none; the next one scans what is missing.
    """
    spark = docs.sparkSession
    paths = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), blob_of(F.col(text)).alias("blob")), "paths")
    first = paths.groupBy("blob").agg(F.min("doc_id").alias("first"))
    todo = materialize(unseen(first, read_ledger(spark, path), rules), "unseen")
    if todo.isEmpty():
        return paths
    # The address and the id together are (nearly) unique, so a blob with many copies is no hot key.
    source = docs.select(
        F.col(doc_id).alias("first"), blob_of(F.col(text)).alias("blob"),
        F.col(text).alias("text"))
    same = source["blob"].eqNullSafe(todo["blob"]) & source["first"].eqNullSafe(todo["first"])
    texts = source.join(todo, same).select(todo["blob"], "text", "kinds")
    found = scan(texts, rules).dropDuplicates(["blob", "rule"])  # of repeated rows
    found.write.parquet(f"{path}/run-{uuid.uuid4().hex}")
    return paths


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``found``: its spans by start, then in the order of ``rules``.

    Only the present version of each rule counts. A blob without findings has no row.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    hits = ledger.where((F.size("spans") > 0) & F.col("rule").isin(*[r.name for r in rules]))
    spans = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), order[F.col("rule")].alias("nth"), s["end"].alias("end"),
        F.substring_index("rule", ":", 1).alias("kind")))
    # Few rows a blob: one per rule, and those of runs that overlapped, which say the same.
    return hits.groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(spans)))).alias("found"))


def by_path(
    paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``doc_id``, ``blob`` and ``found`` (null without findings) of every path."""
    return paths.join(findings(ledger, rules), "blob", "left")


def _joined(found: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ledger: str | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Counts and spans of every row of ``docs``: ``n_<kind>`` and the digest are those of the base
    rules, ``spans`` has all.

    Without ``ledger`` the standing one is used. Null and empty texts have no findings, repeated
    rows each get a row, a null id stays null, and only the two named columns are read. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    path = ledger or standing_ledger(spark)
    paths = update(docs, path, doc_id, text, rules)
    rows = by_path(paths, read_ledger(spark, path), rules)

    def count(kind: str) -> Column:
        of_kind = F.filter("found", lambda s: s["kind"] == kind)
        return F.coalesce(F.size(of_kind), F.lit(0)).cast("long").alias(f"n_{kind}")

    base = [r.kind for r in rules if r.base]
    of_base = _joined(F.filter("found", lambda s: s["kind"].isin(*base)))
    return rows.select(
        "doc_id", *map(count, base),
        F.sha2(of_base.cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"))


def redact(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ledger: str | None = None,
    rules: tuple[Rule, ...] = RULES, mark: str = "[REDACTED]",
) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans become one.

    Columns, their order and the number of rows stay, whatever the columns are called. Texts
    without findings stay as they are. ``text`` must be a string.
    """
    if docs.schema[text].dataType.simpleString() != "string":
        raise TypeError(f"{text} is no string")
    spark = docs.sparkSession
    path = ledger or standing_ledger(spark)
    update(docs, path, doc_id, text, rules)
    blob, hit = unused(docs, "blob", "spans")
    hits = findings(read_ledger(spark, path), rules).select(
        F.col("blob").alias(blob),
        F.transform("found", lambda s: F.struct(s["start"], s["end"])).alias(hit))

    def run(columns):
        out = []
        for value, spans in zip(
                columns[text].to_pylist(), columns[hit].to_pylist(), strict=True):
            if spans:
                parts, at = [], 0
                for span in spans:
                    start, end = span.values()
                    if start >= at:
                        parts += [value[at:start], mark]
                    at = max(at, end)
                value = "".join([*parts, value[at:]])
            out.append(value)
        return {**columns, text: out}

    marked = docs.withColumn(blob, blob_of(F.col(text))).join(hits, blob, "left")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(marked.select(*[f"`{c}`" for c in docs.columns], hit), run, kept)
