import hashlib
import re

import pytest
from pyspark.sql import functions as F

from stridelake.llm import queries, secrets
from stridelake.session import fresh_path, materialize
from tests.llm.data import documents, empty

CASES = [
    "password: abcdef", "PassWord='abc", "secret:token :abcdef", "token=token=abcdef api_key = x/y+z.9=",
    "AKIA" + "Z" * 16, "AKIA" + "Z" * 15, "xAKIAAKIA" + "9" * 16, "0123456789abcdef01234567",
    "ABCDEF0123456789abcdef01234567z", "apikey\":\"  secret12", "é😀 passwd=ééé abcdefg token=abcdefg",
    "ſecret=abcdefgh toKen=abcdefgh", "",
    "-----BEGIN RSA PRIVATE KEY-----\nMIIabc+/=\n-----END RSA PRIVATE KEY----- rest",
    "-----BEGIN PRIVATE KEY-----\n token=abcdefgh\n-----END PRIVATE KEY-----"
    "-----BEGIN EC PRIVATE KEY-----x-----END EC PRIVATE KEY-----",
    "-----BEGIN PRIVATE KEY----- never ends; -----BEGIN PUBLIC KEY-----x-----END PUBLIC KEY-----",
]


def keys(text):
    """The added rule, by searching for the two lines."""
    out, at, text = [], 0, text or ""
    while begin := re.compile("-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----").search(text, at):
        end = re.compile("-----END ([A-Z0-9]+ )*PRIVATE KEY-----").search(text, begin.end())
        inside = end and text[begin.end():end.start()]
        if end and re.fullmatch(r"[A-Za-z0-9+/=,:\x20\x09-\x0D-]*", inside):
            out.append((begin.start(), 3, end.end(), "key"))
            at = end.end()
        else:
            at = begin.start() + 1
    return out


def base(text):
    """The three base rules as they are stated."""
    text, out = text or "", []
    names = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token", "api")).replace(
        "[Aa][Pp][Ii]", "[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, m.end(), "assign")] if len(m[2]) >= 6 else []
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        out += [(m.start(), 1, m.end(), "access")] if len(m[0]) >= 20 else []
    for m in re.finditer(r"[0-9a-f]+", text):
        out += [(m.start(), 2, m.end(), "hex")] if len(m[0]) >= 24 else []
    return sorted(out)


def test_report_is_that_of_the_stated_rules(spark):
    docs = documents(spark).select("doc_id", "text").union(
        spark.createDataFrame(list(enumerate(CASES, 500)), "doc_id long, text string"))
    got = sorted(map(tuple, secrets.report(docs).collect()), key=str)
    want = []
    for r in docs.collect():
        found = base(r.text)
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        spans = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found + keys(r.text)))
        kinds = [k for *_, k in found]
        want.append((r.doc_id, kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                     hashlib.sha256(text.encode()).hexdigest(), spans))
    assert got == sorted(want, key=str)
    assert sum("key:" in w[5] for w in want) == 2
    assert secrets.report(empty(spark)).count() == 0


def test_ledger_scans_unseen_pairs_only(spark):
    path = fresh_path(spark, "ledger")
    docs = spark.createDataFrame(
        [(1, "password=abcdefg"), (2, "password=abcdefg"), (3, "plain")], "doc_id long, text string")
    secrets.update(docs, path)
    first = secrets.read_ledger(spark, path)
    assert first.count() == 2 * len(secrets.RULES)
    assert secrets.unseen(first.select("blob").distinct(), first, secrets.RULES).count() == 0
    later = spark.createDataFrame(
        [(1, "new token=1234567"), (4, "plain")], "doc_id long, text string")
    secrets.update(later, path)
    assert secrets.read_ledger(spark, path).count() == 3 * len(secrets.RULES)
    newer = (secrets.Rule("assign", 2, "plain"), *secrets.RULES[1:])
    secrets.update(docs, path, rules=newer)
    ledger = secrets.read_ledger(spark, path)
    assert ledger.count() == 3 * len(secrets.RULES) + 2  # known blobs, for the new rule alone
    paths = secrets.by_path(secrets.update(docs, path, rules=newer), ledger, newer).collect()
    found = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.found or []] for r in paths}
    assert found == {1: [], 2: [], 3: [("assign", 0, 5)]}


def test_a_changed_pattern_of_one_version_is_scanned_anew(spark):
    path = fresh_path(spark, "ledger")
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    for pattern, spans in (("a", "assign:0:1"), ("bc", "assign:1:3")):
        rules = (secrets.Rule("assign", 1, pattern),)
        assert secrets.report(docs, ledger=path, rules=rules).first().spans == spans


def test_a_second_run_scans_nothing(spark, monkeypatch):
    path, docs, scanned = fresh_path(spark, "ledger"), documents(spark), []
    scan = secrets.scan

    def counted(texts, rules):
        out = materialize(scan(texts, rules), "scanned")
        scanned.append(out.count())
        return out

    monkeypatch.setattr(secrets, "scan", counted)
    first = sorted(map(str, secrets.report(docs, ledger=path).collect()))
    blobs = docs.select(secrets.blob_of(F.col("text")).alias("b")).distinct().count()
    assert len(scanned) == 1 and scanned[0] >= blobs * len(secrets.RULES)
    assert sorted(map(str, secrets.report(docs, ledger=path).collect())) == first
    secrets.redact(docs, ledger=path).count()
    assert len(scanned) == 1
    more = docs.withColumn("text", F.when(F.col("doc_id") == 3, "new").otherwise(F.col("text")))
    secrets.update(more, path)
    assert scanned[1:] == [len(secrets.RULES) * more.where("text = 'new'").count()]


def test_the_registered_query_keeps_its_ledger(spark):
    sf_dir = "/root/testdata/sf0.001"
    path = secrets.standing_ledger(spark)
    assert path == spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/blob-ledger"
    first = sorted(map(str, queries.found_secrets(spark, sf_dir).collect()))
    size = secrets.read_ledger(spark, path).count()
    assert sorted(map(str, queries.found_secrets(spark, sf_dir).collect())) == first
    assert secrets.read_ledger(spark, path).count() == size > 0


def test_rows_stored_twice_count_once(spark):
    path, docs = fresh_path(spark, "ledger"), documents(spark)
    once = sorted(map(str, secrets.report(docs, ledger=path).collect()))
    again = materialize(secrets.read_ledger(spark, path), "copy")
    again.write.parquet(f"{path}/run-again")
    assert sorted(map(str, secrets.report(docs, ledger=path).collect())) == once


def test_redact(spark):
    docs = documents(spark)
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[111] == "[REDACTED] [REDACTED] [REDACTED]" and texts[105] is None
    assert secrets.report(out).where("spans <> ''").count() == 0
    clash = docs.withColumns({"_blob": F.lit("b"), "_spans": F.lit("s")})
    marked = secrets.redact(clash)
    assert marked.columns == clash.columns
    assert marked.where("_blob <> 'b' OR _spans <> 's'").count() == 0
    with pytest.raises(TypeError):
        secrets.redact(docs, text="doc_id")
