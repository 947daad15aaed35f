import re

import pytest
from pyspark.sql import functions as F

from stridelake.llm import mixing, urls
from tests.llm.data import documents, empty, rows_of

URLS = [
    "http://A.Example.NET/en/x?y", "https://example.net/de/", "http://example.network/", "ftp://net/",
    "http://x.org/fr/1#z", "http://x.org/fr", "http://b.example.com/de/q", "http://b.example.com/en/",
    "no scheme", None, "://", "http://net?x=/", "http://h.com:80/en/?u=http://q.net/", "x://y://z/p",
    "http://new\nline.net/a\nb",
]


def rule(host, path):
    best = None
    for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"),
                    ("example.com", "/de/", "block"), ("org", "/fr/", "allow")):
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, v)
    return best


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return ("".join(c.lower() if c.isascii() else c for c in host),
            re.match(r"[^?#]*", rest[len(host):])[0])


def pages(spark, html=None):
    rows = [(i, u, (html or {}).get(i), "x", "x") for i, u in enumerate(URLS)] + [
        (None, URLS[0], None, "x", "x"), (3, URLS[3], None, "x", "x"), (3, URLS[3], None, "x", "x")]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, host string, trust string")


def test_rules_win(spark):
    for r in urls.judge(pages(spark), steps=3).collect():
        if r.page_id is None:
            continue
        host, path = parts(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        best = rule(host, path)
        assert r.rule == (best and best[0])
        assert best is None or r.verdict == best[1]
    assert urls.judge(pages(spark), steps=1).count() == pages(spark).count()
    assert urls.judge(pages(spark).where("false"), steps=2).count() == 0


def test_trust_flows_forward_and_distrust_backward(spark):
    edges = spark.createDataFrame(
        [("good", "liked", 1), ("liker", "bad", 1), ("good", "x", 1), ("x", "liker", 3)],
        "src string, dst string, weight long")
    unit = urls.UNIT
    seeds = spark.createDataFrame(
        [("good", unit, 0), ("bad", 0, unit)], "host string, good long, bad long")
    got = {r.host: (r.trust, r.distrust) for r in urls.propagate(edges, seeds, 40).collect()}
    d, rest = urls.DAMPING_PERCENT, unit * (100 - urls.DAMPING_PERCENT) // 100
    assert got["good"][0] == rest and got["bad"][1] == rest
    assert got["liked"] == (rest * d // 200, 0)
    assert got["liker"][1] == rest * d // 100
    assert got["x"][1] == (rest * d // 100) * d // 100
    assert got["good"][1] == ((rest * d // 100) * d // 100) * d // 100


def model(pages, steps):
    """Trust and distrust by plain loops over ``(host, verdict of a rule, link targets)``."""
    weight, good, bad = {}, {}, {}
    for host, given, targets in pages:
        if host:
            for t in targets:
                if t and t != host:
                    weight[host, t] = weight.get((host, t), 0) + 1
                    if t.startswith("/"):
                        weight[t, host] = weight.get((t, host), 0) + 1
            for name, masses in (("allow", good), ("block", bad)):
                masses[host] = masses.get(host, 0) + (given == name)
    seeds = [{h: urls.UNIT * n // max(1, sum(m.values())) for h, n in m.items()}
             for m in (good, bad)]
    out = []
    for seed, edges in zip(seeds, ([(a, b, w) for (a, b), w in weight.items()],
                                   [(b, a, w) for (a, b), w in weight.items()])):
        totals = {}
        for a, _, w in edges:
            totals[a] = totals.get(a, 0) + w
        now = dict(seed)
        for _ in range(steps):
            after = {h: n * (100 - urls.DAMPING_PERCENT) // 100 for h, n in seed.items()}
            for a, b, w in edges:
                if a in now:
                    after[b] = after.get(b, 0) + now[a] * w * urls.DAMPING_PERCENT // (
                        totals[a] * 100)
            now = after
        out.append(now)
    return out


def test_verdicts_without_a_rule_follow_the_links(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    judged = urls.judge(table).collect()
    pages = []
    for r in table.collect():
        host, path = parts(r.url)
        best = rule(host, path)
        targets = []
        for href in re.findall(r"""(?i)href\s*=\s*["']?([^\s"'<>]+)""", r.html or ""):
            there = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", href)
            place = re.match(r"(/[^/?#][^?#]*)", href)
            targets.append(there[1].lower() if there else place[1] if place else "")
        pages.append((host, best and best[1], targets))
    trust, distrust = model(pages, urls.STEPS)
    for r in judged:
        t, d = trust.get(r.host, 0), distrust.get(r.host, 0)
        assert (r.trust or 0, r.distrust or 0) == (t, d)
        if r.decided_by != "rule":
            assert r.verdict == ("block" if 100 * d > urls.THRESHOLD_PERCENT * t else "allow")
    by = [r.decided_by for r in judged]
    changed = sum(r.decided_by == "links" and r.verdict == "block" for r in judged)
    assert by.count("links") > 0.2 * len(by) and 0 < changed < by.count("links")


def test_links_are_read(spark):
    df = spark.createDataFrame(
        [("a.x", '<a href="http://B.y/1">1</a><A HREF=//b.y/2>2</A><a href="/own?q">3</a>'
                 "<a href='/'>4</a><a href='#top'>5</a><a href=mailto:x@y>6</a>"),
         ("a.x", None), ("", '<a href="/own">')], "host string, html string")
    edges = {(r.src, r.dst): r.weight for r in urls.host_edges(df).collect()}
    assert edges == {("a.x", "b.y"): 2, ("a.x", "/own"): 1, ("/own", "a.x"): 1}


def cells(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_raking_meets_its_margins(spark):
    rows = cells(spark, [
        ("a", "en", "t", 600), ("a", "fr", "t", 200), ("b", "en", "u", 500), ("b", "fr", "t", 300),
        ("c", "en", "t", 250), ("c", "fr", "u", 150)])
    made = mixing.calibrated(rows)
    assert made.where("weight > tokens + 1e-9").count() == 0
    report = mixing.margins(made).collect()
    assert len(report) == 7 and max(r.error for r in report) <= mixing.TOLERANCE
    for margin in mixing.MARGINS:
        mine = [r for r in report if r.margin == margin]
        assert sum(r.target for r in mine) == pytest.approx(0.6 * 2000)
        assert all(r.reached == pytest.approx(r.target, rel=0.01) for r in mine)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_production_settings_meet_their_margins(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    made = mixing._cells_of(docs, "doc_id", "text", "source", "lang", None)
    rows = docs.select(*[made[c].alias(c) for c in (*mixing.MARGINS, "tokens")])
    found = mixing.calibrated(rows)
    report = mixing.margins(found).collect()
    assert max(r.error for r in report) <= 0.01 and found.first().easing < 0.5
    for r in report:
        assert r.reached <= 0.9 * rows.where(F.col(r.margin) == r.category).agg(
            F.sum("tokens")).first()[0] * 1.01


def test_no_category_aims_above_what_it_has(spark):
    sums = spark.createDataFrame(
        [("a", 1000.0, 1000.0 ** 0.5), ("b", 10.0, 10.0 ** 0.5), ("c", 1.0, 1.0)],
        "source string, own double, wish double")
    got = {r.source: r for r in mixing.attainable(sums, 1.5).collect()}
    assert got["b"].target == pytest.approx(15 / 1011) and got["c"].target == pytest.approx(1.5 / 1011)
    assert sum(r.target for r in got.values()) == pytest.approx(1)


def test_contradicting_targets_are_eased(spark):
    # Source and language say the same, but are to be flattened differently.
    rows = cells(spark, [("a", "en", "t", 900), ("b", "fr", "t", 100)])
    found = mixing.calibrated(rows, flatness={"source": 1.0, "lang": 0.5})
    assert found.first().easing > 0 and found.first().error <= mixing.TOLERANCE


def test_explicit_wishes(spark):
    rows = cells(spark, [("a", "en", "t", 900), ("b", "en", "t", 900), ("c", "en", "t", 200)])
    want = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "source string, target double")
    got = {r.source: r.weight for r in mixing.calibrated(rows, wished={"source": want}).collect()}
    assert got == {"a": pytest.approx(800, rel=0.02), "b": pytest.approx(400, rel=0.02)}
    docs = spark.createDataFrame(
        [(i, "some words", s, "en") for i, s in enumerate("aabbc")],
        "doc_id long, text string, source string, lang string")
    mixed = mixing.mix(docs, wished={"source": want})
    assert mixed.count() == 5 and mixed.where("source = 'c' AND (p > 0 OR kept)").count() == 0


def test_mix_and_sample_agree(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.count() == docs.count() and mixed.where("p < 0 OR p > 1").count() == 0
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == rows_of(mixed.where("kept"), "doc_id")
    clash = docs.withColumns({"_source": F.lit("q"), "_draw": F.lit(1.0), "__p": F.lit(0)})
    again = mixing.sample(clash)
    assert again.columns == clash.columns and again.where("_source <> 'q'").count() == 0
    assert rows_of(again, "doc_id") == rows_of(kept, "doc_id")
    assert mixing.mix(empty(spark)).count() == 0 and mixing.sample(empty(spark)).count() == 0
