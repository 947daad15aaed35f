"""URL filters: fixed rules first, then trust and distrust over the graph of hosts.

Pages that a rule allows or blocks make their hosts seeds, and nothing else does. Trust flows along
links (a personalised PageRank from trusted seeds): what trusted hosts link to is trusted. Distrust
flows against them from blocked seeds: who links to blocked hosts is distrusted. A host is blocked
when its distrust outweighs its trust by a threshold; that decides pages without a rule.

Links between hosts are edges. A link within a host leads to a place that other hosts may link to as
well (the same path, as sites of one making share them); such places are nodes beside the hosts, with
edges both ways, so hosts that share many of them are near each other without a pair of hosts ever
being formed.

Masses are whole numbers and each step rounds down, so the result does not depend on the order in
which tasks add, and ties are ties wherever they are computed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.session import materialize

HREF = r"""(?i)href\s*=\s*["']?([^\s"'<>]+)"""
ABSOLUTE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
PLACE = r"^(/[^/?#][^?#]*)"  # a path on the own host; the root says nothing
DAMPING_PERCENT = 85
STEPS = 16
STEPS_PER_WRITE = 4
UNIT = 10 ** 12  # the trust, and the distrust, of all seeds together
THRESHOLD_PERCENT = 200  # block where distrust is above this share of trust


class Rule(NamedTuple):
    """Fits ``host`` and all its subdomains where the path begins with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of its ``name`` and ``verdict``; else null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<name:string,verdict:string>")


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """``src``, ``dst`` and ``weight`` (the number of links) between hosts, and between hosts and
    the places they link to within themselves. ``pages`` has ``host``; a place begins with a slash.
    """
    links = pages.where("host <> ''").select(
        "host", F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))).alias("href"))
    other = F.translate(F.regexp_extract("href", ABSOLUTE, 1), _UPPER, _LOWER)
    place = F.regexp_extract("href", PLACE, 1)
    found = links.select(
        "host", F.when(other != "", other).otherwise(place).alias("dst")).where(
        "dst <> '' AND dst <> host").groupBy("host", "dst").agg(F.count("*").alias("weight"))
    forward = found.select(F.col("host").alias("src"), "dst", "weight")
    back = found.where(F.col("dst").startswith("/")).select(
        F.col("dst").alias("src"), F.col("host").alias("dst"), "weight")
    return forward.unionByName(back)


def _share(mass: Column, weight: Column, total: Column) -> Column:
    wide = "decimal(38,0)"
    return F.call_function(
        "div", mass.cast(wide) * weight.cast(wide) * F.lit(DAMPING_PERCENT).cast(wide),
        total.cast(wide) * F.lit(100).cast(wide))


def propagate(edges: DataFrame, seeds: DataFrame, steps: int = STEPS) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` after ``steps`` steps.

    ``seeds`` has ``host``, ``good`` and ``bad``, the masses that they begin with and of which each
    step brings a part back. Trust follows links, shared out by weight; distrust runs against them
    in the same way. Hot hosts are joined by the engine's skew handling and summed before the
    shuffle.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("total"))
    flows = materialize(
        edges.join(out, "src").select(
            F.col("src").alias("from"), F.col("dst").alias("host"), "weight", "total",
            F.lit(True).alias("along"))
        .unionByName(edges.join(into, "dst").select(
            F.col("dst").alias("from"), F.col("src").alias("host"), "weight", "total",
            F.lit(False).alias("along"))),
        "flows")
    rest = F.lit(100 - DAMPING_PERCENT)
    back = seeds.select(
        "host", F.call_function("div", F.col("good") * rest, F.lit(100)).alias("trust"),
        F.call_function("div", F.col("bad") * rest, F.lit(100)).alias("distrust"))
    ranks = seeds.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    zero = F.lit(0).cast("long")
    for step in range(steps):
        given = flows.join(ranks.withColumnRenamed("host", "from"), "from")
        mass = F.when(F.col("along"), F.col("trust")).otherwise(F.col("distrust"))
        moved = given.select("host", "along", _share(mass, F.col("weight"), F.col("total"))
                             .alias("mass")).where("mass > 0").select(
            "host", F.when(F.col("along"), F.col("mass")).otherwise(zero).alias("trust"),
            F.when(F.col("along"), zero).otherwise(F.col("mass")).alias("distrust"))
        ranks = moved.unionByName(back).groupBy("host").agg(
            F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if (step + 1) % STEPS_PER_WRITE == 0 or step + 1 == steps:
            ranks = materialize(ranks, "host-ranks")
    return ranks


def seeds_of(rows: DataFrame) -> DataFrame:
    """``host``, ``good`` and ``bad`` from the rules alone: a host's share of all allowed and of all
    blocked pages, in units. ``rows`` has ``host`` and ``given``, the verdict of a rule or null."""
    counts = rows.where("host <> '' AND given IS NOT NULL").groupBy("host").agg(
        F.count_if(F.col("given") == "allow").alias("good"),
        F.count_if(F.col("given") == "block").alias("bad"))
    good, bad = counts.agg(F.sum("good"), F.sum("bad")).first()

    def units(name: str, total: int | None) -> Column:
        wide = F.col(name).cast("decimal(38,0)") * F.lit(UNIT).cast("decimal(38,0)")
        return F.call_function(
            "div", wide, F.lit(max(1, total or 0)).cast("decimal(38,0)")).alias(name)

    return counts.select("host", units("good", good), units("bad", bad))


def judge(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    rules: tuple[Rule, ...] = RULES, steps: int = STEPS,
    threshold_percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, decided_by, trust, distrust`` of every row of ``pages``.

    ``decided_by`` is ``rule``, ``links`` where trust or distrust reached the host, else
    ``default``: such a page is allowed. A null url, or one without ``://``, has an empty host and
    path; no host means no rule and no links. A null page has no links. Repeated rows are judged
    each and count each; null ids stay null; an empty table gives no rows; other columns are not
    read. A host with as much distrust as the threshold takes is allowed.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "given", F.col("found.verdict"))
    edges = materialize(host_edges(rows), "host-edges")
    seeds = materialize(seeds_of(rows), "seeds")
    ranks = propagate(edges, seeds, steps)
    reached = F.coalesce(F.col("trust") + F.col("distrust") > 0, F.lit(False))
    blocked = F.coalesce(
        F.col("distrust").cast("decimal(38,0)") * 100
        > F.col("trust").cast("decimal(38,0)") * threshold_percent, F.lit(False))
    return rows.drop("html").join(ranks, "host", "left").select(
        "page_id", "host", "path", F.col("found.name").alias("rule"),
        F.coalesce("given", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("given").isNotNull(), "rule").when(reached, "links").otherwise("default")
        .alias("decided_by"), "trust", "distrust")
