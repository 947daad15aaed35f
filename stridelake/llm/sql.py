"""DuckDB SQL for the registered queries that SQL can say."""

from __future__ import annotations

from stridelake.llm import mixing, secrets, urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HIGHEST_SCORES = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

COMPONENTS = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(
      range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS items
  FROM w),
t AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM t a JOIN t b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(items) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id
FROM s LEFT JOIN least l ON s.doc_id = l.a"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, words, phrase, count(*) AS f FROM (
    SELECT lang, words, unnest(list_transform(
      range(1, len(ws) - words + 2), lambda i: array_to_string(ws[i:i + words - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) AS sizes(words))
  GROUP BY ALL),
candidates AS (
  SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE words > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
    FROM candidates WHERE words = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase)
  WHERE NOT coalesce(100 * longer.f >= 50 * c.f, false)),
cuts AS (
  SELECT *, unnest(range(1, words)) AS k FROM kept),
scores AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
         CAST(1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:c.words], ' ')),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scores),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang)
WHERE rank <= 2000"""


def _spans(kind: str, order: int, pattern: str, kept: str) -> str:
    """Positions of matches: what stands before a match are the pieces between matches, and the
    matches before it."""
    pattern = pattern.replace("'", "''")
    return rf"""
  SELECT doc_id, '{kind}' AS kind, {order} AS nth, "begin", "begin" + length(m) AS "end" FROM (
    SELECT doc_id, unnest(found) AS m, unnest(inner_part) AS part,
      unnest(list_transform(range(1, len(found) + 1), lambda i: CAST(
        list_sum(list_transform(pieces[1:i], lambda p: length(p)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda p: length(p))), 0)
        AS BIGINT))) AS "begin"
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS found,
                 regexp_extract_all(t, '{pattern}', {2 if kind == "assign" else 0}) AS inner_part,
                 string_split_regex(t, '{pattern}') AS pieces FROM d))
  WHERE {kept}"""


_NAME = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) if word != "api_?key"
    else "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    for word in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SECRETS = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), spans AS ("
    + " UNION ALL ".join([
        _spans("assign", 0, _ASSIGN, "length(part) >= 6"),
        _spans("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 20"),
        _spans("hex", 2, "[0-9a-f]+", "length(m) >= 24"),
        _spans("key", 3, secrets.RULES[3].pattern, "true")])
    + """),
by_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
         count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || "begin" || ':' || "end", ',' ORDER BY "begin", nth) AS spans,
         string_agg(kind || ':' || "begin" || ':' || "end", ',' ORDER BY "begin", nth)
           FILTER (WHERE nth < 3) AS base
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN by_doc USING (doc_id)""")


def _mixture() -> str:
    margins = mixing.MARGINS
    parts = [rf"""
rows AS (
  SELECT doc_id, coalesce(source, '{mixing.ABSENT}') AS source,
         coalesce(lang, '{mixing.ABSENT}') AS lang,
         CASE WHEN n = 0 THEN 'empty' WHEN lines > 1 AND n < 40 * lines THEN 'list'
              WHEN digits * 20 > n THEN 'figures' WHEN n < 500 THEN 'note'
              WHEN n < 4000 THEN 'article' ELSE 'report' END AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens,
         CAST('0x' || substr(sha256('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')
              || ':' || coalesce(sha256(text), '')), 1, 12) AS BIGINT) / {float(1 << 48)!r}::DOUBLE
           AS draw
  FROM (SELECT *, length(coalesce(text, '')) AS n,
               n - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS lines,
               n - length(regexp_replace(coalesce(text, ''), '[0-9]', '', 'g')) AS digits
        FROM documents)),
cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM rows GROUP BY ALL),
budget AS MATERIALIZED (SELECT {mixing.KEEP}::DOUBLE * sum(tokens) AS budget FROM cells)"""]
    parts.append("""
total AS MATERIALIZED (SELECT sum(tokens) AS total FROM cells)""")
    # The wishes, and the targets that are left when no category gives more than it has.
    limit = f"({mixing.AT_MOST}::DOUBLE / {mixing.KEEP}::DOUBLE)"
    for margin in margins:
        parts.append(f"""
sums_{margin} AS MATERIALIZED (
  SELECT {margin}, t / total AS own, pow(t, {mixing.FLATNESS[margin]}::DOUBLE) AS wish,
         {limit} * (t / total) AS most
  FROM (SELECT {margin}, sum(tokens) AS t FROM cells GROUP BY {margin}), total),
scale_{margin}_0 AS (SELECT 0.0::DOUBLE AS scale)""")
        for n in range(mixing.FILLS):
            parts.append(f"""
scale_{margin}_{n + 1} AS MATERIALIZED (
  SELECT coalesce((1 - coalesce(sum(most) FILTER (WHERE wish * scale > most), 0))
         / sum(wish) FILTER (WHERE wish * scale <= most), any_value(scale)) AS scale
  FROM sums_{margin}, scale_{margin}_{n})""")
        parts.append(f"""
aim_{margin} AS MATERIALIZED (
  SELECT {margin}, own, target / sum(target) OVER () AS target
  FROM (SELECT {margin}, own, least(wish * scale, most) AS target
        FROM sums_{margin}, scale_{margin}_{mixing.FILLS}))""")
    eased = ", ".join(
        f"budget * (a_{m}.target + (a_{m}.own - a_{m}.target) * easing) AS aim_{m}"
        for m in margins)
    joins = " ".join(f"JOIN aim_{m} a_{m} USING ({m})" for m in margins)
    rungs = ", ".join(f"({e!r}::DOUBLE)" for e in mixing.EASINGS)
    parts.append(f"""
raked_0 AS MATERIALIZED (
  SELECT source, lang, topic, tokens, easing, {eased}, tokens AS weight
  FROM cells {joins}, budget, (VALUES {rungs}) AS e(easing))""")
    step = 0
    for _ in range(mixing.SWEEPS):
        for margin in margins:
            parts.append(f"""
raked_{step + 1} AS MATERIALIZED (
  SELECT c.* REPLACE (least(c.weight * (c.aim_{margin} / s.total), c.tokens) AS weight)
  FROM raked_{step} c JOIN (
    SELECT {margin}, easing, sum(weight) AS total FROM raked_{step} GROUP BY ALL) s
    USING ({margin}, easing))""")
            step += 1
    offs = " UNION ALL ".join(
        f"SELECT easing, abs(sum(weight) / any_value(aim_{m}) - 1) AS off FROM raked_{step} "
        f"GROUP BY easing, {m}" for m in margins)
    parts.append(f"""
errors AS (SELECT easing, max(off) AS error FROM ({offs}) GROUP BY easing),
chosen AS MATERIALIZED (
  SELECT easing, error FROM errors WHERE error <= {mixing.TOLERANCE}::DOUBLE OR easing = 1
  ORDER BY easing LIMIT 1)""")
    return "WITH " + ",".join(parts) + f"""
SELECT doc_id, source, lang, topic, CAST(rows.tokens AS BIGINT) AS tokens,
       round(weight / c.tokens, 9) AS p, draw < round(weight / c.tokens, 9) AS kept,
       easing, round(error, 4) AS error
FROM rows JOIN raked_{step} c USING (source, lang, topic) JOIN chosen USING (easing)"""


MIXTURE = _mixture()


def _url_verdicts() -> str:
    rules = sorted(urls.RULES, key=lambda r: -len(r.name))

    def case(value: str) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) "
            f"AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'"
            for r in rules) + " END"

    href = urls.HREF.replace("'", "''")
    lower = f"'{_UPPER}', '{_LOWER}'"
    rest = 100 - urls.DAMPING_PERCENT
    parts = [rf"""
split AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS MATERIALIZED (
  SELECT *, {case("name")} AS rule, {case("verdict")} AS given FROM parsed),
links AS (
  SELECT host, CASE WHEN regexp_extract(href, '{urls.ABSOLUTE}', 1) <> ''
      THEN translate(regexp_extract(href, '{urls.ABSOLUTE}', 1), {lower})
      ELSE regexp_extract(href, '{urls.PLACE}', 1) END AS dst
  FROM (SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS href
        FROM ruled WHERE host <> '')),
found AS (
  SELECT host, dst, CAST(count(*) AS HUGEINT) AS weight FROM links
  WHERE dst <> '' AND dst <> host GROUP BY ALL),
edges AS MATERIALIZED (
  SELECT host AS src, dst, weight FROM found
  UNION ALL SELECT dst, host, weight FROM found WHERE starts_with(dst, '/')),
counts AS (
  SELECT host, count(*) FILTER (WHERE given = 'allow') AS good,
         count(*) FILTER (WHERE given = 'block') AS bad
  FROM ruled WHERE host <> '' AND given IS NOT NULL GROUP BY host),
seeds AS MATERIALIZED (
  SELECT host, {urls.UNIT}::HUGEINT * good // greatest(1, sum(good) OVER ()) AS good,
         {urls.UNIT}::HUGEINT * bad // greatest(1, sum(bad) OVER ()) AS bad FROM counts),
flows AS MATERIALIZED (
  SELECT src AS origin, dst AS host, weight,
         CAST(sum(weight) OVER (PARTITION BY src) AS HUGEINT) AS total, true AS along FROM edges
  UNION ALL
  SELECT dst, src, weight, CAST(sum(weight) OVER (PARTITION BY dst) AS HUGEINT), false
  FROM edges),
rank_0 AS MATERIALIZED (SELECT host, good AS trust, bad AS distrust FROM seeds)"""]

    def moved(mass: str, along: str) -> str:
        return (f"CASE WHEN {along} THEN CAST({mass} AS HUGEINT) * weight * {urls.DAMPING_PERCENT} "
                f"// (total * 100) ELSE 0 END")

    for i in range(urls.STEPS):
        parts.append(f"""
rank_{i + 1} AS MATERIALIZED (
  SELECT host, CAST(sum(trust) AS HUGEINT) AS trust, CAST(sum(distrust) AS HUGEINT) AS distrust
  FROM (
    SELECT f.host, {moved("trust", "along")} AS trust, {moved("distrust", "NOT along")} AS distrust
    FROM flows f JOIN rank_{i} r ON r.host = f.origin
    UNION ALL SELECT host, good * {rest} // 100, bad * {rest} // 100 FROM seeds) GROUP BY host)""")
    return "WITH " + ",".join(parts) + f"""
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN coalesce(
         distrust * 100 > trust * {urls.THRESHOLD_PERCENT}, false) THEN 'block' ELSE 'allow' END)
         AS verdict,
       CASE WHEN given IS NOT NULL THEN 'rule' WHEN coalesce(trust + distrust > 0, false)
            THEN 'links' ELSE 'default' END AS decided_by
FROM ruled LEFT JOIN rank_{urls.STEPS} USING (host)"""


URL_VERDICTS = _url_verdicts()
