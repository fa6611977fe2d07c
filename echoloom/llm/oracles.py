"""SQL twins, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from echoloom.llm.url_reputation import DOMAIN, SUFFIX

LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The words of a text, as op6 defines them.
WORDS = "list_filter(regexp_split_to_array(" + LOWERED.format("coalesce(text, '')") + ", '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def shingles(size: int) -> str:
    """The set of shingles of a list of words w."""
    joined = " || chr(31) || ".join(f"w[i + {k}]" for k in range(size))
    return f"CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {size} THEN [array_to_string(w, chr(31))] ELSE list_distinct(list_transform(range(1, len(w) - {size} + 2), lambda i: {joined})) END"


OP3 = f"""
WITH dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
iw AS (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT doc_id, unnest({shingles(5)}) AS s FROM dw),
items AS (SELECT item_id, {shingles(5)} AS g FROM iw),
its AS (SELECT item_id, len(g) AS n_item, unnest(g) AS s FROM items)
SELECT doc_id, item_id, n_item, count(*) AS n_common, count(*)::DOUBLE / n_item AS containment
FROM ds JOIN its USING (s) GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""

OP6 = f"""
WITH RECURSIVE dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (SELECT doc_id, {shingles(4)} AS g FROM dw),
ds AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM ds a JOIN ds b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, len(s.g) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.x = s.doc_id
"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, len(h) // 2 AS n_bytes FROM d),
o AS (SELECT doc_id, n_bytes, h, unnest(range(0, n_bytes, 500)) AS o FROM n),
c AS (SELECT doc_id, n_bytes, o, substr(h, 2 * o + 1, 1098) AS part FROM o),
e AS (SELECT doc_id, n_bytes, o, part, unnest(range(0, least(500, n_bytes - o))) AS k FROM c),
p AS (SELECT doc_id, o + k AS i, n_bytes, substr(part, 2 * k + 1, 100) AS t FROM e),
s AS (SELECT doc_id, i, t FROM p WHERE i + 50 <= n_bytes),
f AS (SELECT t, min(doc_id) AS first FROM s GROUP BY t),
hit AS (SELECT s.doc_id, s.i FROM s JOIN f USING (t) WHERE f.first < s.doc_id),
b AS (
  SELECT p.doc_id, p.i, substr(p.t, 1, 2) AS byte,
         max(hit.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM p LEFT JOIN hit ON hit.doc_id = p.doc_id AND hit.i = p.i),
g AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM b),
k AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM g GROUP BY doc_id)
SELECT n.doc_id, n.n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM n LEFT JOIN k USING (doc_id)
"""


def _strength(name: str, source: str) -> str:
    """One row: the strength of the prior of the rows (n, bad, m) in `source`."""
    return f"""{name} AS (
  SELECT least(greatest(CASE WHEN rho IS NULL OR rho <= 0 THEN 200.0 ELSE 1 / rho - 1 END, 1.0), 200.0) AS k FROM (
    SELECT (sum((bad - n * m) * (bad - n * m)) - sum(n * m * (1 - m))) / nullif(sum(n * m * (1 - m) * (n - 1)), 0) AS rho FROM {source}))"""


def op10(rules) -> str:
    listed = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}', '{r.text}')" for r in rules)
    return rf"""
WITH p AS (
  SELECT page_id, {LOWERED.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
i AS (SELECT *, try_cast(nullif(regexp_extract(path, '^/[a-z]{{2}}/([0-9]{{1,18}})', 1), '') AS BIGINT) AS item FROM p),
l AS (SELECT doc_id AS item, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
bare AS (
  SELECT host, count(l.bad)::DOUBLE AS n, coalesce(sum(l.bad), 0)::DOUBLE AS bad,
         any_value(regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*)?\.*$', '')) AS bare FROM i LEFT JOIN l USING (item) GROUP BY host),
hosts AS (SELECT host, n, bad, CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\[') THEN bare ELSE regexp_extract(bare, '{DOMAIN}', 0) END AS domain FROM bare),
domains AS (SELECT domain, sum(n) AS n, sum(bad) AS bad, CASE WHEN regexp_matches(domain, '^[0-9.]+$|^\[') THEN '' ELSE regexp_extract(domain, '{SUFFIX}', 1) END AS suffix FROM hosts GROUP BY domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
whole AS (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS m FROM suffixes),
s1 AS (SELECT s.*, m FROM suffixes s, whole), {_strength("k1", "s1")},
s2 AS (SELECT suffix, (bad + k * m) / (n + k) AS m FROM s1, k1),
d1 AS (SELECT d.*, m FROM domains d JOIN s2 USING (suffix)), {_strength("k2", "d1")},
d2 AS (SELECT domain, (bad + k * m) / (n + k) AS m FROM d1, k2),
h1 AS (SELECT h.*, m FROM hosts h JOIN d2 USING (domain)), {_strength("k3", "h1")},
h2 AS (SELECT host, n + k AS w, (bad + k * m) / (n + k) AS mean FROM h1, k3),
h3 AS (SELECT host, mean - 1.6448536269514722 * sqrt(mean * (1 - mean) / (w + 1)) AS bound FROM h2),
rules(verdict, host, path, text) AS (VALUES {listed}),
fit AS (
  SELECT p.page_id, arg_max(r.text, len(r.text)) AS rule, arg_max(r.verdict, len(r.text)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, CASE WHEN h3.bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (page_id) LEFT JOIN h3 ON h3.host = p.host
"""
