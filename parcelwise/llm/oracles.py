"""DuckDB SQL with the same rows, for the operators that SQL can express."""

from __future__ import annotations

from parcelwise.llm.urls import RULES

OP1 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
fit AS (SELECT r, embedding::DOUBLE[] AS e FROM v WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pair AS (SELECT a.r AS x, b.r AS y FROM fit a JOIN fit b ON a.r < b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
link AS (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair),
reach(id, far) AS (SELECT r, r FROM v UNION SELECT r.id, l.y FROM reach r JOIN link l ON r.far = l.x),
low AS (SELECT id, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.far GROUP BY id),
n AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, low.component_id, v.vec_id IS NOT DISTINCT FROM low.component_id AS kept
FROM v JOIN low ON low.id = v.r LEFT JOIN n ON n.x = v.r
"""


def _op3() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in ordered]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    parts = """
      regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path"""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    split = f"SELECT *, translate(raw_host, '{upper}', '{lower}') AS host FROM (SELECT *, {parts} FROM (SELECT *, coalesce(CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) END, '') AS rest FROM %s))"
    url = "'^([^:/?#]+)://([^/?#]*)([^?#]*)(\\?[^#]*)?'"

    def dots(path: str) -> str:
        whole = f"regexp_replace({path}, '(/\\.{{1,2}})$', '\\1/')"
        walk = "lambda a, x: CASE WHEN x[1] = '.' THEN a WHEN x[1] = '..' THEN CASE WHEN len(a) > 1 THEN a[:-2] ELSE a END ELSE list_concat(a, x) END"
        return f"array_to_string(list_reduce(list_prepend([''], list_transform(string_split(substr({whole}, 2), '/'), lambda x: [x])), {walk}), '/')"

    def node(u: str) -> str:
        scheme, host, path, query = (f"regexp_extract({u}, {url}, {k})" for k in range(1, 5))
        scheme, host = (f"translate({x}, '{upper}', '{lower}')" for x in (scheme, host))
        bare = f"CASE WHEN {scheme} = 'http' AND ends_with({host}, ':80') THEN left({host}, -3) WHEN {scheme} = 'https' AND ends_with({host}, ':443') THEN left({host}, -4) ELSE {host} END"
        return f"CASE WHEN {scheme} <> '' THEN {scheme} || '://' || {bare} || CASE WHEN {path} = '' THEN '/' ELSE {dots(path)} END || {query} ELSE regexp_replace({u}, '#.*$', '') END"

    scheme, host, path = (f"regexp_extract(a, {url}, {k})" for k in (1, 2, 3))
    whole = f"""CASE WHEN regexp_matches(l, '(?i)^https?://') THEN l WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') OR {scheme} = '' THEN NULL
    WHEN starts_with(l, '//') THEN {scheme} || ':' || l WHEN starts_with(l, '/') THEN {scheme} || '://' || {host} || l WHEN starts_with(l, '?') THEN {scheme} || '://' || {host} || {path} || l
    WHEN l <> '' AND NOT starts_with(l, '#') THEN {scheme} || '://' || {host} || CASE WHEN {path} = '' THEN '/' ELSE regexp_replace({path}, '[^/]*$', '') END || l END"""
    return f"""
WITH RECURSIVE page AS (SELECT page_id, url AS u, {node('url')} AS node, html FROM pages),
tag AS (SELECT u AS a, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS t FROM page WHERE u IS NOT NULL),
named AS (SELECT a, trim(replace(CASE
    WHEN regexp_matches(t, '(?i)\\brel\\s*=\\s*["'']?\\s*canonical\\b') THEN
      regexp_extract(t, '(?i)\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1) || regexp_extract(t, '(?i)\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 2)
      || regexp_extract(t, '(?i)\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 3)
    WHEN regexp_matches(t, '(?i)\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b') THEN regexp_extract(t, '(?i)\\burl\\s*=\\s*["'']?([^"''>\\s]+)', 1) END, '&amp;', '&')) AS l FROM tag),
whole AS (SELECT a, {whole} AS w FROM named WHERE l IS NOT NULL),
edge AS (SELECT {node('a')} AS a, {node('w')} AS b FROM whole WHERE w IS NOT NULL),
link AS (SELECT a, b FROM edge WHERE b IS NOT NULL AND a <> b UNION SELECT b, a FROM edge WHERE b IS NOT NULL AND a <> b),
reach(node, u) AS (SELECT a, a FROM link UNION SELECT r.node, l.b FROM reach r JOIN link l ON r.u = l.a),
seen AS (SELECT node, {verdict} AS v FROM ({split % "reach"})),
alias AS (SELECT node FROM seen GROUP BY node HAVING bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), false))
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN node IN (SELECT node FROM alias) THEN 'block' END, 'allow') AS verdict
FROM ({split % "page"})
"""


OP3 = _op3()

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
low AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
d AS (SELECT p.page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes, sha1(p.h) AS x, low.first FROM p JOIN low ON low.h = p.h)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    (((('0x' || substr(x || '00', 1 + 2 * (i * 5 // 8), 4))::INTEGER) >> (11 - (i * 5 % 8))) & 31))::INTEGER, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

OP13 = """
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS ln FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t GROUP BY ALL),
cell AS (SELECT g.lang, g.source, kept.term, coalesce(n.c, 0)::HUGEINT AS c, kept.ln FROM g JOIN kept ON kept.lang = g.lang
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(ln)::HUGEINT AS l FROM kept GROUP BY lang),
tot AS (SELECT lang, source, sum(c)::HUGEINT AS total FROM cell GROUP BY lang, source),
p AS (SELECT cell.lang, cell.source, cell.term, c, 1 + (1000000000 * (c + 2)) // (total + 2 * v) AS p, 1 + (1000000000 * (ln + 2)) // (l + 2 * v) AS q
  FROM cell JOIN tot USING (lang, source) JOIN v ON v.lang = cell.lang),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM every)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE: dict[str, str] = {"op1_embedding_dedup": OP1, "op3_url_filters": OP3, "op10_warc_archives": OP10, "op13_source_divergence": OP13}
