"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .quality import STOP_WORDS
from .url_filter import RULES

_REST = "CASE WHEN position('://' in url) > 0 THEN substr(url, position('://' in url) + 3) ELSE '' END"
_NODE = r"CASE WHEN rest <> '' THEN lower(regexp_extract(rest, '^[^/?#]*')) || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END"
_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

#: Links of the pages become edges, and a recursive walk over them gives the classes.
OP6 = rf"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
tags AS (SELECT url, unnest(regexp_extract_all(
           regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>', '', 'g'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
         FROM pages WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|http-equiv')),
links AS (SELECT url, CASE
            WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?canonical["''\s/>]')
              THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
            WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh["''\s/>]')
              THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) END AS target FROM tags),
pairs AS (SELECT u AS url, t FROM (SELECT url AS u, replace(target, '&amp;', '&') AS t FROM links) WHERE contains(t, '://')),
names AS (SELECT url, {_REST} AS rest FROM (SELECT url FROM pages UNION SELECT t FROM pairs)),
nodes AS (SELECT DISTINCT url, {_NODE} AS node FROM names),
edges AS (SELECT x.node AS a, y.node AS b FROM pairs p JOIN nodes x ON x.url = p.url JOIN nodes y ON y.url = p.t
          WHERE x.node IS NOT NULL AND y.node IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
walk(node, other) AS (SELECT a, a FROM both_ways UNION SELECT w.node, e.b FROM walk w JOIN both_ways e ON e.a = w.other),
judged AS (SELECT url, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM names),
fits AS (SELECT j.url, r.verdict, r.host || r.path AS rule,
                row_number() OVER (PARTITION BY j.url ORDER BY length(r.host || r.path) DESC, r.verdict DESC) AS n
         FROM judged j JOIN rules r ON (j.host = r.host OR ends_with(j.host, '.' || r.host)) AND starts_with(j.path, r.path)),
direct AS (SELECT DISTINCT n.node, f.verdict FROM fits f JOIN nodes n USING (url) WHERE f.n = 1),
passed AS (SELECT w.node FROM walk w JOIN direct d ON d.node = w.other GROUP BY w.node
           HAVING bool_or(d.verdict = 'block') AND NOT bool_or(d.verdict = 'allow'))
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, f.rule,
       coalesce(f.verdict, CASE WHEN x.node IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM pages p LEFT JOIN judged j ON j.url = p.url LEFT JOIN fits f ON f.url = p.url AND f.n = 1
LEFT JOIN nodes n ON n.url = p.url LEFT JOIN passed x ON x.node = n.node
"""

_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l,
                  list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\s[:punct:]]+'), lambda x: x IN ({_STOP})) AS s
           FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
            FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(len(s) AS BIGINT) AS n_stop, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN covered c USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (n_words >= 20 AND (word_chars / n_words < 1.5 OR word_chars / n_words > 20.0
              OR n_symbols / word_chars > 0.1 OR (n_lines > 0 AND n_dup_lines / n_lines > 0.5)))
            OR (n_words >= 50 AND n_stop / n_words < 0.01)) AS kept
FROM b
"""
