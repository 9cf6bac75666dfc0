"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Lines of a table with their keys: {docs} has doc_id and a non-null text.
LINE_DROPS = f"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM line_docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN common USING (key))"""

SQL = {
    "op10_line_dedup": f"""
WITH line_docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), {LINE_DROPS}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op1_quality": f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs)),
wins AS (
  SELECT doc_id, pos, CASE WHEN lead(pos, 7) OVER q IS NOT NULL THEN array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), ' ') END AS win
  FROM words WINDOW q AS (PARTITION BY doc_id ORDER BY pos)),
again AS (SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins WHERE win IS NOT NULL) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM again, range(8) t(k) GROUP BY doc_id),
raw AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
lines AS (
  SELECT *, array_to_string(regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+'), ' ') AS key,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM raw),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE words > 0 GROUP BY doc_id),
common AS (
  SELECT source, key, min(doc_id) AS keeper FROM lines WHERE words > 0 GROUP BY source, key HAVING count(DISTINCT text) > 10),
gone AS (SELECT doc_id, sum(words) AS n FROM lines JOIN common USING (source, key) WHERE doc_id <> keeper GROUP BY doc_id),
base AS (
  SELECT doc_id, (SELECT count(*) FROM words w WHERE w.doc_id = d.doc_id) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_gone
  FROM docs d LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, (n_words - n_gone)::BIGINT AS n_left,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (n_words - n_gone) >= 10 * n_words AS kept
FROM base""",
    "op9_url_filter": f"""
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (page_id)""",
}
