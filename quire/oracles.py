"""DuckDB SQL for the registered queries of the corpus engine."""

from __future__ import annotations

WS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
GAP = r"\x09\x0b\x0c\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"


def count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def tokens(text: str) -> str:
    return count(text, f"[{WORD}]+|[^{WORD}{WS}]")


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^[{WS}]+', ''), '[{WS}]+$', '')"



def drawn(d: str, on: str = "doc_id") -> str:
    """Documents as drawings or spans on nine pages a source, and all ten pages."""
    return f"""docs AS (SELECT source AS book, {on} % 9 AS page, {d} AS d FROM documents),
drawn AS (SELECT book, page, d * 37 % 400 AS x0, d * 53 % 600 AS y0, CASE d % 5 WHEN 0 THEN 300 WHEN 1 THEN 1 WHEN 2 THEN -4 ELSE d % 50 END AS w, CASE d % 5 WHEN 0 THEN 2 WHEN 1 THEN 400 ELSE d % 30 END AS h FROM docs),
sheets AS (SELECT DISTINCT book, unnest(range(10)) AS page FROM docs)"""


P = """p AS (
  SELECT source AS book, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS page, doc_id, lang, text,
         CASE WHEN quality = 0 THEN 'failed' WHEN toxic = 1 THEN 'native_text_fallback' ELSE 'complete' END AS status
  FROM documents LEFT JOIN labels USING (doc_id))"""

COUNTS = f"""counts AS (
  SELECT doc_id, length(text) AS characters, {count("text", f"[^{WS}]")} AS nonspace, {count("text", r"[\p{L}\p{N}]")} AS alnum,
         {count("text", f"[{GAP}]")} AS spaces, {count("text", r"\n")} AS newlines, {count("text", r"\x{fffd}")} AS replaced
  FROM documents),
codes AS (
  SELECT *, list_filter([
    CASE WHEN nonspace = 0 THEN 'native_text_empty' END,
    CASE WHEN replaced / greatest(1, characters) > 0.03 THEN 'native_text_invalid_characters' END,
    CASE WHEN nonspace > 0 AND alnum / greatest(1, nonspace) < 0.3 THEN 'native_text_low_alphanumeric_ratio' END,
    CASE WHEN spaces / greatest(1, characters) > 0.7 THEN 'native_text_excessive_spaces' END,
    CASE WHEN newlines / greatest(1, characters) > 0.6 THEN 'native_text_excessive_newlines' END], lambda x: x IS NOT NULL) AS codes
  FROM counts)"""

ROUTED = f"""{P}, {COUNTS},
gates AS (
  SELECT book, page, list_filter([
    CASE WHEN page % 11 = 0 THEN 'router_disabled' END,
    CASE WHEN {strip("text")} = '' THEN 'native_text_empty' END,
    CASE WHEN page % 7 = 0 THEN 'native_render_not_structured' END,
    CASE WHEN len(codes) > 0 THEN 'native_text_quality_gate_failed' END,
    CASE WHEN lang = 'de' AND page % 3 = 0 THEN 'needs_visual_parser' END], lambda x: x IS NOT NULL) AS failed
  FROM p JOIN codes USING (doc_id)),
routed AS (SELECT *, len(list_filter(failed, lambda x: x <> 'router_disabled')) = 0 AS eligible, len(failed) = 0 AS native FROM gates)"""

LISTED = lambda test, value="page": f"coalesce(string_agg({value}::VARCHAR, ',' ORDER BY page) FILTER (WHERE {test}), '')"

#: Blocks of chunkable pages, numbered by book, and the packing fold over them as a recursive query.
PACK = f"""{P},
lines AS (
  SELECT book, page, status, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS seq
  FROM p WHERE status <> 'failed'),
sentences AS (
  SELECT book, page, seq, s, generate_subscripts(ss, 1) AS sn, unnest(ss) AS sentence
  FROM (SELECT *, string_split(regexp_replace(text, '([.!?\\x{{5c3}}。！？])[{WS}]+', '\\1' || chr(1), 'g'), chr(1)) AS ss, 0 AS s FROM lines WHERE {tokens("text")} > 300)),
sized AS (SELECT *, {tokens("sentence")} AS st FROM sentences),
runs AS (SELECT *, sum((st > 300)::INTEGER) OVER w + sum((st > 300)::INTEGER) OVER v AS run FROM sized
  WINDOW w AS (PARTITION BY book, page, seq ORDER BY sn), v AS (PARTITION BY book, page, seq ORDER BY sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
units AS (
  SELECT book, page, seq, coalesce(run, 0) AS run, sn, 0 AS wn, sentence AS unit, st AS ut FROM runs WHERE st <= 300
  UNION ALL
  SELECT book, page, seq, coalesce(run, 1), sn, wn, unit, {tokens("unit")} FROM (
    SELECT *, generate_subscripts(ws, 1) AS wn, unnest(ws) AS unit FROM (SELECT *, list_filter(regexp_split_to_array(sentence, '[{WS}]+'), lambda x: x <> '') AS ws FROM runs WHERE st > 300))),
numbered AS (SELECT *, row_number() OVER (PARTITION BY book, page, seq, run ORDER BY sn, wn) AS k FROM units),
greedy AS (
  SELECT book, page, seq, run, k, 1 AS piece, ut AS total FROM numbered WHERE k = 1
  UNION ALL
  SELECT u.book, u.page, u.seq, u.run, u.k, CASE WHEN total + ut > 300 THEN piece + 1 ELSE piece END, CASE WHEN total + ut > 300 THEN ut ELSE total + ut END
  FROM greedy g JOIN numbered u ON u.book = g.book AND u.page = g.page AND u.seq = g.seq AND u.run = g.run AND u.k = g.k + 1),
parts AS (
  SELECT book, page, seq, 0 AS run, 0 AS piece, text FROM lines WHERE {tokens("text")} <= 300
  UNION ALL
  SELECT book, page, seq, run, piece, string_agg(unit, ' ' ORDER BY k) FROM greedy JOIN numbered USING (book, page, seq, run, k) GROUP BY ALL),
blocks AS (
  SELECT book, page, parts.text, {tokens("parts.text")} AS t, row_number() OVER (PARTITION BY book ORDER BY page, seq, run, piece) AS n, status
  FROM parts JOIN p USING (book, page) WHERE {strip("parts.text")} <> ''),
fold AS (
  SELECT book, n, page, 1 AS chunk, [t] AS cur FROM blocks WHERE n = 1
  UNION ALL
  SELECT b.book, b.n, b.page,
         CASE WHEN brk THEN chunk + 1 ELSE chunk END,
         CASE WHEN gap THEN [b.t] WHEN NOT brk THEN list_append(cur, b.t)
              ELSE list_append(cur[len(cur) - kept + 1 : len(cur)], b.t) END
  FROM (
    SELECT f.*, b.n AS bn, b.page AS bpage, b.t AS bt, b.page > f.page + 1 AS gap,
           b.page > f.page + 1 OR list_sum(cur) + b.t > 300 OR list_sum(cur) >= 200 AS brk,
           (SELECT max(k) FROM range(0, len(cur) + 1) r(k)
            WHERE k <= coalesce((SELECT min(j) FROM range(0, len(cur) + 1) s(j) WHERE coalesce(list_sum(cur[len(cur) - j + 1 : len(cur)]), 0) >= 40), len(cur))
              AND coalesce(list_sum(cur[len(cur) - k + 1 : len(cur)]), 0) + b.t <= 300) AS kept
    FROM fold f JOIN blocks b ON b.book = f.book AND b.n = f.n + 1) x
  JOIN blocks b ON b.book = x.book AND b.n = x.bn),
chunks AS (
  SELECT book, chunk, min(n - len(cur) + 1) AS first, max(n) AS last FROM fold GROUP BY book, chunk),
members AS (
  SELECT c.book, c.chunk, b.n, b.page, b.status, b.text, b.t, lag(b.page) OVER (PARTITION BY c.book, c.chunk ORDER BY b.n) AS before
  FROM chunks c JOIN blocks b ON b.book = c.book AND b.n BETWEEN c.first AND c.last)"""

BOX = lambda table, key, name, wide: f"(SELECT {key} % 25 AS page, {key} AS {name}, ({key} * 37 % 400)::DOUBLE AS x0, ({key} * 53 % 600)::DOUBLE AS y0, {key} * 37 % 400 + {wide} + {key} % 7 AS x1, {key} * 53 % 600 + {wide} / 2 + {key} % 5 AS y1, text FROM {table})"
WORDS = lambda c: f"list_filter(regexp_split_to_array(lower({c}), '[^{WORD}]+'), lambda t: t <> '')"

ORACLES: dict[str, str] = {
    "page_scan": f"WITH {P} SELECT book, page, doc_id, status FROM p",
    "token_estimate": f"""
SELECT doc_id, {tokens("text")} AS tokens,
       greatest({tokens("text")}, ceil(strlen(text) / 4)::BIGINT, {count("text", rf"[^\x00-\x7f{WS}]")}) AS conservative FROM documents""",
    "text_quality": f"WITH {COUNTS} SELECT doc_id, characters, alnum, spaces, newlines, array_to_string(codes, ',') AS reason_codes FROM codes",
    "route_decision": f"WITH {ROUTED} SELECT book, page, array_to_string(failed, ',') AS failed_gates, eligible AS eligible_if_enabled, native AS route_native FROM routed",
    "router_summary": f"WITH {ROUTED} SELECT book, count(*) AS pages, count(*) FILTER (WHERE eligible) AS eligible, count(*) FILTER (WHERE native) AS routed, count(*) FILTER (WHERE NOT native) AS llm FROM routed GROUP BY book",
    "gate_histogram": f"WITH {ROUTED} SELECT book, gate, count(*) AS n FROM (SELECT book, unnest(failed) AS gate FROM routed) WHERE gate <> 'router_disabled' GROUP BY book, gate",
    "page_lists": f"""
WITH {P} SELECT book, {LISTED("status = 'failed'")} AS failed_pages, {LISTED("status = 'native_text_fallback'")} AS fallback_pages,
       {LISTED("page % 2 = 0")} AS native_routed_pages, {LISTED("page % 9 = 0")} AS visual_review_pages,
       CASE WHEN bool_or(status <> 'complete') THEN 'partial' ELSE 'complete' END AS status FROM p GROUP BY book""",
    "retry_actions": f"""
WITH {P} SELECT book, page, CASE WHEN page % 4 = 0 THEN 'process' WHEN status = 'complete' THEN 'skip'
       WHEN status = 'native_text_fallback' THEN CASE WHEN page % 3 = 0 THEN 'process' ELSE 'keep_fallback' END
       WHEN page % 3 <> 0 THEN 'leave_failed' ELSE 'process' END AS action FROM p""",
    "circuit_breaker": f"WITH {P}, q AS (SELECT book, page, status = 'failed' AS bad, lag(status = 'failed') OVER (PARTITION BY book ORDER BY page) AS before FROM p) SELECT book, min(page) AS stopped_at FROM q WHERE bad AND before GROUP BY book",
    "outline_path": f"""
WITH {P}, o AS (SELECT book, page, 'T' || page AS title FROM p WHERE page % 5 = 0)
SELECT p.book, p.page, o.title AS section FROM p ASOF LEFT JOIN o ON p.book = o.book AND p.page >= o.page""",
    "outline_tree": f"""
WITH {P}, o AS (SELECT book, page AS idx, page % 3 + 1 AS level, 'T' || page AS title FROM p WHERE page % 2 = 0)
SELECT e.book, e.idx, string_agg(a.title, ' > ' ORDER BY a.level, a.idx) AS path
FROM o e JOIN o a ON a.book = e.book AND a.idx <= e.idx AND (a.level < e.level OR a.idx = e.idx)
WHERE NOT EXISTS (SELECT 1 FROM o b WHERE b.book = e.book AND b.idx > a.idx AND b.idx <= e.idx AND b.level <= a.level)
GROUP BY e.book, e.idx""",
    "citation": f"""
WITH {P}, c AS (
  SELECT book, page, page + CASE WHEN page % 5 = 0 THEN 2 ELSE 0 END AS last,
         concat_ws(', ', CASE WHEN page % 4 <> 0 THEN 'A. ' || book || ', B. Other' END, 'Book of ' || book, CASE page % 3 WHEN 0 THEN '3rd ed.' WHEN 1 THEN 'Second edition' END, CASE WHEN page % 2 = 0 THEN '1999' END) AS label,
         CASE page % 3 WHEN 0 THEN page::VARCHAR WHEN 1 THEN 'x' || page END AS a, CASE WHEN page % 10 = 0 THEN 'x' || (page + 2) END AS b FROM p)
SELECT book, page, label || ', ' || CASE WHEN last = page THEN 'PDF p. ' || page ELSE 'PDF pp. ' || page || '-' || last END ||
       CASE WHEN a IS NULL OR (last = page AND a = page::VARCHAR) THEN '' WHEN last = page OR b IS NULL OR a = b THEN ' (printed p. ' || a || ')' ELSE ' (printed pp. ' || a || '-' || b || ')' END AS citation FROM c""",
    "bibliography": """
WITH c AS (
  SELECT doc_id AS d, coalesce(CASE WHEN doc_id % 10 = 0 THEN 'Nested' END, CASE WHEN doc_id % 5 = 0 THEN 'Title ' || doc_id END, CASE WHEN doc_id % 12 = 0 THEN 'Kept' END) AS side,
         CASE WHEN doc_id % 3 = 2 THEN 'PDF ' || doc_id END AS pdf, CASE WHEN doc_id % 6 = 0 AND doc_id % 12 <> 0 THEN 'Kept' END AS kept,
         coalesce(CASE WHEN doc_id % 9 = 0 THEN 'N. One|N. Two' END, CASE WHEN doc_id % 7 = 0 THEN 'One Author' END) AS people, CASE WHEN doc_id % 8 = 1 THEN 'P. Author' END AS pdf_people FROM documents)
SELECT d AS doc_id, coalesce(side, pdf, kept, 'file.v' || d) AS title,
       CASE WHEN side IS NOT NULL THEN 'license_sidecar' WHEN pdf IS NOT NULL OR kept IS NOT NULL THEN 'pdf_metadata' ELSE 'filename' END AS title_source,
       coalesce(people, pdf_people, '') AS authors, CASE WHEN people IS NOT NULL THEN 'license_sidecar' WHEN pdf_people IS NOT NULL THEN 'pdf_metadata' END AS authors_source,
       CASE WHEN d % 4 = 0 THEN '2' ELSE '1' END AS edition, CASE WHEN d % 2 = 0 THEN (1900 + d % 100)::VARCHAR END AS publication_year FROM c""",
    "license_gate": """
WITH r AS (SELECT DISTINCT source AS book, CASE regexp_extract(source, '\\d+')::INTEGER % 5 WHEN 0 THEN 'owned' WHEN 1 THEN 'unspecified' WHEN 2 THEN 'stolen' WHEN 3 THEN ' public-domain ' END AS raw FROM documents),
s AS (SELECT *, CASE WHEN raw IS NULL OR trim(raw) = 'unspecified' THEN 'authorized' ELSE trim(raw) END AS status FROM r)
SELECT book, status, status IN ('licensed', 'authorized', 'owned', 'public_domain', 'public-domain') AS packable,
       coalesce(raw IN ('licensed', 'authorized', 'owned', 'public_domain', 'public-domain', 'unspecified'), false) AS raw_packable FROM s""",
    "source_dedupe": "SELECT sha256(text) AS sha256, min(doc_id) AS canonical, count(*) AS n FROM documents GROUP BY 1",
    "existing_manifest": """
WITH m AS (SELECT sha256(text) AS h, arg_min('book-' || doc_id, (length('book-' || doc_id), 'book-' || doc_id)) AS existing_book_id FROM documents WHERE doc_id % 2 = 0 GROUP BY 1)
SELECT doc_id, existing_book_id FROM documents LEFT JOIN m ON h = sha256(text)""",
    "book_ids": f"""
WITH a AS (SELECT doc_id, substr(text, 1, 40) AS name, trim(regexp_replace(regexp_replace({strip("substr(text, 1, 40)")}, '[^\\p{{L}}\\p{{N}}_-]', '-', 'g'), '-+', '-', 'g'), ' .-') AS slug FROM documents)
SELECT doc_id, CASE WHEN slug = '' THEN 'book' ELSE slug END || '-' || substr(sha256(name || '.pdf'), 1, 10) AS book_id FROM a""",
    "markdown_cleanup": f"""
SELECT doc_id, sha256(CASE WHEN doc_id % 3 = 2 THEN {strip("'# Title ' || doc_id || chr(10) || text")} WHEN doc_id % 3 = 0 THEN {strip("text")} ELSE {strip("'-' || text")}[2:] END) AS body_sha256,
       CASE WHEN doc_id % 3 = 2 THEN 'Title ' || doc_id END AS heading, CASE WHEN doc_id % 3 = 2 THEN 1 END::BIGINT AS level, false AS rtl FROM documents""",
    "segments": f"""
WITH w AS (
  SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '[{WS}]+', ' ', 'g')) AS title,
         list_filter(list_transform(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '[{WS}]+', ' ', 'g'))), lambda x: x <> '') AS ps FROM pages),
b AS (
  SELECT page_id, title, list_concat([{{'t': '# ' || title, 'k': NULL}}], list_transform(ps, lambda x: {{'t': x, 'k': NULL}}),
    CASE WHEN page_id % 5 = 0 THEN [{{'t': '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | 2 |', 'k': 'markdown_table'}}] ELSE [] END,
    CASE WHEN page_id % 7 = 0 THEN [{{'t': '```text' || chr(10) || 'code' || chr(10) || chr(10) || 'more' || chr(10) || '```', 'k': 'fenced_block'}}] ELSE [] END) AS bs FROM w),
u AS (SELECT page_id, title, unnest(bs) AS b, generate_subscripts(bs, 1) - 1 AS seq FROM b)
SELECT page_id, seq, b.k AS type, title AS section, {tokens("b.t")} AS tokens FROM u""",
    "section_carry": "SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN substr(text, 1, 30) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), '') AS section FROM conversations",
    "page_gap_islands": f"""
WITH {P}, g AS (SELECT book, page, coalesce((page > lag(page) OVER (PARTITION BY book ORDER BY page) + 1)::INTEGER, 0) AS broken FROM p WHERE status <> 'failed'),
i AS (SELECT *, sum(broken) OVER (PARTITION BY book ORDER BY page)::BIGINT AS island FROM g)
SELECT book, island, min(page) AS first_page, max(page) AS last_page, count(*) AS n FROM i GROUP BY book, island""",
    "chunk_pack": f"""
WITH RECURSIVE {PACK}
SELECT book, chunk AS chunk_index, min(page) AS page_start, max(page) AS page_end, count(*) AS n_blocks, sum(t)::BIGINT AS tokens FROM members GROUP BY book, chunk""",
    "chunk_ids": f"""
WITH RECURSIVE {PACK},
bodies AS (
  SELECT book, chunk, min(page) AS page_start, max(page) AS page_end,
         string_agg(CASE WHEN before IS DISTINCT FROM page THEN '[p. ' || page || ']' || chr(10) || chr(10) ELSE '' END || text, chr(10) || chr(10) ORDER BY n) AS body
  FROM members GROUP BY book, chunk),
hashed AS (
  SELECT *, sha256(to_json({{'body': body, 'book_id': book, 'page_end': page_end, 'page_start': page_start, 'schema': 'rag-chunk-content-v1', 'section': ''}})::VARCHAR) AS h FROM bodies)
SELECT book, chunk AS chunk_index, h AS content_sha256, book || '-sha256-' || h AS chunk_id, {tokens("body")} > 300 AS oversized,
       CASE WHEN {tokens("body")} > 300 THEN 'rendered_page_markers_exceed_chunk_max' END AS oversized_reason FROM hashed""",
    "chunk_quality": f"""
WITH RECURSIVE {PACK},
used AS (SELECT DISTINCT book, chunk, page, status = 'native_text_fallback' AS f, status <> 'native_text_fallback' AND page % 2 = 0 AS s FROM members),
c AS (
  SELECT book, chunk, count(*) AS n, count(*) FILTER (WHERE f) AS nf, count(*) FILTER (WHERE s) AS ns, {LISTED("true")} AS included_pages, {LISTED("f")} AS fallback_pages, {LISTED("s")} AS native_structured_pages,
         {LISTED("page % 9 = 0")} AS visual_review_pages, min(page) AS a, max(page) AS b, max(page) FILTER (WHERE page % 4 = 0) AS o,
         count(DISTINCT page % 2) AS codes FROM used GROUP BY book, chunk)
SELECT book, chunk AS chunk_index, CASE WHEN nf = n THEN 'native_text_fallback' WHEN ns = n THEN 'native_structured' WHEN nf = 0 AND ns = 0 THEN 'gemini_visual'
       WHEN ns = 0 THEN 'mixed_gemini_and_native_text_fallback' WHEN nf = 0 THEN 'mixed_gemini_and_native_structured' ELSE 'mixed_gemini_native_structured_and_native_text_fallback' END AS source_quality,
       coalesce('S' || o, '') AS outline_section, CASE WHEN a % 3 = 0 THEN 'p' || a END AS printed_page_start, CASE WHEN b % 3 = 0 THEN 'p' || b END AS printed_page_end,
       included_pages, fallback_pages, native_structured_pages, visual_review_pages, CASE WHEN codes = 1 THEN 'r' || a % 2 ELSE 'r' || a % 2 || ',r' || (a + 1) % 2 END AS reason_codes FROM c""",
    "combined_books": f"""
WITH {P}, t AS (SELECT book AS book_id, string_agg('<!-- PAGE_START ' || page || ' -->' || chr(10) || '[Source: p. ' || page || ']' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY page) AS text FROM p GROUP BY book)
SELECT book_id, length(text) AS characters, sha256(text) AS text_sha256 FROM t""",
    "embedding_text": f"""
WITH t AS (
  SELECT doc_id, concat_ws(chr(10), 'Book: Book ' || source, CASE WHEN doc_id % 3 = 0 THEN 'Authors: X, Y' END, CASE WHEN doc_id % 2 = 0 THEN 'Edition: 2nd' END, 'Language: ' || lang, 'Section: ' || CASE WHEN doc_id % 5 = 0 THEN 'Part' ELSE '' END)
         || chr(10) || chr(10) || text AS t FROM documents)
SELECT doc_id, sha256({strip("t")}) AS input_sha256 FROM t""",
    "embed_cache_split": """
WITH k AS (SELECT doc_id, sha256(to_json({'content_sha256': sha256(text), 'dimensions': 64, 'model': 'm', 'task_type': 'RETRIEVAL_DOCUMENT'})::VARCHAR) AS key FROM documents)
SELECT key IN (SELECT key FROM k WHERE doc_id % 3 = 0) AS hit, count(*) AS n, count(DISTINCT key) AS inputs, min(key) AS first_key FROM k GROUP BY 1""",
    "vector_order": "SELECT vec_id, len(embedding) AS dim, row_number() OVER (ORDER BY label, vec_id) - 1 AS vector_index FROM embeddings",
    "corpus_meta": f"""
WITH {P} SELECT 'book_count' AS key, count(DISTINCT book)::VARCHAR AS value FROM p UNION ALL SELECT 'page_count', count(*)::VARCHAR FROM p
UNION ALL SELECT 'failed_count', count(*) FILTER (WHERE status = 'failed')::VARCHAR FROM p""",
    "preflight": f"""
WITH {P},
pp AS (SELECT *, doc_id AS d, regexp_extract(book, '\\d+')::INTEGER AS m FROM p),
b AS (SELECT book, m, count(*) AS pages FROM pp GROUP BY book, m),
fine AS (SELECT * FROM pp WHERE d % 97 <> 5 AND d % 89 <> 7),
k AS (SELECT *, page AS position FROM pp WHERE m % 20 <> 12 UNION ALL SELECT *, page + 100000 FROM pp WHERE m % 20 <> 12 AND d % 47 = 3),
w AS (SELECT * FROM k WHERE d % 53 <> 2),
f AS (
  SELECT *, {strip("'Book: ' || CASE WHEN d % 41 = 5 THEN 'x' ELSE 'Book ' || book END || chr(10) || 'Authors: A' || chr(10) || 'Language: en' || chr(10) || 'Section: ' || chr(10) || chr(10) || text")} AS e
  FROM w WHERE d % 37 <> 6),
v AS (
  SELECT book, 1 AS r FROM b WHERE m % 10 = 4 UNION ALL SELECT book, 2 FROM b WHERE m % 10 = 3 UNION ALL SELECT book, 3 FROM b WHERE m % 10 = 9 UNION ALL SELECT book, 4 FROM b WHERE m % 10 = 5
  UNION ALL SELECT book, 5 FROM b WHERE m % 10 = 6 UNION ALL SELECT book, 6 FROM b WHERE m % 10 = 7 UNION ALL SELECT book, 7 FROM b WHERE m % 20 = 12 UNION ALL SELECT book, 8 FROM b WHERE m % 10 = 8
  UNION ALL SELECT book, 9 FROM pp WHERE d % 97 = 5 UNION ALL SELECT book, 10 FROM pp WHERE d % 97 <> 5 AND d % 89 = 7 UNION ALL SELECT book, 11 FROM fine WHERE d % 83 = 1 UNION ALL SELECT book, 12 FROM fine WHERE d % 79 = 2
  UNION ALL SELECT book, 13 FROM fine WHERE d % 73 = 3 UNION ALL SELECT book, 14 FROM fine WHERE d % 71 = 4 UNION ALL SELECT book, 15 FROM fine WHERE d % 71 <> 4 AND d % 67 = 5 UNION ALL SELECT book, 16 FROM pp WHERE m % 20 = 11 AND page = 1
  UNION ALL SELECT book, 17 FROM pp WHERE d % 61 = 6 UNION ALL SELECT book, 18 FROM k WHERE d % 59 = 1 UNION ALL SELECT book, 18 FROM k WHERE d % 53 = 2 UNION ALL SELECT book, 19 FROM w WHERE position > 100000
  UNION ALL SELECT book, 20 FROM w WHERE d % 43 = 4 UNION ALL SELECT book, 21 FROM w WHERE d % 41 = 5 UNION ALL SELECT book, 22 FROM w WHERE d % 37 = 6 UNION ALL SELECT book, 23 FROM f WHERE d % 31 = 7 UNION ALL SELECT book, 24 FROM f WHERE d % 29 = 8
  UNION ALL SELECT book, 25 FROM f WHERE d % 23 = 9 UNION ALL SELECT book, 26 FROM f WHERE d % 19 = 10 UNION ALL SELECT book, 28 FROM f WHERE d % 17 = 11
  UNION ALL SELECT book, 27 FROM f WHERE greatest({tokens("e")}, ceil(strlen(e) / 4), {count("e", rf"[^\x00-\x7f{WS}]")}) > 8192),
s AS (SELECT book, min(r) AS stop FROM v WHERE r IN (1, 2, 3, 4, 5, 7, 8, 16) GROUP BY book)
SELECT v.book AS book_id, 'V' || r AS rule, CASE WHEN r IN (2, 6) THEN 'warning' ELSE 'error' END AS severity, count(*) AS n
FROM v LEFT JOIN s ON s.book = v.book WHERE r <= coalesce(stop, 99) GROUP BY ALL""",
    "bm25_topk": """
WITH terms AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN ('the', 'de', 'und', 'que', 'and') GROUP BY ALL),
dl AS (SELECT doc_id, count(*) AS dl FROM terms GROUP BY doc_id),
s AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS n, sum(dl)::DOUBLE / (SELECT count(*) FROM documents) AS avgdl FROM dl),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY term),
w AS (
  SELECT term AS query, doc_id, 10.0::DOUBLE * tf AS f, ln((n - df + 0.5) / (df + 0.5)) AS idf, dl / avgdl AS rel FROM tf JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN s),
sc AS (SELECT query, doc_id, -(CASE WHEN idf > 0 THEN idf ELSE 1e-6 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * rel)) AS score FROM w),
rk AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score, doc_id) AS rank FROM sc)
SELECT query, doc_id, rank FROM rk WHERE rank <= 10""",
    "token_coverage": f"""
WITH pairs AS (SELECT doc_id, d.text, b.text AS item FROM documents d JOIN benchmark b ON b.item_id = (SELECT list(item_id ORDER BY item_id) FROM benchmark)[doc_id % (SELECT count(*) FROM benchmark) + 1]),
want AS (SELECT doc_id, token, count(*) AS w FROM (SELECT doc_id, unnest({WORDS("text")}) AS token FROM pairs) GROUP BY ALL),
have AS (SELECT doc_id, token, count(*) AS h FROM (SELECT doc_id, unnest({WORDS("item")}) AS token FROM pairs) GROUP BY ALL),
m AS (SELECT doc_id, sum(w)::BIGINT AS total, sum(least(w, coalesce(h, 0)))::BIGINT AS matched FROM want LEFT JOIN have USING (doc_id, token) GROUP BY doc_id)
SELECT pairs.doc_id, coalesce(total, 0) AS total, coalesce(matched, 0) AS matched FROM pairs LEFT JOIN m USING (doc_id)""",
    "marginalia": f"""
WITH {P}, k AS (
  SELECT book, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(edge, '[{WS}]+', ' ', 'g'))), '^[^{WORD}]*\\p{{Nd}}+[^{WORD}]*', ''), '[^{WORD}]*\\p{{Nd}}+[^{WORD}]*$', '')) AS key FROM (SELECT book, unnest(list_distinct([string_split(text, chr(10))[1], string_split(text, chr(10))[-1]])) AS edge FROM p)),
n AS (SELECT book, count(*) AS pages FROM p GROUP BY book)
SELECT book, key, count(*) AS n FROM k JOIN n USING (book) WHERE key <> '' GROUP BY book, key, pages HAVING count(*) >= greatest(3, ceil(pages * 0.004))""",
    "font_mode": f"""
WITH {P}, l AS (SELECT book, page, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS b FROM p),
s AS (SELECT book, page, b, round(CASE WHEN b = 0 THEN 14.0 + page % 3 WHEN b % 5 = 4 THEN 9.04 ELSE 10.0 END, 1)::DOUBLE AS size, {strip("text")} AS text FROM l),
h AS (SELECT book, size, sum(greatest(1, length(text))) AS n, min((page, b)) AS first FROM s WHERE text <> '' GROUP BY book, size),
body AS (SELECT book, size AS body FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY n DESC, first) AS r FROM h) WHERE r = 1)
SELECT book, (body * 10)::BIGINT AS body_size_10, coalesce(array_to_string((list(((size * 10)::BIGINT)::VARCHAR ORDER BY size DESC) FILTER (WHERE size > body * 1.08))[1:6], ','), '') AS heading_sizes_10
FROM h JOIN body USING (book) GROUP BY book, body""",
    "containment_join": f"""
WITH b AS {BOX("documents", "doc_id", "block", 30)}, t AS {BOX("benchmark", "item_id", "tab", 300)},
c AS (
  SELECT b.page, block, tab, b.text, t.text AS own FROM b JOIN t ON b.page = t.page
  WHERE greatest(0, least(b.x1, t.x1) - greatest(b.x0, t.x0)) * greatest(0, least(b.y1, t.y1) - greatest(b.y0, t.y0)) / greatest(1, (b.x1 - b.x0) * (b.y1 - b.y0)) >= 0.95),
need AS (SELECT page, tab, token, count(*) AS need FROM (SELECT page, tab, unnest({WORDS("text")}) AS token FROM c) GROUP BY ALL),
own AS (SELECT page, tab, token, count(*) AS have FROM (SELECT page, tab, unnest({WORDS("text")}) AS token FROM t) GROUP BY ALL),
ok AS (SELECT page, tab, bool_and(coalesce(have, 0) >= need) AS ok FROM need LEFT JOIN own USING (page, tab, token) GROUP BY page, tab)
SELECT c.page, block, c.tab AS "table", coalesce(ok, true) AS accounted FROM c LEFT JOIN ok USING (page, tab)""",
    "caption_join": f"""
WITH b AS {BOX("documents", "doc_id", "block", 30)}, f AS {BOX("benchmark", "item_id", "figure", 200)}
SELECT b.page, block, min(figure) AS figure FROM b JOIN f ON b.page = f.page
WHERE greatest(0, least(b.x1, f.x1) - greatest(b.x0, f.x0)) / greatest(1, least(b.x1 - b.x0, f.x1 - f.x0)) >= 0.4 AND b.y0 - f.y1 BETWEEN 0 AND 32
GROUP BY b.page, block""",
    "page_layout": f"""
WITH {P},
l AS (SELECT book, page, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM p),
t AS (SELECT book, page, i, {strip("raw")} AS text, trim(regexp_replace(raw, '[{WS}]+', ' ', 'g')) AS line FROM l),
k AS (
  SELECT *, (i <= 1 OR i >= 33) AND regexp_full_match(text, '([0-9]+|[ivxlcdmIVXLCDM]+)') AS hidden, i = 0 AND length(text) <= 240 AS title,
         regexp_matches(text, '^([-*+•◦▪‣]|\\p{{Nd}}+[.)])[{WS}]+') AS item FROM t WHERE text <> ''),
m AS (
  SELECT *, CASE WHEN title THEN '# ' || line WHEN item AND line[1:2] NOT IN ('- ', '* ', '+ ') THEN '- ' || regexp_replace(line, '^([-*+•◦▪‣]|\\p{{Nd}}+[.)])[{WS}]+', '') ELSE line END AS markdown,
         NOT title AND item AND regexp_matches(line, '^\\p{{Nd}}') AS lost FROM k),
g AS (
  SELECT book, page, count(*) AS blocks, string_agg(markdown, chr(10) || chr(10) ORDER BY i) FILTER (WHERE NOT hidden) AS markdown,
         count(*) FILTER (WHERE lost) AS lost, sum({count("text", f"[{WORD}]+")}) FILTER (WHERE NOT hidden) AS words FROM m GROUP BY book, page),
r AS (SELECT p.book, p.page, text, coalesce(blocks, 0) AS blocks, coalesce(markdown, '') AS markdown, coalesce(lost, 0) > 0.02 * coalesce(words, 0) AS flat FROM p LEFT JOIN g ON g.book = p.book AND g.page = p.page)
SELECT book, page, CASE WHEN flat THEN 'flat_safety_fallback' ELSE 'structured' END AS render_mode, blocks, 1 AS columns, sha256(CASE WHEN flat THEN {strip("text")} ELSE markdown END) AS markdown_sha256 FROM r""",
    "quota_window": "SELECT strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
    "quota_admission": """
WITH RECURSIVE e AS (
  SELECT event_id, user_id, epoch_us(ts) AS us, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d') AS day,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (
  SELECT event_id, user_id, n, true AS admitted, us AS last, day, 1 AS used FROM e WHERE n = 1
  UNION ALL
  SELECT e.event_id, e.user_id, e.n, ok, CASE WHEN ok THEN e.us ELSE last END, CASE WHEN ok THEN e.day ELSE f.day END,
         CASE WHEN NOT ok THEN used WHEN e.day = f.day THEN used + 1 ELSE 1 END
  FROM f JOIN (SELECT * FROM e) e ON e.user_id = f.user_id AND e.n = f.n + 1
  CROSS JOIN LATERAL (SELECT e.us - f.last >= 3600000000 AND (e.day <> f.day OR f.used < 2) AS ok) x)
SELECT event_id, admitted FROM f""",
    "error_policy": """
SELECT event_id, event_id % 5 IN (0, 1) OR event_id % 7 = 0 AS retryable, event_id % 3 = 0 AS daily FROM events""",
    "permission_flags": """
SELECT doc_id, n_chars & 4 <> 0 AS print, n_chars & 8 <> 0 AS modify, n_chars & 16 <> 0 AS copy, n_chars & 32 <> 0 AS annotate, n_chars & 256 <> 0 AS form,
       n_chars & 512 <> 0 AS accessibility, n_chars & 1024 <> 0 AS assemble, n_chars & 2048 <> 0 AS print_high_quality FROM documents""",
    "metadata_clean": "SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'v' || doc_id END AS value FROM documents",
    "fts_terms": """
WITH t AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}]+'), lambda t: t <> '' AND NOT regexp_full_match(t, '[0-9]') AND t NOT IN
    ('a','an','and','are','as','at','be','body','book','by','citation','file','for','from','in','is','of','on','or','page','path','pdf','source','that','the','this','title','to','was','were','with'))) AS terms, text FROM benchmark),
o AS (SELECT item_id, list_sort(list_transform(terms, lambda t: {'at': list_position(regexp_split_to_array(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}]+'), t), 't': t}))[1:8] AS found FROM t)
SELECT item_id, CASE WHEN len(found) > 0 THEN array_to_string(list_transform(found, lambda f: '"' || f.t || '"'), ' OR ') END AS match_query FROM o""",
    "inbox_stream": """
WITH d AS (SELECT source, sha256(text) AS v FROM documents), f AS (SELECT source, string_agg(v, chr(10) ORDER BY v) || chr(10) AS content FROM d GROUP BY source)
SELECT source, strlen(content) AS length, sha256(content) AS source_sha256 FROM f""",
    "fake_vectors": "SELECT doc_id, 64 AS dim, true AS unit FROM documents",
    "day_windows": """
WITH d AS (SELECT event_id, date_trunc('day', (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles') AS d FROM events)
SELECT event_id, strftime((d AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS starts, strftime(((d + INTERVAL 1 DAY) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ends FROM d""",
    "retry_delays": "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_id % 90 + 0.5 WHEN event_id % 4 = 1 THEN event_id % 30 END::DOUBLE AS seconds FROM events",
    "vector_signals": f"""
WITH {drawn("doc_id")},
s AS (SELECT *, (h <= 2 AND w >= 120) OR (w <= 2 AND h >= 160) AS rule FROM drawn)
SELECT book, page, count(w) FILTER (WHERE NOT rule) AS drawing_count, count(w) FILTER (WHERE rule) AS decorative_rule_count,
       least(1.0, coalesce(sum(greatest(0, w) * greatest(0, h)) FILTER (WHERE NOT rule), 0) / 480000.0)::DOUBLE AS vector_density
FROM sheets LEFT JOIN s USING (book, page) GROUP BY book, page""",
    "span_density": f"""
WITH {drawn("(doc_id + 1)", "doc_id")}
SELECT book, page, coalesce(sum(greatest(0, w) * greatest(0, h)) FILTER (WHERE x0 % 7 <> 0), 0)::DOUBLE / 480000.0 AS text_density, count(w) FILTER (WHERE y0 % 4 = 0) AS invisible_ocr_spans
FROM sheets LEFT JOIN drawn USING (book, page) GROUP BY book, page""",
    "marginalia_flags": f"""
WITH {P}, t AS (SELECT book, page, string_split(text || CASE page % 3 WHEN 0 THEN chr(10) || ' ' || page WHEN 1 THEN chr(10) || 'xiv' ELSE '' END, chr(10)) AS lines FROM p),
e AS (SELECT book, page, 0 AS place, lines[1] AS text FROM t UNION ALL SELECT book, page, 1, lines[-1] FROM t),
k AS (SELECT *, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(text, '[{WS}]+', ' ', 'g'))), '^[^{WORD}]*\\p{{Nd}}+[^{WORD}]*', ''), '[^{WORD}]*\\p{{Nd}}+[^{WORD}]*$', '')) AS key FROM e),
n AS (SELECT book, count(*) AS pages FROM p GROUP BY book),
again AS (SELECT book, key FROM k JOIN n USING (book) WHERE key <> '' GROUP BY book, key, pages HAVING count(*) >= greatest(3, ceil(pages * 0.004))),
m AS (SELECT *, page % 4 <> 0 AND (book, key) IN (SELECT (book, key) FROM again) AS a, page % 4 <> 0 AND regexp_full_match(text, '[{WS}]*([0-9]+|[ivxlcdmIVXLCDM]+)[{WS}]*') AS num FROM k)
SELECT book, page, place, a OR num AS ignored, CASE WHEN a THEN 'repeated_running_header_or_footer' WHEN num THEN 'isolated_printed_page_number' END AS ignore_reason FROM m""",
    "page_files": f"""
WITH {P}
SELECT book, page, sha256(concat_ws(chr(10), '---', 'source_file: ' || CASE WHEN page % 5 <> 0 THEN '"A \\"quoted\\" \\\\ name of ' || book || '"' ELSE 'null' END, 'book_id: "' || book || '"', 'page: "' || page || '"', 'page_count: "9"',
  'citation: "p. ' || page || '"', 'status: "' || status || '"', 'parser_backend: "stub"', 'conversion_route: "' || CASE WHEN page % 2 = 0 THEN 'native_structured' ELSE 'visual_llm' END || '"', 'llm_called: "' || CASE WHEN page % 2 = 1 THEN 'true' ELSE 'false' END || '"', '---')
  || chr(10) || chr(10) || CASE status WHEN 'complete' THEN text WHEN 'failed' THEN '> [!failure] Page ' || page || ' could not be converted.' || chr(10)
     ELSE '> [!warning] Native text fallback: layout, tables and figures may be missing.' || chr(10) || chr(10) || text END || chr(10)) AS file_sha256 FROM p""",
    "citation_refresh": f"""
WITH {P}, c AS (SELECT *, 'Old, p. ' || page || ']' AS old, 'New title, p. ' || page || ']' AS new FROM p)
SELECT book AS book_id, page, CASE WHEN page % 3 = 0 THEN new ELSE old END AS citation,
       sha256(CASE WHEN page % 3 = 0 THEN '[Source: ' || new || replace(text, old, new) || new ELSE '[Source: ' || old || text || old END) AS markdown_sha256 FROM c""",
    "sidecar_pairs": """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '{"a": ' || doc_id || '}' WHEN doc_id % 2 = 0 THEN '{"b": ' || doc_id || '}' END AS license_json FROM documents""",
    "source_location": """
SELECT doc_id, CASE WHEN doc_id % 4 <> 0 AND doc_id % 3 = 0 THEN '/was/' WHEN doc_id % 2 = 0 THEN '/processed/' WHEN doc_id % 5 <> 0 THEN '/failed/' END || 'f' || doc_id || '.pdf' AS located FROM documents""",
    "source_paths": """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'in/' || page_id WHEN 1 THEN string_split(url, '/')[3] ELSE 'C:/corpus2/' || page_id END AS path, sha256(regexp_replace(html, '</?[pP]>', '', 'g')) AS bare_sha256 FROM pages""",
    "embedding_cache": """
WITH k AS (SELECT doc_id, sha256(to_json({'content_sha256': sha256(text), 'dimensions': 8, 'model': 'deterministic-fake', 'task_type': 'RETRIEVAL_DOCUMENT'})::VARCHAR) AS cache_key FROM documents)
SELECT doc_id, cache_key, cache_key IN (SELECT cache_key FROM k WHERE doc_id % 3 = 0) AS hit, 8 AS dim FROM k""",
    "cache_files": "SELECT vec_id::VARCHAR AS cache_key, len(embedding) AS dim FROM embeddings WHERE vec_id % 4 <> 0",
    "json_lines": """
SELECT CASE WHEN event_id % 10 NOT IN (3, 5) THEN event_id END AS event_id, CASE WHEN event_id % 10 NOT IN (3, 5) THEN user_id END AS user_id,
       CASE event_id % 10 WHEN 3 THEN '{"event_id": ' || event_id WHEN 5 THEN '[' || event_id || ']' END AS corrupt FROM events WHERE event_id % 10 <> 7""",
    "missing_words": f"""
WITH pairs AS (SELECT item_id, b.text AS item, d.text FROM benchmark b JOIN documents d ON d.doc_id = b.item_id),
w AS (SELECT item_id, {WORDS("item")} AS ws, {WORDS("text")} AS ts FROM pairs),
u AS (SELECT item_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS pos FROM w),
want AS (SELECT item_id, token, count(*) AS n, min(pos) AS pos FROM u GROUP BY ALL),
have AS (SELECT item_id, token, count(*) AS h FROM (SELECT item_id, unnest(ts) AS token FROM w) GROUP BY ALL),
m AS (SELECT item_id, token, n, pos, coalesce(h, 0) AS h FROM want LEFT JOIN have USING (item_id, token)),
lacks AS (SELECT item_id, list(token ORDER BY pos) AS l FROM (SELECT item_id, token, pos, unnest(range(n - h)) FROM m WHERE n > h) GROUP BY item_id),
s AS (SELECT item_id, sum(n)::BIGINT AS total, sum(least(n, h))::BIGINT AS matched FROM m GROUP BY item_id)
SELECT item_id, coalesce(total, 0) AS total, coalesce(matched, 0) AS matched, CASE WHEN total > 0 THEN matched::DOUBLE / total ELSE 1 END AS coverage, coalesce(array_to_string(l[1:30], ' '), '') AS unmatched
FROM pairs LEFT JOIN s USING (item_id) LEFT JOIN lacks USING (item_id)""",
}
