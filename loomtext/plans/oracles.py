"""DuckDB SQL for the queries of this package; a few whose input is literal state their rows."""

from loomtext.plans import chunked, dialects, routes, statutes, storage  # noqa: F401 - they register SQL of their own
from loomtext.plans.registry import SQL as _REGISTERED

_TOK = "octet_length(encode(text)) // 3"
_LINES = "string_split(text, chr(10))"
_TRIM = f"array_to_string(list_filter({_LINES}, lambda x: NOT starts_with(x, 'The') AND NOT starts_with(x, 'Le ') AND NOT starts_with(x, 'Der ')), chr(10))"


def _pack(select: str) -> str:
    return f"""
WITH RECURSIVE o AS (SELECT source, doc_id, lang, CAST({_TOK} AS BIGINT) AS tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents
), f AS (
  SELECT source, rn, doc_id, lang, tokens, 10 + tokens AS cur, CAST(0 AS BIGINT) AS shard FROM o WHERE rn = 1
  UNION ALL
  SELECT o.source, o.rn, o.doc_id, o.lang, o.tokens, CASE WHEN f.cur + o.tokens > 9500 THEN 10 + o.tokens ELSE f.cur + o.tokens END, CASE WHEN f.cur + o.tokens > 9500 THEN f.shard + 1 ELSE f.shard END
  FROM f JOIN o ON o.source = f.source AND o.rn = f.rn + 1
), n AS (SELECT source, max(shard) + 1 AS total FROM f GROUP BY source)
{select}"""


def _topics(group: str, stop: str = "") -> str:
    return f"""
WITH r AS (SELECT {group}, doc_id, regexp_extract_all(text, '[A-Za-z]{{2,6}}') AS m FROM documents
), e AS (SELECT {group}, doc_id, unnest(m) AS topic, unnest(range(len(m))) AS pos FROM r
), g AS (SELECT {group}, topic, count(*) AS n, min((doc_id, pos)) AS f FROM e {stop} GROUP BY {group}, topic
), k AS (SELECT {group}, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, f) AS rank, topic, n FROM g)
SELECT {group}, rank, topic, n FROM k WHERE rank <= 8"""


_TURNS = "SELECT conv_id, role, text, turn + CAST(conv_id % 5 = 0 AS BIGINT) + CAST(conv_id % 3 = 0 AND turn >= 2 AS BIGINT) AS turn FROM conversations"
_CHUNKS = f"""
t AS ({_TURNS}), m AS (SELECT conv_id, max(turn) + 1 AS total, min(turn) = 0 AS has_base FROM t GROUP BY conv_id
), c AS (SELECT t.conv_id, t.turn + 1 AS n, total, has_base, text, (t.conv_id + t.turn) % 13 = 0 AS off, (t.conv_id + t.turn) % 17 = 0 AS bare FROM t JOIN m USING (conv_id)
), k AS (SELECT *, n > 1 AND NOT bare AS is_chunk FROM c
), g AS (SELECT conv_id, list(n ORDER BY n) AS found FROM k WHERE is_chunk GROUP BY conv_id
), b AS (SELECT conv_id, total FROM k WHERE n = 1
), orphan AS (SELECT k.conv_id, k.n FROM k WHERE is_chunk AND NOT has_base
), missing AS (SELECT conv_id, found, range(2, total + 1) AS want FROM b JOIN g USING (conv_id) WHERE found <> range(2, total + 1)
), wrong AS (SELECT k.conv_id FROM k WHERE is_chunk AND has_base AND off
), remnant AS (SELECT conv_id FROM b ANTI JOIN g USING (conv_id)
), tiny AS (SELECT conv_id FROM k WHERE octet_length(encode(CASE WHEN n = 1 THEN text || chr(10) || '--- split 1/' || total || ' → next: c' || conv_id || '_2.txt ---' || chr(10)
    WHEN bare THEN text ELSE '--- split ' || (n + CAST(off AS INT)) || '/' || total || ' of c' || conv_id || '.txt ---' || chr(10) || text END)) // 3 < 50)"""

SQL: dict[str, str] = {
    "shard_pack": _pack("SELECT source, doc_id, tokens, shard FROM f"),
    "shard_routing": _pack("SELECT source, 'shard-' || lpad(CAST(shard AS VARCHAR), CAST(greatest(2, length(CAST(total - 1 AS VARCHAR))) AS INT), '0') || '.txt' AS file, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs, min(doc_id) AS first_id, max(doc_id) AS last_id FROM f JOIN n USING (source) GROUP BY source, shard, total"),
    "topic_topk": _topics("source"),
    "topic_stopwords": _topics("lang", "WHERE topic NOT IN ('the', 'and', 'of', 'to', 'in')"),
    "token_stats_by_source": f"""SELECT source, count(*) AS docs, CAST(sum(b) AS BIGINT) AS tokens_before, CAST(sum(a) AS BIGINT) AS tokens_after, round((sum(b) - sum(a)) * 100.0 / sum(b), 6) AS saved_pct
FROM (SELECT source, {_TOK} AS b, octet_length(encode(array_to_string(list_filter({_LINES}, lambda x: NOT starts_with(x, 'The ') AND NOT starts_with(x, 'Der ')), chr(10)))) // 3 AS a FROM documents) GROUP BY ROLLUP (source)""",
    "id_range": "SELECT conv_id, arg_min(role || '--' || turn, turn) || '〜' || arg_max(role || '--' || turn, turn) AS id_range, array_to_string(list_sort(list(DISTINCT role)), ',') AS prefixes, count(*) AS turns FROM conversations GROUP BY conv_id",
    "topk_list_overflow": "SELECT l_orderkey, array_to_string(p[1:3], ', ') || CASE WHEN len(p) > 3 THEN ' 他' || (len(p) - 3) ELSE '' END AS parts FROM (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS p FROM lineitem GROUP BY l_orderkey)",
    "qa_lean_sort": "SELECT role, conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS ord FROM conversations",
    "min_arity": "SELECT doc_id, len(string_split(text, '|')) AS fields, string_split(text, '|')[1] AS field_0, string_split(text, '|')[6] AS field_5 FROM documents WHERE len(string_split(text, '|')) >= 6",
    "repath_columns": "SELECT page_id, 'text/' || regexp_replace(url, '^https?://', '') AS text_url, 'TEXT/CORE' AS core FROM pages",
    "url_to_relative": "SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS url FROM pages",
    "first_n_lines": f"SELECT doc_id, array_to_string({_LINES}[1:3], chr(10)) AS head FROM documents",
    "trim_lines": f"SELECT doc_id, {_TRIM} AS text FROM documents",
    "changed_rows": f"SELECT doc_id, {_TRIM} AS text FROM documents WHERE {_TRIM} <> text",
    "field_rename": "SELECT doc_id, replace(regexp_replace(regexp_replace(text, '(?m)^url:', 'source_url:', 'g'), '(?m)^tax_types:', 'topics:', 'g'), 'source_page:', 'source_url:') AS text FROM documents",
    "header_parse": "SELECT doc_id, doc_id || '-2' AS article, '3' || doc_id || 'AC' AS egov_id, '昭和' || doc_id || '年' AS law_num, octet_length(encode('law: x (y)' || chr(10) || 'law_type: act / law_num: 昭和' || doc_id || '年 / egov_id: 3' || doc_id || 'AC' || chr(10) || 'article: ' || doc_id || '-2 / title: t' || chr(10) || chr(10))) AS header_bytes, text AS body FROM documents",
    "move_collections": """WITH r AS (SELECT DISTINCT source AS path, CAST(doc_id % 40 AS VARCHAR) AS stem, 'doc_code: src0' || chr(10) || 'x' AS text FROM documents
), k AS (SELECT * FROM r WHERE path NOT IN ('src0', 'src2')
), m AS (SELECT CASE path WHEN 'src0' THEN 'src1' ELSE 'moved' END AS path, stem, 'doc_code: src1' || chr(10) || 'x' AS text FROM r WHERE path IN ('src0', 'src2'))
SELECT * FROM k UNION ALL SELECT m.* FROM m ANTI JOIN k ON m.path = k.path AND m.stem = k.stem""",
    "over_limit": f"SELECT doc_id, {_TOK} AS tokens FROM documents WHERE {_TOK} > 1000",
    "tiny_docs": f"SELECT doc_id, {_TOK} AS tokens FROM documents WHERE {_TOK} < 50 AND regexp_matches(text, '\\S')",
    "empty_docs": "SELECT doc_id FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '\\S')",
    "orphan_docs": "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)",
    "turn_continuity": f"SELECT conv_id, array_to_string(found, ',') AS found, last + 1 - len(found) AS missing FROM (SELECT conv_id, list(turn ORDER BY turn) AS found, max(turn) AS last FROM ({_TURNS}) GROUP BY conv_id) WHERE found <> range(0, last + 1)",
    "turn_annotation": f"""WITH {_CHUNKS}, i AS (
  SELECT 'orphan_chunks' AS c, 'CRITICAL' AS s, count(DISTINCT conv_id) AS n FROM orphan UNION ALL SELECT 'missing_chunks', 'CRITICAL', count(*) FROM missing
  UNION ALL SELECT 'annotation_mismatch', 'CRITICAL', count(*) FROM wrong UNION ALL SELECT 'split_note_remnants', 'WARNING', count(*) FROM remnant
  UNION ALL SELECT 'tiny_files', 'WARNING', count(*) FROM tiny)
SELECT c AS "check", s AS severity, n AS issues FROM i WHERE n > 0""",
    "integrity_listing": f"""WITH {_CHUNKS}, i AS (
  SELECT 'orphan_chunks' AS c, 'qa/c'[1:0] || 'c/c' || conv_id || '_' || n AS subject, CAST(n AS VARCHAR) AS detail FROM orphan
  UNION ALL SELECT 'missing_chunks', 'c/c' || conv_id, 'expected ' || array_to_string(want, ',') || ' found ' || array_to_string(found, ',') FROM missing
), r AS (SELECT c, subject, detail, row_number() OVER (PARTITION BY c ORDER BY subject, detail) AS rank, count(*) OVER (PARTITION BY c) AS total FROM i)
SELECT c AS "check", rank, subject, detail, total, greatest(total - 5, 0) AS more FROM r WHERE rank <= 5""",
    "integrity_counters": f"SELECT lang AS db, count(*) AS files, count(*) AS bases, CAST(0 AS BIGINT) AS chunks, count(*) FILTER (WHERE {_TOK} > 9999) AS over FROM documents GROUP BY ROLLUP (lang)",
    "conversation_unsplit": "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "trim_violations": "SELECT db, 'trim_violations' AS \"check\", count(*) AS issues, count(*) FILTER (WHERE p = 's') AS sections FROM (SELECT CASE WHEN lang = 'en' THEN 'law' ELSE 'guide' END AS db, 'u' AS p FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'guide', 's' FROM documents WHERE lang <> 'en' AND doc_id % 5 = 0) GROUP BY db",
    "status_histogram": "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS high FROM events GROUP BY event_type",
    "line_blocks_lead": f"WITH e AS (SELECT doc_id, unnest({_LINES}) AS line, unnest(range(len({_LINES}))) AS k FROM documents) SELECT doc_id, k, lead(k) OVER w AS next, row_number() OVER w AS n FROM e WHERE length(line) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY k)",
    "line_chunk_greedy": f"""WITH RECURSIVE l AS (SELECT doc_id, unnest({_LINES}) AS line, unnest(range(len({_LINES}))) AS k FROM documents
), s AS (SELECT doc_id, k, octet_length(encode(line)) + 1 AS b FROM l
), f AS (SELECT doc_id, k, b AS cur, CAST(0 AS BIGINT) AS chunk FROM s WHERE k = 0
  UNION ALL SELECT s.doc_id, s.k, CASE WHEN f.cur + s.b > 600 THEN s.b ELSE f.cur + s.b END, CASE WHEN f.cur + s.b > 600 THEN f.chunk + 1 ELSE f.chunk END FROM f JOIN s ON s.doc_id = f.doc_id AND s.k = f.k + 1)
SELECT doc_id, chunk, count(*) AS lines, min(k) AS first FROM f GROUP BY doc_id, chunk""",
    "merge_small": f"""WITH t AS (SELECT source, doc_id, {_TOK} AS tokens FROM documents
), m AS (SELECT source, tokens, sum(CASE WHEN rn = 1 OR tokens >= 200 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id) - 1 AS merged FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM t))
SELECT source, CAST(merged AS BIGINT) AS merged, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM m GROUP BY source, merged""",
    "balanced_two_split": f"""WITH l AS (SELECT doc_id, unnest({_LINES}) AS line, unnest(range(len({_LINES}))) AS k, len({_LINES}) AS n FROM documents
), s AS (SELECT doc_id, k, n, sum(octet_length(encode(line)) + 1) OVER (PARTITION BY doc_id ORDER BY k) AS l, sum(octet_length(encode(line)) + 1) OVER (PARTITION BY doc_id) AS t FROM l
), d AS (SELECT doc_id, k, CAST(abs(2 * l - t) AS BIGINT) AS diff FROM s WHERE k < n - 1)
SELECT doc_id, arg_min(k, (diff, k)) + 1 AS line, min(diff) AS diff FROM d GROUP BY doc_id""",
    "chunk_split": "SELECT CAST(doc_id AS VARCHAR) AS stem, md5(text) AS text_md5, CAST(0 AS BIGINT) AS missing FROM documents",
    "html_to_text": "SELECT page_id, replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(13) || chr(10), chr(10)) AS text FROM pages",
    "html_links": "WITH m AS (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS m FROM pages) SELECT page_id, unnest(range(len(m))) AS ord, unnest(m) AS link FROM m",
    "url_filter_links": "WITH m AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages) SELECT page_id, count(*) AS links FROM m WHERE regexp_matches(lower(link), 'th|en') GROUP BY page_id",
    "page_items": """SELECT 'https://h/p' || page_id || '.htm' AS url, CAST(0 AS BIGINT) AS ord, 'p' || page_id AS item_id, 'p' || page_id AS title, '[p1] a' || chr(10) || 'b & c' AS body FROM pages WHERE page_id % 2 = 1
UNION ALL SELECT 'https://h/p' || page_id || '.htm', 1, page_id || '-2-1', '題' || page_id, '[p1] 一行' || chr(10) || '[p2] 二行' FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT 'https://h/p' || page_id || '.htm', 2, '3', '終', '[p1] 末' FROM pages WHERE page_id % 2 = 0""",
    "json_extract": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "source_resolution": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'E' || doc_id WHEN id IS NOT NULL THEN id WHEN num IS NOT NULL THEN num WHEN doc_id % 7 = 0 THEN 'L' || doc_id ELSE '' END AS resolved,
CASE WHEN doc_id % 5 = 0 OR id IS NOT NULL THEN 'v2' WHEN num IS NOT NULL OR doc_id % 7 = 0 THEN 'v1' ELSE 'unknown' END AS mode
FROM documents LEFT JOIN (VALUES ('src1', 'A1'), ('src2', 'A2'), ('src3', 'A3')) i(s, id) ON source = i.s LEFT JOIN (VALUES ('src2', 'N2'), ('src4', 'N4')) n(s, num) ON source = n.s""",
    "positional_join": "WITH s AS (SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS ord FROM conversations) SELECT u.conv_id, u.ord, u.turn AS ask, a.turn AS answer FROM s u JOIN s a ON u.conv_id = a.conv_id AND u.ord = a.ord WHERE u.role = 'user' AND a.role = 'assistant'",
    "markdown_render": "SELECT n_regionkey, '| key | name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || ' |', chr(10) ORDER BY n_nationkey) AS markdown FROM nation GROUP BY n_regionkey",
    "markdown_padded": "SELECT n_nationkey, chr(10) || '| ' || rpad('k', 3, ' ') || ' | ' || rpad('name', CAST(greatest(4, length(n_name) + 1) AS INT), ' ') || ' |' || chr(10) || '| --- | ' || repeat('-', greatest(4, length(n_name) + 1)) || ' |' || chr(10) || '| ' || rpad(CAST(n_nationkey AS VARCHAR), 3, ' ') || ' | ' || rpad(n_name || '｜', CAST(greatest(4, length(n_name) + 1) AS INT), ' ') || ' |' || chr(10) AS markdown FROM nation",
    "table_insert": """SELECT r_regionkey, CASE WHEN r_regionkey = 4 THEN 'no_tables' ELSE 'inserted' END AS status,
CASE WHEN r_regionkey = 4 THEN 'law: x' || chr(10) || 'article: 1' || chr(10) || chr(10) || '[p1] 次の表' || chr(10) || '[p2] none' || chr(10) || '[p3] 左の表 ' || r_name || chr(10)
ELSE 'law: x' || chr(10) || 'article: 1' || chr(10) || chr(10) || '<!--TABLE_INSERTED-->' || chr(10) || '[p1] 次の表' || chr(10) || '| t |' || chr(10) || chr(10) || '[p2] none' || chr(10) || '[p3] 左の表 ' || r_name || chr(10) END AS text FROM region""",
    "routing_section": """WITH RECURSIVE o AS (SELECT source, doc_id, string_split(text, chr(10))[1] AS title, row_number() OVER (ORDER BY source, doc_id) AS rn FROM documents
), t AS (SELECT *, octet_length(encode(source || chr(9) || doc_id || chr(9) || coalesce(title, '') || chr(10))) // 3 AS tok FROM o
), f AS (
  SELECT rn, source, doc_id, title, 7 + tok AS cur, CAST(0 AS BIGINT) AS shard FROM t WHERE rn = 1
  UNION ALL SELECT t.rn, t.source, t.doc_id, t.title, CASE WHEN f.cur + t.tok > 2000 THEN 7 + t.tok ELSE f.cur + t.tok END, CASE WHEN f.cur + t.tok > 2000 THEN f.shard + 1 ELSE f.shard END FROM f JOIN t ON t.rn = f.rn + 1
), m AS (SELECT shard, doc_id, regexp_extract_all(title, '[A-Za-z]{2,6}') AS m FROM f
), e AS (SELECT shard, doc_id, unnest(m) AS topic, unnest(range(len(m))) AS pos FROM m
), g AS (SELECT shard, topic, count(*) AS n, min((doc_id, pos)) AS first FROM e WHERE topic NOT IN ('the', 'and', 'of', 'to', 'in') GROUP BY shard, topic
), k AS (SELECT shard, topic, row_number() OVER (PARTITION BY shard ORDER BY n DESC, first) AS rank FROM g
), p AS (SELECT shard, string_agg(topic, ',' ORDER BY rank) AS topics FROM k WHERE rank <= 8 GROUP BY shard
), c AS (SELECT shard, count(*) AS n, array_to_string(list_sort(list(DISTINCT source)), ',') AS codes FROM f GROUP BY shard)
SELECT 'shard-' || lpad(CAST(shard AS VARCHAR), CAST(greatest(2, length(CAST((SELECT max(shard) FROM c) AS VARCHAR))) AS INT), '0') || '.txt' AS shard, n AS count, codes AS doc_codes, coalesce(topics, '') AS topics FROM c LEFT JOIN p USING (shard)""",
} | _REGISTERED
