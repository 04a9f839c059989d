"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

_NGRAMS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets
), flat AS (SELECT doc_id, unnest(s) AS g FROM sets
), rare AS (SELECT doc_id, g, count(*) OVER (PARTITION BY g) AS df FROM flat
), firsts AS MATERIALIZED (
  SELECT doc_id, g FROM (SELECT r.doc_id, g, n, row_number() OVER (PARTITION BY r.doc_id ORDER BY df, g) AS k FROM rare r JOIN sizes USING (doc_id))
  WHERE k <= n - (85 * n + 99) // 100 + 1
), cand AS MATERIALIZED (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM firsts a JOIN firsts b ON a.g = b.g AND a.doc_id < b.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM cand JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 85 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
)
SELECT doc_id, n AS n_shingles, component_id FROM sizes JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id
"""

_NEARDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a
), n AS (SELECT a, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

# A byte k places before the end of a text adds tab[k][byte] to its CRC-32, and the start value adds what its length makes of it.
_SPELLING = r"""
WITH RECURSIVE bits AS (SELECT b, b AS c, 0 AS i FROM range(256) r(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8
), base AS MATERIALIZED (SELECT b, c FROM bits WHERE i = 8
), runs AS MATERIALIZED (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), once AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS MATERIALIZED (
  SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS v
  FROM once
), tab AS (SELECT 0 AS k, b, c FROM base
  UNION ALL SELECT k + 1, t.b, xor(t.c >> 8, base.c) FROM tab t JOIN base ON base.b = (t.c & 255) WHERE k < (SELECT max(len(v)) FROM bytes)
), start AS (SELECT 0 AS n, CAST(4294967295 AS BIGINT) AS c
  UNION ALL SELECT n + 1, xor(s.c >> 8, base.c) FROM start s JOIN base ON base.b = (s.c & 255) WHERE n < (SELECT max(len(v)) FROM bytes)
), flat AS (SELECT doc_id, run, n, len(v) AS size, unnest(v) AS b, len(v) - unnest(range(1, len(v) + 1)) AS k FROM bytes
), sums AS (SELECT doc_id, run, any_value(flat.n) AS n, any_value(size) AS size, bit_xor(tab.c) AS c FROM flat JOIN tab USING (k, b) GROUP BY doc_id, run
), hashed AS (SELECT run, sums.n, xor(xor(sums.c, start.c), 4294967295) AS h FROM sums JOIN start ON start.n = size
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), gaps AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS z FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS MATERIALIZED (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM gaps x JOIN words y ON y.word = x.a || x.z
  UNION SELECT y.word, y.n, x.word, x.n FROM gaps x JOIN words y ON y.word = x.a || x.z
), best AS (SELECT word, n, count(*) AS n_near, arg_min(struct_pack(other, other_n), struct_pack(m := -other_n, o := other)) AS b FROM pairs GROUP BY word, n
), forms AS MATERIALIZED (SELECT word, n_near, CASE WHEN b.other_n >= 5 * n THEN b.other END AS form, CASE WHEN b.other_n >= 5 * n THEN b.other_n END AS form_n FROM best
), follow AS (SELECT word, word AS root FROM words
  UNION ALL SELECT f.word, g.form FROM follow f JOIN forms g ON g.word = f.root WHERE g.form IS NOT NULL
), last AS (SELECT f.word, f.root FROM follow f LEFT JOIN forms g ON g.word = f.root WHERE g.form IS NULL)
SELECT words.word, form, root, words.n, coalesce(n_near, 0) AS n_near, form_n FROM words JOIN last USING (word) LEFT JOIN forms USING (word)
"""

SQL: dict[str, str] = {"op2_ngram_join": _NGRAMS, "op8_neardup": _NEARDUP, "op13_spelling": _SPELLING}
