"""Splitting documents for real: every chunk of every document, held against a fold in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import chunking, headers, tables
from loomtext.plans.registry import BODY, Text, docs, held, long, query

LIMITS = chunking.Limits(most=600, target=560, small=20, least_budget=100)
TRIMMED = ("The ", "Le ", "Der ")
TABLE = "\n| t |\n| --- |\n| x |"
WITH_TABLE = Text("[p1] 次の表\n[p2] ", BODY)
_KEPT = "array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: NOT starts_with(x, 'The ') AND NOT starts_with(x, 'Le ') AND NOT starts_with(x, 'Der ')), chr(10))"
_INSERTED = f"('[p1] 次の表' || '{TABLE}' || chr(10) || '[p2] ' || coalesce(text, ''))"


def _layout(text: str, select: str) -> str:
    """SQL of the chunks of each text without a header, cut at lines; `select` reads placed (doc_id, total, n, part, body) and whole.

    Lines are packed in order while bytes // 3 keeps the budget; the last line is a chunk of its own; chunks below 20 tokens join
    the one before; three or more give way to the most even two within the limits, where there are such.
    """
    return f"""WITH RECURSIVE src AS (SELECT doc_id, {text} AS t FROM documents
), big AS (SELECT doc_id, t, octet_length(encode(t)) AS total FROM src WHERE octet_length(encode(t)) // 3 > 600
), l AS (SELECT doc_id, total, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS k, len(string_split(t, chr(10))) AS n, ends_with(t, chr(10)) AS closed FROM big
), u AS (SELECT doc_id, total, k, n - CAST(closed AS INT) AS units, line || CASE WHEN k < n - 1 THEN chr(10) ELSE '' END AS unit FROM l WHERE NOT (closed AND k = n - 1)
), b AS (SELECT *, octet_length(encode(unit)) AS bytes FROM u
), f AS (
  SELECT doc_id, k, bytes AS cur, CAST(0 AS BIGINT) AS chunk FROM b WHERE k = 0
  UNION ALL
  SELECT b.doc_id, b.k, CASE WHEN b.k = b.units - 1 OR (f.cur + b.bytes) // 3 > 510 THEN b.bytes ELSE f.cur + b.bytes END, CASE WHEN b.k = b.units - 1 OR (f.cur + b.bytes) // 3 > 510 THEN f.chunk + 1 ELSE f.chunk END
  FROM f JOIN b ON b.doc_id = f.doc_id AND b.k = f.k + 1
), c AS (SELECT f.doc_id, chunk, sum(bytes) // 3 AS tokens FROM f JOIN b USING (doc_id, k) GROUP BY f.doc_id, chunk
), m AS (SELECT doc_id, chunk, sum(CASE WHEN chunk = 0 OR tokens >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY chunk) - 1 AS part FROM c
), s AS (SELECT doc_id, max(part) + 1 AS parts FROM m GROUP BY doc_id
), o AS (SELECT doc_id, k, total, sum(bytes) OVER (PARTITION BY doc_id ORDER BY k) - bytes AS pos0 FROM b
), h AS (SELECT doc_id, arg_min(k, (abs(pos0 // 3 - (total - pos0) // 3), k)) AS half FROM o JOIN s USING (doc_id)
  WHERE parts >= 3 AND k > 0
    AND pos0 // 3 <= 595 - octet_length(encode(chr(10) || '--- split 1/2 → next: ' || doc_id || '_2.txt ---' || chr(10))) // 3
    AND (total - pos0) // 3 <= 595 - octet_length(encode('--- split 2/2 of ' || doc_id || '.txt ---' || chr(10))) // 3
  GROUP BY doc_id
), p AS (SELECT b.doc_id, b.k, b.unit, CASE WHEN half IS NULL THEN part ELSE CAST(b.k >= half AS INT) END AS part, CASE WHEN half IS NULL THEN parts ELSE 2 END AS n
  FROM b JOIN f USING (doc_id, k) JOIN m ON m.doc_id = b.doc_id AND m.chunk = f.chunk JOIN s ON s.doc_id = b.doc_id LEFT JOIN h ON h.doc_id = b.doc_id
), placed AS (SELECT doc_id, CAST(part + 1 AS BIGINT) AS chunk_n, CAST(n AS BIGINT) AS chunk_total, string_agg(unit, '' ORDER BY k) AS body FROM p WHERE n > 1 GROUP BY doc_id, part, n
), chunks AS (
  SELECT CAST(doc_id AS VARCHAR) AS base_id, chunk_n, chunk_total, CASE WHEN chunk_n = 1 THEN body || chr(10) || '--- split 1/' || chunk_total || ' → next: ' || doc_id || '_2.txt ---' || chr(10) ELSE '--- split ' || chunk_n || '/' || chunk_total || ' of ' || doc_id || '.txt ---' || chr(10) || body END AS text FROM placed
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 1, 1, t FROM src WHERE doc_id NOT IN (SELECT doc_id FROM placed)
){select}"""


_ROWS = "\nSELECT base_id, base_id || CASE WHEN chunk_n > 1 THEN '_' || chunk_n ELSE '' END AS stem, chunk_n, chunk_total, md5(text) AS text_md5 FROM chunks"


def _plain(spark, d, text=None):
    return docs(spark, d).select(F.col("doc_id").cast("string").alias("stem"), F.lit("qa").alias("db"), (F.coalesce("text", F.lit("")) if text is None else text).alias("text"))


def _shown(rows):
    return rows.select("base_id", "stem", long("chunk_n").alias("chunk_n"), long("chunk_total").alias("chunk_total"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@held(_layout("coalesce(text, '')", _ROWS))
def chunk_layout(spark, d):
    return _shown(chunking.split(_plain(spark, d), LIMITS))


@held(_layout("coalesce(text, '')", """, g AS (SELECT 'qa' AS db, base_id, max(chunk_total) AS n FROM chunks GROUP BY base_id
), w AS (SELECT db, g.base_id, n, octet_length(encode(t)) // 3 > 600 AS over FROM g JOIN src ON base_id = CAST(doc_id AS VARCHAR))
SELECT db, count(*) AS scanned, count(*) FILTER (WHERE over) AS oversized, count(*) FILTER (WHERE n > 1) AS split, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS created FROM w GROUP BY ROLLUP (db)"""))
def split_counts(spark, d):
    return chunking.split_stats(_plain(spark, d), LIMITS)


@held(_layout(_KEPT, f""", a AS (SELECT 'qa' AS db, count(*) AS chunks_after FROM chunks
), j AS (SELECT count(*) AS n FROM documents WHERE octet_length(encode(coalesce(text, ''))) // 3 > 1200)
SELECT db, count(*) AS documents, CAST((SELECT count(*) FROM documents WHERE doc_id % 3 = 0 AND contains(coalesce(text, ''), chr(10))) AS BIGINT) AS joined, CAST(sum(octet_length(encode(coalesce(d.text, ''))) // 3) AS BIGINT) AS tokens_before,
  CAST(sum(octet_length(encode({_KEPT.replace('text,', 'd.text,')})) // 3) AS BIGINT) AS tokens_after, any_value(chunks_after) AS chunks_after FROM documents d, a GROUP BY ROLLUP (db)"""))
def process_counts(spark, d):
    """Documents with a line break are stored in two chunks where their id is a multiple of 3; joined, trimmed and split again."""
    src = _plain(spark, d).withColumn("_two", (F.col("stem").cast("long") % 3 == 0) & F.contains("text", F.lit("\n")))
    head, rest = F.substring_index("text", "\n", 1), F.substr("text", F.length(F.substring_index("text", "\n", 1)) + 1)
    base = F.when(F.col("_two"), F.concat(head, F.lit("\n--- split 1/2 → next: "), F.col("stem"), F.lit("_2.txt ---\n"))).otherwise(F.col("text"))
    first = src.select("db", "stem", F.col("stem").alias("base_id"), F.lit(1).alias("chunk_n"), base.alias("text"))
    second = src.where("_two").select("db", F.concat("stem", F.lit("_2")).alias("stem"), F.col("stem").alias("base_id"), F.lit(2).alias("chunk_n"), F.concat(F.lit("--- split 2/2 of "), F.col("stem"), F.lit(".txt ---\n"), rest).alias("text"))
    return chunking.process_stats(first.unionByName(second), headers.drop_lines("text", TRIMMED), LIMITS)


@held(_layout(_INSERTED, _ROWS).replace("SELECT base_id, base_id ||", "SELECT 'inserted' AS status, base_id, base_id ||"))
def insert_overflow(spark, d):
    """Tables inserted, and documents that this makes too long split again."""
    rows = _plain(spark, d, WITH_TABLE.column).withColumn("tables", F.array(F.lit(TABLE)))
    got = tables.insert_and_split(rows, LIMITS)
    return got.select("status", *_shown(got).columns[:2], long("chunk_n").alias("chunk_n"), long("chunk_total").alias("chunk_total"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@held("""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS k FROM documents
), s AS (SELECT doc_id, k, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(line) - 1 AS pos0, length(line) AS n, sum(length(line) + 1) OVER (PARTITION BY doc_id) - 1 AS total FROM l
), c AS (SELECT doc_id, k, pos0 FROM s WHERE k > 0 AND (pos0 < total OR k % 3 < 2))
SELECT d.doc_id, count(*) FILTER (WHERE k % 3 = 0) AS level_1, count(*) FILTER (WHERE k % 3 = 1) AS level_2, count(k) AS level_3, coalesce(CAST(sum(pos0 + CASE WHEN k > 0 THEN 6 * ((k + 2) // 3) + 9 * ((k + 1) // 3) ELSE 0 END) FILTER (WHERE k % 3 = 0) AS BIGINT), 0) AS sum_1
FROM documents d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id""")
def boundary_levels(spark, d):
    """Every third line marked [p00], the next [p00-i00]: how many places each level may cut at, and where the first may."""

    @F.pandas_udf("level_1 long, level_2 long, level_3 long, sum_1 long")
    def counted(texts):
        import pandas as pd

        found = [chunking.boundaries(t, "law") for t in texts]
        return pd.DataFrame([(len(a), len(b), len(c), sum(a)) for a, b, c in found], columns=["level_1", "level_2", "level_3", "sum_1"])

    marked = F.transform(X.lines(F.coalesce("text", F.lit(""))), lambda x, i: F.concat(F.when(i % 3 == 0, "[p00] ").when(i % 3 == 1, "[p00-i0]").otherwise(""), F.when(i % 3 == 1, F.lit("x")).otherwise(F.lit("")), x))
    return docs(spark, d).select("doc_id", counted(X.unlines(marked)).alias("c")).select("doc_id", "c.*")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def chunk_tokens(spark, d):
    """Whole documents of three dbs under a budget of a vocabulary's tokens, and what each chunk measures. SQL has no tokenizer."""
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100, vocabulary=vocabulary())
    db = F.element_at(F.array(F.lit("qa"), F.lit("law"), F.lit("paper")), (F.col("doc_id") % 3 + 1).cast("int"))
    head = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("law: L"), "doc_id", F.lit("\narticle: 1\n\n"))).when(F.col("doc_id") % 3 == 2, F.concat(F.lit("---\nid: "), "doc_id", F.lit("\n---\n"))).otherwise("")
    got = chunking.split(docs(spark, d).select("doc_id", db.alias("db"), F.col("doc_id").cast("string").alias("stem"), F.concat(head, F.coalesce("text", F.lit(""))).alias("text")), limits)
    shown = got.withColumn("tokens", chunking.measured("text", limits.vocabulary))
    return shown.select("base_id", long("chunk_n").alias("chunk_n"), long("chunk_total").alias("chunk_total"), "tokens", "token_method", F.md5(F.col("text").cast("binary")).alias("text_md5"))
