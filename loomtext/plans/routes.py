"""Routing of every kind of collection, and its sections: over documents and conversations in their roles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.operators import routing, topics
from loomtext.plans.registry import docs, held, read

STOP = ["the", "and", "of", "to", "in"]
_OPTIONS = {"pattern": topics.LATIN_RUN, "stop": STOP}


def _sql(source: str, line: str, head: int, order: str, text: str, extra: str, cap: int = 2000, group: str = "''", keep: str = "") -> str:
    """SQL of a routing index: records packed in order, then counts, topics and what else is asked.

    source: SQL of records with ord and the columns that line, order, text and extra use; group: what is packed apart.
    """
    return f"""WITH RECURSIVE src AS ({source}
), o AS (SELECT *, {group} AS g, octet_length(encode({line} || chr(10))) // 3 AS tok, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS rn FROM src
), f AS (SELECT g, rn, {head} + tok AS cur, CAST(0 AS BIGINT) AS shard FROM o WHERE rn = 1
  UNION ALL SELECT o.g, o.rn, CASE WHEN f.cur + o.tok > {cap} THEN {head} + o.tok ELSE f.cur + o.tok END, CASE WHEN f.cur + o.tok > {cap} THEN f.shard + 1 ELSE f.shard END FROM f JOIN o ON o.g = f.g AND o.rn = f.rn + 1
), p AS (SELECT o.*, shard, max(shard) OVER (PARTITION BY o.g) AS last FROM o JOIN f USING (g, rn)
), e AS (SELECT g, shard, ord, unnest(regexp_extract_all({text}, '[A-Za-z]{{2,6}}')) AS topic, unnest(range(len(regexp_extract_all({text}, '[A-Za-z]{{2,6}}')))) AS pos FROM p
), t AS (SELECT g, shard, topic, count(*) AS n, min((ord, pos)) AS first FROM e WHERE topic NOT IN ('the', 'and', 'of', 'to', 'in') GROUP BY g, shard, topic
), k AS (SELECT *, row_number() OVER (PARTITION BY g, shard ORDER BY n DESC, first) AS rank FROM t
), q AS (SELECT g, shard, string_agg(topic, ',' ORDER BY rank) AS topics FROM k WHERE rank <= 8 GROUP BY g, shard
), c AS (SELECT g, shard, any_value(last) AS last, count(*) AS n, {extra} FROM p GROUP BY g, shard)
SELECT {keep}'shard-' || lpad(CAST(shard AS VARCHAR), CAST(greatest(2, length(CAST(last AS VARCHAR))) AS INT), '0') || '.txt' AS shard, n AS count, codes, countries, id_range, coalesce(topics, '') AS topics FROM c LEFT JOIN q USING (g, shard)"""


def _shown(ix, *more: str | Column):
    return ix.select(*more, "shard", "count", F.array_join("doc_codes", ",").alias("codes"), F.array_join("countries", ",").alias("countries"), "id_range", F.array_join("topics", ",").alias("topics"))


_TREATY = "SELECT row_number() OVER (ORDER BY conv_id, turn) AS ord, role || '--' || conv_id AS id, CAST(turn AS VARCHAR) AS pid, string_split(text, chr(10))[1] AS snippet, 'c' AS core, conv_id FROM conversations"
_LINE = "concat_ws(chr(9), id, pid, snippet, core)"
_RANGE = "arg_min(id, ord) || '〜' || arg_max(id, ord) AS id_range"


def _treaty(spark, d):
    c = read(spark, d, "conversations")
    ord_ = F.shiftleft(F.col("conv_id"), 32) + F.col("turn")  # the order alone counts, so nothing needs a running number
    return c.select(F.col("conv_id"), F.col("turn"), F.concat_ws("--", "role", "conv_id").alias("id"), F.col("turn").cast("string").alias("pid"), F.substring_index("text", "\n", 1).alias("snippet"), F.lit("c").alias("core"), ord_.cast("long").alias("ord"))


@held(_sql(_TREATY, _LINE, len("id\tpid\tsnippet\tcore\n") // 3, "ord", "snippet", f"'' AS codes, array_to_string(list_sort(list(DISTINCT string_split(id, '--')[1])), ',') AS countries, {_RANGE}"))
def routing_treaty(spark, d):
    """Records in file order, with the countries that their ids begin with."""
    profile = routing.PROFILES["treaty"]
    return _shown(routing.index(routing.lean(_treaty(spark, d), profile, cap=2_000), profile, **_OPTIONS))


@held(_sql(_TREATY, _LINE, len("id\tpid\tsnippet\tcore\n") // 3, "ord", "snippet", f"'' AS codes, '' AS countries, {_RANGE}", group="['oecd-beps', 'oecd-tpg-2022', 'nta-tp-audit'][CAST(conv_id % 3 + 1 AS INT)]", keep="g AS part, "))
def routing_paper(spark, d):
    """The three parts of the papers, each packed apart."""
    parts = F.array(*map(F.lit, routing.PAPER_PARTS))
    rows = _treaty(spark, d).withColumn("part", F.element_at(parts, (F.col("conv_id") % 3 + 1).cast("int")))
    return _shown(routing.papers(rows, cap=2_000, **_OPTIONS), "part")


_ITEMS = "SELECT doc_id AS ord, source AS doc_code, CAST(doc_id AS VARCHAR) AS item_id, string_split(text, chr(10))[1] AS title FROM documents"


@held(_sql(_ITEMS, "concat_ws(chr(9), doc_code, item_id, title)", len("doc_code\titem_id\ttitle\n") // 3, "ord", "title", "array_to_string(list_sort(list(DISTINCT doc_code)), ',') AS codes, '' AS countries, CAST(NULL AS VARCHAR) AS id_range"))
def routing_guide(spark, d):
    """Records as they come, with the codes of each shard."""
    rows = docs(spark, d).select(F.col("doc_id").alias("ord"), F.col("source").alias("doc_code"), F.col("doc_id").cast("string").alias("item_id"), F.substring_index("text", "\n", 1).alias("title"))
    profile = routing.PROFILES["guide"]
    return _shown(routing.index(routing.lean(rows, profile, cap=2_000), profile, **_OPTIONS))


@held("""WITH r AS (SELECT role AS shard, conv_id * 1000 + turn AS ord, role || '--' || conv_id AS id, string_split(text, chr(10))[1] || ' ' || role AS t FROM conversations
), e AS (SELECT shard, ord, unnest(regexp_extract_all(t, '[A-Za-z]{2,6}')) AS topic, unnest(range(len(regexp_extract_all(t, '[A-Za-z]{2,6}')))) AS pos FROM r
), g AS (SELECT shard, topic, count(*) AS n, min((ord, pos)) AS first FROM e WHERE topic NOT IN ('the', 'and', 'of', 'to', 'in') GROUP BY shard, topic
), k AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY n DESC, first) AS rank FROM g
), q AS (SELECT shard, string_agg(topic, ',' ORDER BY rank) AS topics FROM k WHERE rank <= 8 GROUP BY shard)
SELECT shard, count(*) AS count, arg_min(id, ord) || '〜' || arg_max(id, ord) AS id_range, any_value(topics) AS topics FROM r JOIN q USING (shard) GROUP BY shard""")
def routing_ranged(spark, d):
    """Shards that stay as they are."""
    rows = read(spark, d, "conversations").select(F.col("role").alias("shard"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), F.concat_ws("--", "role", "conv_id").alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.col("role").alias("topics"))
    ix = routing.ranged(rows, text=("title", "topics"), **_OPTIONS)
    return ix.select("shard", "count", "id_range", F.array_join("topics", ",").alias("topics"))


@held("""WITH e AS (SELECT conv_id, string_agg(role || '--' || conv_id || chr(9) || turn || chr(9) || CASE WHEN turn % 2 = 0 THEN role ELSE '' END, chr(10) ORDER BY turn) AS text, count(*) AS count FROM conversations GROUP BY conv_id)
SELECT *, octet_length(encode(text)) // 3 AS tokens FROM e""")
def routing_embed(spark, d):
    """All records of a small collection as one text, with its size."""
    rows = read(spark, d, "conversations").select("conv_id", F.col("turn").alias("ord"), F.concat_ws("--", "role", "conv_id").alias("id"), F.col("turn").cast("string").alias("date_iso"), F.when(F.col("turn") % 2 == 0, F.col("role")).alias("tax_types"))
    return routing.embed(rows, ["conv_id"])


def _section(kind: str, what: str) -> str:
    """SQL of a section over shards made of sources: three kinds of second column."""
    return f"""WITH r AS (SELECT source, count(*) AS n, list_sort(list(DISTINCT lang)) AS langs, min(doc_id) || '〜' || max(doc_id) AS ids FROM documents GROUP BY source)
SELECT '{kind}' AS kind, '## Shard Routing (lean)' || chr(10) || chr(10) || 'intro {kind}' || chr(10) || chr(10) || string_agg(source || ' (' || n || '件): ' || {what} || chr(10) || '  Topics: a, ' || source, chr(10) ORDER BY source) AS section FROM r"""


@held("\nUNION ALL ".join(f"SELECT * FROM ({_section(kind, what)})" for kind, what in (
    ("codes", "array_to_string(langs, ', ')"),
    ("countries", "array_to_string(langs[1:5], ', ') || CASE WHEN len(langs) > 5 THEN ' 他' || (len(langs) - 5) || 'か国' ELSE '' END"),
    ("range", "'ID ' || ids"),
    ("plain", "''"),
)))
def routing_sections(spark, d):
    """The section of an index in each of its forms."""
    ix = docs(spark, d).groupBy(F.col("source").alias("shard")).agg(F.count("*").alias("count"), F.sort_array(F.collect_set("lang")).alias("doc_codes"), F.concat(F.min("doc_id").cast("string"), F.lit("〜"), F.max("doc_id").cast("string")).alias("id_range"))
    ix = ix.withColumns({"countries": F.col("doc_codes"), "topics": F.array(F.lit("a"), F.col("shard"))})
    kinds = {"codes": {"with_codes": True}, "countries": {"with_countries": True}, "range": {"with_range": True}, "plain": {}}
    made = [routing.section(ix, [f"intro {k}"], **what).select(F.lit(k).alias("kind"), "section") for k, what in kinds.items()]
    out = made[0]
    for x in made[1:]:
        out = out.unionByName(x)
    return out
