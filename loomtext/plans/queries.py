"""Queries over the driver's tables, one for each operator or family; the SQL they are held against is in oracles.py."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import chunking, headers, integrity, packing, pages, routing, tables, topics, tree
from loomtext.plans import chunked, dialects, routes, statutes, storage  # noqa: F401 - they register their own queries
from loomtext.plans.registry import QUERIES, docs, long, query, read
from loomtext.sources import corpus, sinks

__all__ = ["QUERIES"]

STOP = ["the", "and", "of", "to", "in"]
BUDGET = 600


# packing, topics, routing


@query
def shard_pack(spark, d):
    rows = docs(spark, d).select("source", "doc_id", X.tokens("text").alias("tokens"))
    return packing.pack(rows, ["source"], ["doc_id"], F.col("tokens"), 9_500, 10)


@query
def shard_routing(spark, d):
    rows = docs(spark, d).select("source", "doc_id", "lang", X.tokens("text").alias("tokens"))
    named = packing.with_names(packing.pack(rows, ["source"], ["doc_id"], F.col("tokens"), 9_500, 10), ["source"])
    return named.groupBy("source", "file").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"), F.array_join(topics.distinct_sorted("lang"), ",").alias("langs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query
def topic_topk(spark, d):
    return topics.top(docs(spark, d), ["source"], "doc_id", "text", 8, topics.LATIN_RUN, [])


@query
def topic_stopwords(spark, d):
    return topics.top(docs(spark, d), ["lang"], "doc_id", "text", 8, topics.LATIN_RUN, STOP)


@query
def token_stats_by_source(spark, d):
    got = topics.token_stats(docs(spark, d), "source", X.tokens("text"), X.tokens(headers.drop_lines("text", ["The ", "Der "])))
    return got.select("source", "docs", "tokens_before", "tokens_after", F.round("saved_pct", 6).alias("saved_pct"))


@query
def id_range(spark, d):
    c = read(spark, d, "conversations").withColumn("id", F.concat_ws("--", "role", "turn"))
    return c.groupBy("conv_id").agg(topics.id_range("id", "turn").alias("id_range"), F.array_join(topics.countries("id"), ",").alias("prefixes"), F.count("*").alias("turns"))


@query
def topk_list_overflow(spark, d):
    li = read(spark, d, "lineitem")
    got = li.groupBy("l_orderkey").agg(F.transform(topics.distinct_sorted("l_partkey"), lambda x: x.cast("string")).alias("parts"))
    return got.select("l_orderkey", topics.overflow(F.col("parts"), 3, "").alias("parts"))


@query
def routing_section(spark, d):
    rows = docs(spark, d).select(F.col("doc_id").alias("ord"), F.col("source").alias("doc_code"), F.col("doc_id").cast("string").alias("item_id"), F.substring_index("text", "\n", 1).alias("title"))
    profile = routing.Profile(("doc_code", "item_id", "title"), ("doc_code",), "title", codes="doc_code")
    ix = routing.index(routing.lean(rows, profile, cap=2_000), profile, pattern=topics.LATIN_RUN, stop=STOP)
    return ix.select("shard", "count", F.array_join("doc_codes", ",").alias("doc_codes"), F.array_join("topics", ",").alias("topics"))


# rows, sorting, projections


@query
def qa_lean_sort(spark, d):
    c = read(spark, d, "conversations").select("role", "conv_id", "turn")
    return packing.numbered(c, ["role"], ["conv_id", "turn"])


@query
def min_arity(spark, d):
    f = F.split("text", "\\|", -1)
    return docs(spark, d).where(F.size(f) >= 6).select("doc_id", long(F.size(f)).alias("fields"), F.get(f, F.lit(0)).alias("field_0"), F.get(f, F.lit(5)).alias("field_5"))


@query
def repath_columns(spark, d):
    rows = read(spark, d, "pages").select("page_id", F.regexp_replace("url", "^https?://", "packs/").alias("text_url"), F.lit("packs/core").alias("core"))
    return corpus.rewrite(corpus.repath(corpus.drop_known(rows, ["enhanced_url"])), {"core": F.upper("core"), "missing": F.lit(1)})


@query
def url_to_relative(spark, d):
    return read(spark, d, "pages").select("page_id", X.relative_url("url", "https://").alias("url"))


@query
def first_n_lines(spark, d):
    return docs(spark, d).select("doc_id", X.unlines(X.first_lines("text", 3)).alias("head"))


@query
def trim_lines(spark, d):
    return docs(spark, d).select("doc_id", headers.drop_lines("text", ["The", "Le ", "Der "]).alias("text"))


@query
def changed_rows(spark, d):
    return sinks.changed(docs(spark, d).select("doc_id", "text"), headers.drop_lines("text", ["The", "Le ", "Der "]))


@query
def field_rename(spark, d):
    return docs(spark, d).select("doc_id", headers.rename_anywhere(headers.rename_at_line_start("text", {"url": "source_url", "tax_types": "topics"}), {"source_page": "source_url"}).alias("text"))


@query
def header_parse(spark, d):
    n = F.col("doc_id").cast("string")
    text = F.concat(F.lit("law: x (y)\nlaw_type: act / law_num: 昭和"), n, F.lit("年 / egov_id: 3"), n, F.lit("AC\narticle: "), n, F.lit("-2 / title: t\n\n"), F.coalesce("text", F.lit("")))
    return docs(spark, d).select("doc_id", headers.parse(text).alias("h"), headers.split_header(text, "blank").alias("p")).select("doc_id", "h.article", "h.egov_id", "h.law_num", F.octet_length("p.header").cast("long").alias("header_bytes"), F.col("p.body").alias("body"))


@query
def move_collections(spark, d):
    rows = docs(spark, d).select(F.col("source").alias("path"), (F.col("doc_id") % 40).cast("string").alias("stem"), F.lit("doc_code: src0\nx").alias("text")).distinct()
    return sinks.move_collections(rows, {"src0": "src1", "src2": "moved"})


# filters and checks


@query
def over_limit(spark, d):
    return chunking.over_limit(docs(spark, d), most=1_000).select("doc_id", "tokens")


@query
def tiny_docs(spark, d):
    return docs(spark, d).where((X.tokens("text") < 50) & (X.strip("text") != "")).select("doc_id", X.tokens("text").alias("tokens"))


@query
def empty_docs(spark, d):
    return docs(spark, d).where(X.strip(F.coalesce("text", F.lit(""))) == "").select("doc_id")


@query
def orphan_docs(spark, d):
    return docs(spark, d).join(read(spark, d, "labels"), "doc_id", "left_anti").select("doc_id")


def _turns(spark, d):
    """Turns with faults: no first one in every fifth conversation, a gap after two in every third."""
    late, gap = (F.col("conv_id") % 5 == 0).cast("long"), ((F.col("conv_id") % 3 == 0) & (F.col("turn") >= 2)).cast("long")
    return read(spark, d, "conversations").withColumn("turn", F.col("turn") + late + gap)


@query
def turn_continuity(spark, d):
    got = _turns(spark, d).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("found"), F.max("turn").alias("last"))
    want = F.sequence(F.lit(0).cast("long"), F.col("last"))
    return got.where(F.col("found") != want).select("conv_id", F.array_join("found", ",").alias("found"), long(F.size(F.array_except(want, "found"))).alias("missing"))


def _noted(spark, d):
    """Turns as stored chunks: a wrong note where conv_id + turn is a multiple of 13, none where of 17."""
    c = _turns(spark, d)
    total = c.groupBy("conv_id").agg((F.max("turn") + 1).alias("total"))
    n = F.col("turn") + 1
    shown = F.when((F.col("conv_id") + F.col("turn")) % 13 == 0, n + 1).otherwise(n)
    stem = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    note = F.when(n == 1, F.concat(F.lit("\n--- split 1/"), F.col("total").cast("string"), F.lit(" → next: "), stem, F.lit("_2.txt ---\n"))).when((F.col("conv_id") + F.col("turn")) % 17 == 0, "").otherwise(F.concat(F.lit("--- split "), shown.cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit(" of "), stem, F.lit(".txt ---\n")))
    text = F.when(n == 1, F.concat("text", note)).otherwise(F.concat(note, F.col("text")))
    return c.join(total, "conv_id").select(F.lit("qa").alias("db"), F.col("role").alias("_r"), F.lit("c").alias("path"), F.when(n == 1, stem).otherwise(F.concat(stem, F.lit("_"), n.cast("string"))).alias("stem"), "conv_id", "turn", text.alias("text"))


@query
def turn_annotation(spark, d):
    found = integrity.issues(_noted(spark, d).select("db", "path", "stem", "text"))
    return found.groupBy("check", "severity").agg(F.sum("counted").cast("long").alias("issues"))


@query
def integrity_listing(spark, d):
    found = integrity.listing(integrity.issues(_noted(spark, d).select("db", "path", "stem", "text")), 5)
    return found.where("check IN ('orphan_chunks', 'missing_chunks')").select("check", long("rank").alias("rank"), "subject", "detail", "total", "more")


@query
def integrity_counters(spark, d):
    return integrity.counters(docs(spark, d).select(F.col("lang").alias("db"), F.col("source").alias("path"), F.col("doc_id").cast("string").alias("stem"), "text"))


@query
def conversation_unsplit(spark, d):
    c = read(spark, d, "conversations")
    return chunking.unsplit(c.select(F.col("conv_id").alias("base_id"), (F.col("turn") + 1).cast("int").alias("chunk_n"), "text")).select(F.col("base_id").alias("conv_id"), "text")


@query
def trim_violations(spark, d):
    rows = docs(spark, d).select(F.when(F.col("lang") == "en", "law").otherwise("guide").alias("db"), F.col("lang").alias("path"), F.col("doc_id").cast("string").alias("stem"), F.concat(F.when(F.col("doc_id") % 3 == 0, "url: x\n").otherwise(""), F.when(F.col("doc_id") % 5 == 0, "section: y\n").otherwise(""), "text").alias("text"))
    return integrity.trims(integrity.described(rows)).groupBy("db", "check").agg(F.count("*").alias("issues"), F.count_if(F.contains("detail", F.lit("section"))).alias("sections"))


@query
def status_histogram(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"))


# chunking


@query
def line_blocks_lead(spark, d):
    ls = docs(spark, d).select("doc_id", F.posexplode(X.lines("text")).alias("k", "line")).where(F.length("line") > 0)
    w = Window.partitionBy("doc_id").orderBy("k")
    return ls.select("doc_id", long("k").alias("k"), long(F.lead("k").over(w)).alias("next"), long(F.row_number().over(w)).alias("n"))


@query
def line_chunk_greedy(spark, d):
    got = chunking.line_chunks(docs(spark, d), BUDGET)
    return got.groupBy("doc_id", "chunk").agg(F.count("*").alias("lines"), F.min("ord").alias("first"))


@query
def merge_small(spark, d):
    chunks = docs(spark, d).select("source", "doc_id", X.tokens("text").alias("tokens"))
    return packing.merge_small(chunks, ["source"], "doc_id", "tokens", 200).groupBy("source", "merged").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))


@query
def balanced_two_split(spark, d):
    return chunking.balanced_line(docs(spark, d))


@query
def chunk_split(spark, d):
    """Chunks of a small limit, joined again: the text has to be the same."""
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100)
    rows = docs(spark, d).select(F.col("doc_id").cast("string").alias("stem"), F.lit("qa").alias("db"), "text")
    back = chunking.unsplit(chunking.split(rows, limits))
    return back.select(F.col("base_id").alias("stem"), F.md5(F.col("text").cast("binary")).alias("text_md5"), long(F.size("missing")).alias("missing"))


# pages, links, JSON, sources


@query
def html_to_text(spark, d):
    return read(spark, d, "pages").select("page_id", pages.to_text("html").alias("text"))


@query
def html_links(spark, d):
    return pages.links(read(spark, d, "pages").select("page_id", "html"))


@query
def url_filter_links(spark, d):
    return pages.links(read(spark, d, "pages").select("page_id", "html")).where(F.lower("link").rlike("th|en")).groupBy("page_id").agg(F.count("*").alias("links"))


@query
def page_items(spark, d):
    n = F.col("page_id")
    html = F.concat(F.lit("<p>x</p>\n"), n.cast("string"), F.lit("の2－1（題"), n.cast("string"), F.lit("）\n一行<br>二行\nCopyright z\n3（終）\n末"))
    rows = read(spark, d, "pages").select("url", F.when(n % 2 == 0, html).otherwise(F.lit("a<br>b &amp; c")).alias("html"), "page_id")
    return pages.items(rows.withColumn("url", F.concat(F.lit("https://h/p"), n.cast("string"), F.lit(".htm")))).select("url", long("ord").alias("ord"), "item_id", "title", "body")


@query
def json_extract(spark, d):
    e = read(spark, d, "events")
    return e.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query
def source_resolution(spark, d):
    ids = spark.createDataFrame([("src1", "A1"), ("src2", "A2"), ("src3", "A3")], "source string, id string")
    nums = spark.createDataFrame([("src2", "N2"), ("src4", "N4")], "source string, num string")
    targets = docs(spark, d).select("doc_id", "source", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("E"), F.col("doc_id"))).otherwise("").alias("egov_id"), F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("L"), F.col("doc_id"))).otherwise("").alias("law_num"))
    return corpus.resolve(targets.withColumnRenamed("source", "key"), ids.withColumnRenamed("source", "key"), nums.withColumnRenamed("source", "key"), "key").select("doc_id", F.col("source").alias("resolved"), "mode")


@query
def positional_join(spark, d):
    c = read(spark, d, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    side = lambda role, name: c.where(F.col("role") == role).select("conv_id", long(F.row_number().over(w)).alias("ord"), F.col("turn").alias(name))
    return side("user", "ask").join(side("assistant", "answer"), ["conv_id", "ord"])


# tables and trees

@query
def markdown_render(spark, d):
    n = read(spark, d, "nation")
    grid = n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("g"))
    cells = F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), F.transform("g", lambda x: F.array(x["n_nationkey"].cast("string"), x["n_name"])))
    return grid.select("n_regionkey", tables.compact_markdown(cells).alias("markdown"))


@query
def markdown_padded(spark, d):
    n = read(spark, d, "nation")
    grid = F.array(F.array(F.lit("k"), F.lit("name")), F.array(F.col("n_nationkey").cast("string"), F.concat("n_name", F.lit("|"))))
    return n.select("n_nationkey", tables.padded_markdown(grid).alias("markdown"))


@query
def table_insert(spark, d):
    text = F.concat(F.lit("law: x\narticle: 1\n\n[p1] 次の表\n[p2] none\n[p3] 左の表 "), F.col("r_name"), F.lit("\n"))
    r = read(spark, d, "region").select("r_regionkey", text.alias("text"), F.when(F.col("r_regionkey") == 4, F.array().cast("array<string>")).otherwise(F.array(F.lit("\n| t |\n"))).alias("md"))
    return r.select("r_regionkey", tables.status("text", "md").alias("status"), tables.insert("text", "md").alias("text"))
