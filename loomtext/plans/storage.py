"""Files written and read back: texts, shards, tables with headers, routing, documents. They lie in the shared folder until the driver ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import integrity, packing, routing
from loomtext.plans.registry import docs, held, long, read
from loomtext.scratch import claim
from loomtext.sources import corpus, sinks, versions

_TOK = "octet_length(encode(text)) // 3"


@held("SELECT 'law' AS db, 'source=' || source AS path, count(*) AS lines, CAST(sum(octet_length(encode(string_split(text, chr(10))[1]))) AS BIGINT) AS bytes FROM documents GROUP BY source")
def text_tree(spark, d):
    """Titles written as text files below law/text, one folder for each source, and read back whole."""
    root = claim(spark, "tree")
    titles = docs(spark, d).select("source", F.substring_index("text", "\n", 1).alias("value"))
    titles.write.partitionBy("source").text(f"{root}/law/text")
    back = corpus.documents(spark, root)
    lines = F.filter(X.lines("text"), lambda x: x != "")
    return back.groupBy("db", "path").agg(long(F.sum(F.size(lines))).alias("lines"), long(F.sum(F.aggregate(F.transform(lines, F.octet_length), F.lit(0), lambda a, x: a + x))).alias("bytes"))


def _records(spark, d) -> tuple[DataFrame, str]:
    """Records with an empty last field on every third, as tab-separated files with a header."""
    path = claim(spark, "records")
    c = read(spark, d, "conversations").select(F.concat_ws("--", "role", "conv_id").alias("id"), F.col("turn").cast("string").alias("pid"), F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("role")).alias("core"))
    c.write.csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")
    return c, path


@held("SELECT role || '--' || conv_id AS id, CAST(turn AS VARCHAR) AS pid, CASE WHEN turn % 3 = 0 THEN '' ELSE role END AS core FROM conversations")
def shard_scan(spark, d):
    """Shard files by position: no header line, empty fields at the end kept."""
    _, path = _records(spark, d)
    return corpus.shards(spark, path, ["id", "pid", "core"], "*.csv", least=3).select("id", "pid", "core")


@held("""WITH t AS (SELECT coalesce(conv_id, -1) AS conv, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, regexp_replace(coalesce(text, ''), '[\\t\\r\\n]', ' ', 'g') AS line FROM conversations)
SELECT CAST(conv // 200 AS BIGINT) AS bucket, CAST(row_number() OVER (PARTITION BY conv // 200 ORDER BY conv, turn, role, line) - 1 AS BIGINT) AS ord, conv, turn, md5(line) AS line_md5 FROM t""")
def line_numbers(spark, d):
    """Whole turns written as sorted lines, a file for each 200 conversations, and read with their numbers by blocks."""
    path = claim(spark, "lines")
    either = lambda c, other: F.coalesce(F.col(c), F.lit(other)).alias(c)
    t = read(spark, d, "conversations").select(either("conv_id", -1), either("turn", -1), either("role", ""), F.regexp_replace(either("text", ""), r"[\t\r\n]", " ").alias("line"))
    t = t.withColumn("bucket", F.floor(F.col("conv_id") / 200)).repartition("bucket").sortWithinPartitions("bucket", "conv_id", "turn", "role", "line")
    t.select("bucket", F.concat_ws("\t", "conv_id", "turn", "line").alias("value")).write.partitionBy("bucket").text(path)
    f = F.split("line", "\t", -1)
    back = corpus.numbered_lines(spark, path)
    return back.select(long(F.regexp_extract("at", r"bucket=(-?\d+)", 1)).alias("bucket"), "ord", long(f[0]).alias("conv"), long(f[1]).alias("turn"), F.md5(f[2].cast("binary")).alias("line_md5"))


@held("SELECT count(*) AS n FROM conversations WHERE false")
def shard_arity(spark, d):
    """The same with a least number of fields that no record has."""
    _, path = _records(spark, d)
    return corpus.shards(spark, path, ["id"], "*.csv", least=4).agg(F.count("*").alias("n"))


@held("SELECT role || '--' || conv_id AS id, CASE WHEN turn % 3 = 0 THEN NULL ELSE role END AS core FROM conversations")
def tsv_by_name(spark, d):
    """The same files by the names in their header; unknown names are passed over."""
    _, path = _records(spark, d)
    return corpus.keep_known(corpus.tsv(spark, path), ["id", "core", "missing"])


def _written(spark, d, path: str, cap: int) -> DataFrame:
    rows = docs(spark, d).select("source", "doc_id", "lang", X.tokens("text").alias("tokens"), F.substring_index("text", "\n", 1).alias("title"))
    named = packing.with_names(packing.pack(rows, [], ["doc_id"], F.col("tokens"), cap, 10), [])
    return sinks.write_shards(named.withColumn("id", F.col("doc_id").cast("string")), ["id", "lang", "title"], path, ["doc_id"])


@held(f"""WITH RECURSIVE o AS (SELECT doc_id, lang, string_split(text, chr(10))[1] AS title, CAST({_TOK} AS BIGINT) AS tokens, row_number() OVER (ORDER BY doc_id) AS rn FROM documents
), f AS (SELECT rn, doc_id, lang, title, 10 + tokens AS cur, CAST(0 AS BIGINT) AS shard FROM o WHERE rn = 1
  UNION ALL SELECT o.rn, o.doc_id, o.lang, o.title, CASE WHEN f.cur + o.tokens > 9500 THEN 10 + o.tokens ELSE f.cur + o.tokens END, CASE WHEN f.cur + o.tokens > 9500 THEN f.shard + 1 ELSE f.shard END FROM f JOIN o ON o.rn = f.rn + 1)
SELECT 'shard-' || lpad(CAST(shard AS VARCHAR), CAST(greatest(2, length(CAST((SELECT max(shard) FROM f) AS VARCHAR))) AS INT), '0') || '.txt' AS file, md5('id' || chr(9) || 'lang' || chr(9) || 'title' || chr(10) || string_agg(doc_id || chr(9) || lang || chr(9) || title, chr(10) ORDER BY doc_id) || chr(10)) AS text_md5 FROM f GROUP BY shard""")
def shard_files(spark, d):
    """Shards written twice, the second time fewer and larger ones: only these are left."""
    path = claim(spark, "shards")
    _written(spark, d, path, 4_000)
    _written(spark, d, path, 9_500)
    return spark.read.parquet(path).select("file", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@held("SELECT lang AS db, CAST(doc_id AS VARCHAR) AS stem, octet_length(encode(coalesce(text, ''))) // 3 AS tokens FROM documents")
def document_files(spark, d):
    """Documents written by db and read back; the sizes are those that the writer reports."""
    path = claim(spark, "documents")
    rows = docs(spark, d).select(F.col("lang").alias("db"), F.col("doc_id").cast("string").alias("stem"), "text")
    said = sinks.write_documents(rows, path)
    back = spark.read.parquet(path).select("db", "stem", X.tokens("text").alias("_t"))
    return said.join(back, ["db", "stem"]).where("tokens = _t").select("db", "stem", "tokens")


@held("""SELECT source AS shard, count(*) AS "count", array_to_string(list_sort(list(DISTINCT lang)), ',') AS doc_codes, '{"shard":"' || source || '","count":' || count(*) || ',"doc_codes":["' || array_to_string(list_sort(list(DISTINCT lang)), '","') || '"]}' AS json FROM documents GROUP BY source""")
def routing_files(spark, d):
    """A routing index written as JSON and read back, beside the JSON text of each shard without its null fields."""
    path = claim(spark, "routing")
    ix = docs(spark, d).groupBy(F.col("source").alias("shard")).agg(F.count("*").alias("count"), F.sort_array(F.collect_set("lang")).alias("doc_codes"), F.first(F.lit(None).cast("string")).alias("id_range"))
    sinks.write_routing(ix, path)
    back = corpus.json_documents(spark, path, whole_files=False)
    return back.select("shard", "count", F.array_join("doc_codes", ",").alias("doc_codes")).join(sinks.routing_json(ix).select("json", F.get_json_object("json", "$.shard").alias("shard")), "shard")


@held("""WITH c AS (SELECT CAST(doc_id % 20 AS VARCHAR) AS path, doc_id, CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END AS done, doc_id % 4 = 1 AS chunk FROM documents WHERE doc_id % 3 = 0)
SELECT path, CASE WHEN chunk THEN (doc_id - 1) || '_2' ELSE CAST(doc_id AS VARCHAR) END AS stem, chunk AS is_chunk, CASE WHEN chunk THEN '' ELSE doc_id || '-1' END AS article, CASE WHEN chunk THEN '' ELSE 'E' || doc_id END AS egov_id, CASE WHEN chunk THEN '' ELSE 'n' || doc_id END AS law_num, done = 1 AS already_done FROM c""")
def table_references(spark, d):
    """Documents that refer to a table (every third), with the fields of their header; chunks whose base isn't there have none."""
    i, k = F.col("doc_id"), F.col("doc_id").cast("string")
    chunk = i % 4 == 1
    base = F.concat(F.lit("law: x\nlaw_num: n"), k, F.lit(" / egov_id: E"), k, F.lit("\narticle: "), k, F.lit("-1 / title: t\n\n"))
    note = F.concat(F.lit("--- split 2/2 of "), (i - 1).cast("string"), F.lit(".txt ---\n"))
    text = F.concat(F.when(chunk, note).otherwise(base), F.when(i % 3 == 0, F.lit("[p1] 下の表\n")).otherwise("[p1] none\n"), F.when(i % 6 == 0, F.lit("<!--TABLE_INSERTED-->")).otherwise(""))
    rows = docs(spark, d).select((i % 20).cast("string").alias("path"), F.when(chunk, F.concat((i - 1).cast("string"), F.lit("_2"))).otherwise(k).alias("stem"), text.alias("text"))
    return corpus.table_targets(rows).drop("text")


@held("SELECT page_id, CAST(unnest(range(5)) AS BIGINT) AS ord, unnest(['http://h.example/a/b/x.htm', 'http://h.example/y.htm', 'http://h.example/a/z.htm', 'https://o.example/w.htm', 'http://c.example/v.htm']) AS link FROM pages")
def absolute_links(spark, d):
    """Relative addresses of every form against an address of their own."""
    from loomtext.operators import pages

    links = F.array(*map(F.lit, ("x.htm", "/y.htm", "../z.htm", "https://o.example/w.htm", "//c.example/v.htm")))
    rows = read(spark, d, "pages").select("page_id", F.posexplode(links).alias("ord", "_l"))
    return rows.select("page_id", long("ord").alias("ord"), pages.absolute(F.lit("http://h.example/a/b/c.htm"), "_l").alias("link"))


@held("""WITH m AS (SELECT page_id, unnest(regexp_extract_all(html || '<a href="p/Jisshi' || page_id || '.htm"><a href="tokurei.htm"><a href="tokurei.html">', 'href="([^"]*\\.htm)"', 1)) AS link FROM pages)
SELECT page_id, count(*) AS links FROM m WHERE regexp_matches(lower(link), 'jisshi|tokurei') GROUP BY page_id""")
def topic_pages(spark, d):
    """Links to pages on two topics, among the links of each whole page."""
    from loomtext.operators import pages

    more = F.concat(F.col("html"), F.lit('<a href="p/Jisshi'), F.col("page_id").cast("string"), F.lit('.htm"><a href="tokurei.htm"><a href="tokurei.html">'))
    return pages.topic_links(read(spark, d, "pages").select("page_id", more.alias("html"))).groupBy("page_id").agg(F.count("*").alias("links"))


@held("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN string_split(text, chr(10))[1] ELSE string_split(text, chr(10))[1] END || chr(10) || chr(10) || '## Shard Routing (lean)' || chr(10) || 'new ' || doc_id || chr(10) AS once, true AS same_again FROM documents""")
def section_upsert(spark, d):
    """A section put after a text, or instead of an older one; putting it again changes nothing."""
    title, new = F.rtrim(F.substring_index("text", "\n", 1)), F.concat(F.lit(f"{routing.MARKER}\nnew "), F.col("doc_id").cast("string"))
    old = F.when(F.col("doc_id") % 2 == 0, F.concat(title, F.lit(f" \n\n{routing.MARKER}\nold\nlines\n"))).otherwise(title)
    once = docs(spark, d).select("doc_id", routing.upsert(old, new).alias("once"), new.alias("_n"))
    return once.select("doc_id", "once", (routing.upsert("once", "_n") == F.col("once")).alias("same_again"))


_PAGE_TEXT = "replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(13) || chr(10), chr(10))"


@held(f"""WITH l AS (SELECT page_id, list_filter(list_transform(string_split({_PAGE_TEXT}, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '' AND NOT starts_with(x, 'Copyright') AND NOT starts_with(x, 'ページの先頭')) AS w FROM pages)
SELECT 'https://h/p' || page_id || '.htm' AS url, CAST(1 AS BIGINT) AS ord, page_id || '-1' AS item_id, '題' AS title, array_to_string(list_transform(w, lambda x, i: '[p' || i || '] ' || x), chr(10)) AS body FROM l WHERE len(w) > 0""")
def page_items_whole(spark, d):
    """Each whole page below a heading: one item of all its lines."""
    from loomtext.operators import pages

    n = F.col("page_id").cast("string")
    html = F.concat(F.lit("<p>x</p>\n"), n, F.lit("の1（題）\n"), F.col("html"))
    rows = read(spark, d, "pages").select(F.concat(F.lit("https://h/p"), n, F.lit(".htm")).alias("url"), html.alias("html"))
    return pages.items(rows).select("url", long("ord").alias("ord"), "item_id", "title", "body")


@held("""WITH r AS (SELECT source AS path, CAST(doc_id % 200 AS VARCHAR) AS stem, 'doc_code: ' || source || chr(10) || coalesce(text, '') AS text FROM documents
), k AS (SELECT * FROM r WHERE path NOT IN ('src0', 'src2')
), m AS (SELECT CASE path WHEN 'src0' THEN 'src1' ELSE 'moved' END AS path, stem, CASE WHEN path = 'src0' THEN regexp_replace(text, '(?m)^doc_code: src0$', 'doc_code: src1', 'g') ELSE regexp_replace(text, '(?m)^doc_code: src2$', 'doc_code: moved', 'g') END AS text FROM r WHERE path IN ('src0', 'src2'))
SELECT path, stem, md5(text) AS text_md5 FROM k UNION ALL SELECT m.path, m.stem, md5(m.text) FROM m ANTI JOIN k ON m.path = k.path AND m.stem = k.stem""")
def move_documents(spark, d):
    """Collections renamed, with the whole texts of all their documents."""
    rows = docs(spark, d).select(F.col("source").alias("path"), (F.col("doc_id") % 200).cast("string").alias("stem"), F.concat(F.lit("doc_code: "), "source", F.lit("\n"), F.coalesce("text", F.lit(""))).alias("text"))
    return sinks.move_collections(rows, {"src0": "src1", "src2": "moved"}).select("path", "stem", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@held("""SELECT CASE WHEN doc_id % 9 = 4 THEN 'read_error' ELSE 'good' END AS kind, count(*) AS n, CAST(sum(CASE WHEN doc_id % 9 = 4 THEN 0 ELSE octet_length(encode(coalesce(text, ''))) END) AS BIGINT) AS bytes
FROM documents GROUP BY 1""")
def unreadable_records(spark, d):
    """Records of whole documents written as JSON lines, every ninth one cut short: each of these is a read error, the others come back whole."""
    path = claim(spark, "json")
    record = F.to_json(F.struct(F.lit("qa").alias("db"), F.col("source").alias("path"), F.col("doc_id").cast("string").alias("stem"), F.coalesce("text", F.lit("")).alias("text")))
    docs(spark, d).select(F.when(F.col("doc_id") % 9 == 4, F.substring(record, F.lit(1), F.length(record) - 3)).otherwise(record).alias("value")).write.text(path)
    back = corpus.json_records(spark, path)
    errors = integrity.issues(back).where("check = 'read_error'").select(F.lit("read_error").alias("kind"), F.lit(0).alias("b"))
    good = corpus.quarantined(back)[0].select(F.lit("good").alias("kind"), F.octet_length("text").alias("b"))
    return errors.unionByName(good).groupBy("kind").agg(F.count("*").alias("n"), long(F.sum("b")).alias("bytes"))


@held("""WITH a AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS key, coalesce(text, '') AS t FROM documents
), w AS (SELECT key, CASE WHEN doc_id % 5 = 3 THEN 'b2' ELSE 'b1' END AS batch, CASE WHEN doc_id % 5 = 3 THEN t || ' again' ELSE t END AS tree, t, doc_id FROM a)
SELECT key, CASE WHEN doc_id % 11 = 7 OR NOT regexp_matches(tree, '\\S') THEN NULL ELSE batch END AS batch, CASE WHEN doc_id % 11 = 7 OR NOT regexp_matches(tree, '\\S') THEN NULL ELSE md5(tree) END AS tree_md5,
CASE WHEN doc_id % 11 = 7 THEN 'absent' WHEN NOT regexp_matches(tree, '\\S') THEN 'empty' END AS reason FROM w""")
def newest_answers(spark, d):
    """Whole documents landed in two batches: every fifth comes again, changed; another fifth comes again empty, so that its first
    answer stays; every eleventh never comes, and has a row with the reason."""
    path = claim(spark, "batches")
    i, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    came = docs(spark, d).where(i % 11 != 7)
    came.select(i.cast("string").alias("key"), text.alias("tree")).write.parquet(f"{path}/batch=b1")
    again = came.where((i % 5).isin(3, 4))
    again.select(i.cast("string").alias("key"), F.when(i % 5 == 3, F.concat(text, F.lit(" again"))).otherwise(" ").alias("tree")).write.parquet(f"{path}/batch=b2")
    wanted = docs(spark, d).select(i.cast("string").alias("key"))
    return corpus.newest(spark.read.parquet(path), wanted).select("key", "batch", F.md5(F.col("tree").cast("binary")).alias("tree_md5"), "reason")


@held("""WITH v AS (SELECT unnest(['after a run that failed', 'newest', 'older']) AS seen)
SELECT seen, lang, count(*) AS n, CAST(sum(octet_length(encode(coalesce(text, ''))) + CASE WHEN seen = 'newest' THEN 4 ELSE 0 END) AS BIGINT) AS bytes FROM documents, v GROUP BY seen, lang""")
def published_versions(spark, d):
    """Whole documents published twice, with a run in between that fails half-way: readers see the first version until the second is there, and can still name it then."""
    root = claim(spark, "versions")
    rows = docs(spark, d).select("lang", F.coalesce("text", F.lit("")).alias("text"))

    def seen(name: str, version: str | None = None) -> DataFrame:
        table = versions.read(spark, root, "documents", version)
        return table.groupBy("lang").agg(F.count("*").alias("n"), long(F.sum(F.octet_length("text"))).alias("bytes")).select(F.lit(name).alias("seen"), "lang", "n", "bytes")

    with versions.draft(spark, root) as at:
        rows.write.parquet(f"{at}/documents")
    first = versions.published(spark, root)[0]
    try:
        with versions.draft(spark, root) as at:
            rows.where("lang = 'en'").write.parquet(f"{at}/documents")
            raise InterruptedError
    except InterruptedError:
        between = seen("after a run that failed")
    with versions.draft(spark, root) as at:
        rows.withColumn("text", F.concat("text", F.lit(" new"))).write.parquet(f"{at}/documents")
    return between.unionByName(seen("newest")).unionByName(seen("older", first))


@held("""WITH l AS (SELECT page_id, url, unnest(range(len(m))) AS ord, unnest(m) AS link FROM (SELECT page_id, url, regexp_extract_all(html, 'href="(/[^"]*)"', 1) AS m FROM pages)
), r AS (SELECT *, substr(link, 2) AS rel, regexp_extract(url, '^[a-z]+://[^/?#]+') AS host, regexp_extract(url, '^[a-z]+://[^/?#]+[^?#]*/') AS folder FROM l)
SELECT page_id, CAST(ord AS BIGINT) AS ord, regexp_replace(host || link, '[?#]$', '') AS from_root,
CASE WHEN rel = '' THEN url WHEN regexp_matches(rel, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN rel ELSE regexp_replace(folder || rel, '[?#]$', '') END AS from_page, regexp_extract(url, '^[a-z]+:') || '/' || link AS from_scheme FROM r""")
def page_addresses(spark, d):
    """Every link of each whole page against the page's own address: as it stands, below the page's folder, and as a host of its own."""
    from loomtext.operators import pages

    found = pages.links(read(spark, d, "pages").select("page_id", "url", "html"), pattern='href="(/[^"]*)"')
    other = F.when(F.col("link").rlike("^/[^/?#]"), pages.absolute("url", F.concat(F.lit("/"), "link"))).otherwise(F.concat(F.regexp_extract("url", "^[a-z]+:", 0), F.lit("/"), "link"))
    return found.select("page_id", "ord", pages.absolute("url", "link").alias("from_root"), pages.absolute("url", F.substr("link", F.lit(2))).alias("from_page"), other.alias("from_scheme"))


@held("""SELECT CASE WHEN doc_id % 7 = 2 THEN 'broken' ELSE 'good' END AS kind, CASE WHEN doc_id % 7 = 2 THEN NULL ELSE 'L' || doc_id END AS law, CASE WHEN doc_id % 7 = 2 THEN NULL ELSE CAST(doc_id % 3 + 1 AS BIGINT) END AS articles,
CASE WHEN doc_id % 7 = 2 THEN NULL ELSE md5(' ' || replace(coalesce(text, ''), chr(10), ' ') || ' & <end> ') END AS text_md5 FROM documents""")
def xml_records(spark, d):
    """Laws written as XML, each with a whole document as its last article and one or two before it; every seventh doesn't close an article and comes back as it stands."""
    path = claim(spark, "xml")
    i, esc = F.col("doc_id"), lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    short = F.repeat(F.lit("<Article Num='0'><Sentence>x</Sentence></Article>"), (i % 3).cast("int"))
    whole = F.concat(F.lit("<Article Num='1'><Sentence> "), esc(F.translate(F.coalesce("text", F.lit("")), "\n", " ")), F.lit(" &amp; &lt;end&gt; </Sentence>"), F.when(i % 7 == 2, "").otherwise("</Article>"))
    docs(spark, d).select(F.concat(F.lit("<Law Id='L"), i.cast("string"), F.lit("'>"), short, whole, F.lit("</Law>")).alias("value")).write.text(path)
    back = corpus.xml_records(spark, path, "Law", "_Id string, Article array<struct<_Num: int, Sentence: string>>")
    good = F.col("broken").isNull()
    last = F.when(good, F.element_at("Article", -1)["Sentence"])
    return back.select(F.when(good, "good").otherwise("broken").alias("kind"), F.when(good, F.col("_Id")).alias("law"), F.when(good, long(F.size("Article"))).alias("articles"), F.md5(last.cast("binary")).alias("text_md5"))
