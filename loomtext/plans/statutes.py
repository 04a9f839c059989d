"""Statute trees and their tables, built from rows of the driver's tables, so that SQL can compute what they must give."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from loomtext.operators import integrity, tables, tree
from loomtext.plans.registry import docs, held, long, read

_CONV = "SELECT conv_id, turn, role, trim(text) AS text FROM conversations"


def _node(tag: str, children: Column, num: Column | None = None) -> Column:
    """A node as JSON; children: a column of JSON members joined by commas."""
    attr = F.lit("") if num is None else F.concat(F.lit('"Num":"'), num, F.lit('"'))
    return F.concat(F.lit(f'{{"tag":"{tag}","attr":{{'), attr, F.lit('},"children":['), children, F.lit("]}"))


def _text(c: Column) -> Column:
    """A text as a JSON member."""
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


def _join(*parts: Column) -> Column:
    return F.concat_ws(",", *parts)


def _laws(spark, d):
    """A law for each conversation: an article for each turn (a second paragraph on even turns, an item on turns divisible by 3),
    and one article in the supplementary provisions."""
    n, text = F.col("turn").cast("string"), F.trim("text")
    ruby = _node("Ruby", _join(_text(F.lit("R")), _node("Rt", _text(F.lit("reading")))))
    item = _node("Item", _join(_node("ItemTitle", _text(F.lit("i"))), _node("ItemSentence", _text(F.col("role"))), _node("Subitem1", _join(_node("Subitem1Title", _text(F.lit("a"))), _node("Subitem1Sentence", _text(F.lit("s")))))), F.lit("1"))
    one = _node("Paragraph", F.concat(_node("ParagraphSentence", _join(_text(text), ruby)), F.when(F.col("turn") % 3 == 0, F.concat(F.lit(","), item)).otherwise("")), F.lit("1"))
    two = _node("Paragraph", _node("ParagraphSentence", _text(n)), F.lit("2"))
    article = _node("Article", _join(_node("ArticleTitle", _text(F.col("role"))), one, F.when(F.col("turn") % 2 == 0, two)), n)
    rows = read(spark, d, "conversations").select("conv_id", "turn", article.alias("a"))
    laws = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "a"))), lambda x: x["a"]), ",").alias("all"))
    late = _node("SupplProvision", _node("Article", _node("ArticleTitle", _text(F.lit("late"))), F.lit("99")))
    return laws.select("conv_id", F.concat(F.lit('{"law_full_text":'), _node("Law", _join(_node("MainProvision", F.col("all")), late)), F.lit("}")).alias("tree"))


_BODY = """CASE WHEN turn % 2 = 0 THEN '[p1] 1 ' ELSE '[p1] ' END || text || 'R' || CASE WHEN turn % 3 = 0 THEN chr(10) || '[p1-i1] i ' || role || chr(10) || '[p1-i1-s1] a s' ELSE '' END || CASE WHEN turn % 2 = 0 THEN chr(10) || '[p2] 2 ' || turn ELSE '' END"""


@held(f"SELECT conv_id, CAST(turn AS VARCHAR) AS num, role AS title, {_BODY} AS body FROM ({_CONV})")
def articles_of_rows(spark, d):
    return tree.articles(_laws(spark, d))


@held(f"SELECT conv_id, CAST(turn AS VARCHAR) AS num, role AS title, {_BODY} AS body FROM ({_CONV}) WHERE turn BETWEEN 1 AND 6")
def articles_one_to_six(spark, d):
    return tree.articles(_laws(spark, d), only="[1-6]")


@held(f"""SELECT conv_id, CAST(turn AS VARCHAR) AS num, 'law: c' || conv_id || chr(10) || 'law_type: act / law_num: n' || CASE WHEN conv_id % 2 = 0 THEN ' / egov_id: E' || conv_id ELSE '' END || ' / as_of: 2024-01-01' || chr(10) || 'article: ' || turn || '-1 / title: ' || role || chr(10) || chr(10) || {_BODY} || chr(10) AS text,
'law: c' || conv_id || chr(10) || 'law_type: act / law_num: n' || CASE WHEN conv_id % 2 = 0 THEN ' / egov_id: E' || conv_id ELSE '' END || ' / as_of: 2024-01-01' || chr(10) || 'article: ' || turn || '_1 / title: ' || role || chr(10) || chr(10) || {_BODY} || chr(10) AS raw FROM ({_CONV})""")
def article_documents(spark, d):
    """Articles as text files, with the number in either form."""
    rows = tree.articles(_laws(spark, d))
    parts = (F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("act"), F.lit("n"), F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("E"), F.col("conv_id").cast("string"))).otherwise(""), F.lit("2024-01-01"), F.concat("num", F.lit("_1")), F.col("title"), F.col("body"))
    return rows.select("conv_id", "num", tree.document(*parts).alias("text"), tree.document(*parts, raw_num=True).alias("raw"))


def _xml(c: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


@held(f"SELECT conv_id, CAST(turn AS VARCHAR) AS num, 'cap ' || turn AS title, CASE WHEN turn % 2 = 0 THEN '[p1] 1 ' ELSE '[p1] ' END || text || ' base tail' || CASE WHEN turn % 2 = 0 THEN chr(10) || '[p2] 2 ' || role ELSE '' END AS body FROM ({_CONV})")
def xml_articles_of_rows(spark, d):
    """The same from XML: captions before titles, ruby readings left out, what follows them kept."""
    n = F.col("turn").cast("string")
    article = F.concat(F.lit("<Article Num='"), n, F.lit("'><ArticleCaption>（cap "), n, F.lit("）</ArticleCaption><ArticleTitle>t</ArticleTitle><Paragraph Num='1'><ParagraphSentence>"), _xml(F.trim("text")), F.lit(" <Ruby>base<Rt>read</Rt></Ruby> tail</ParagraphSentence></Paragraph>"), F.when(F.col("turn") % 2 == 0, F.concat(F.lit("<Paragraph Num='2'><ParagraphSentence>"), _xml(F.col("role")), F.lit("</ParagraphSentence></Paragraph>"))).otherwise(""), F.lit("</Article>"))
    rows = read(spark, d, "conversations").select("conv_id", "turn", article.alias("a"))
    laws = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "a"))), lambda x: x["a"]), "").alias("all"))
    return tree.articles(laws.select("conv_id", F.concat(F.lit("<Law><MainProvision>"), F.col("all"), F.lit("</MainProvision><SupplProvision><Article Num='99'/></SupplProvision></Law>")).alias("tree")))


@held("""WITH t AS (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE turn % 2 = 0) AS two, count(*) FILTER (WHERE turn % 3 = 0) AS items FROM conversations GROUP BY conv_id
), k AS (
  SELECT conv_id, unnest([('Law', 1, 1, 0), ('MainProvision', 1, 2, 0), ('SupplProvision', 1, 2, 1), ('Article', n + 1, 3, 1), ('ArticleTitle', n + 1, 4, 1), ('Paragraph', n + two, 4, 0), ('ParagraphSentence', n + two, 5, 0), ('Ruby', n, 6, 0), ('Rt', n, 7, 0),
    ('Item', items, 5, 0), ('ItemTitle', items, 6, 0), ('ItemSentence', items, 6, 0), ('Subitem1', items, 6, 0), ('Subitem1Title', items, 7, 0), ('Subitem1Sentence', items, 7, 0)]) AS x FROM t)
SELECT conv_id, x[1] AS tag, CAST(x[2] AS BIGINT) AS nodes, CAST(x[3] AS BIGINT) AS depth, CAST(x[4] AS BIGINT) AS in_supplement FROM k WHERE x[2] > 0""")
def tree_nodes_of_rows(spark, d):
    """How many nodes each law has of each tag, how deep they lie, and how many in the supplementary provisions."""
    got = tree.nodes(_laws(spark, d), "conv_id", "tree")
    return got.groupBy("conv_id", "tag").agg(F.count("*").alias("nodes"), long(F.max(F.size("path"))).alias("depth"), F.count_if("in_supplement").alias("in_supplement"))


# appendices: a law for each region, a table row for each of its nations


def _appendices(spark, d):
    cell = lambda c, span=None: F.concat(F.lit('{"tag":"TableColumn","attr":{' + (f'"rowspan":"{span}"' if span else "") + '},"children":[{"tag":"Sentence","children":['), _text(c), F.lit("]}]}"))
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    n = read(spark, d, "nation").withColumn("i", F.row_number().over(w) - 1)
    key = F.col("n_nationkey").cast("string")
    row = _node("TableRow", F.when(F.col("i") % 2 == 0, _join(cell(F.col("n_name"), 2), cell(key))).otherwise(_join(cell(key), cell(F.lit("more")))))
    item = _node("Item", _join(_node("ItemTitle", _text(key)), _node("ItemSentence", _text(F.col("n_name"))), _node("Subitem1", _join(_node("Subitem1Title", _text(F.lit("s"))), _node("Subitem1Sentence", _text(F.lit("below")))))))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", c.alias("x")))), lambda x: x["x"]), ",")
    got = n.groupBy("n_regionkey").agg(joined(row).alias("rows"), joined(item).alias("items"))
    title = lambda c: _node("AppdxTableTitle", _text(c))
    table = _node("TableStruct", _join(_node("TableStructTitle", _text(F.lit("T"))), _node("Table", F.col("rows"))))
    first = _node("AppdxTable", _join(title(F.lit("first")), _node("RelatedArticleNum", _text(F.lit("(art. 1)"))), table))
    empty = _node("AppdxTable", title(F.lit("empty")))
    last = _node("AppdxTable", _join(title(F.lit("last")), F.col("items")))
    late = _node("SupplProvision", _node("AppdxTable", _join(title(F.lit("late")), table)))
    article = lambda num: _node("Article", _node("Paragraph", table, F.lit("1")), F.lit(num))
    law = _node("Law", _join(_node("MainProvision", _join(article("1"), _node("Article", _text(F.lit("none")), F.lit("2")))), first, empty, last, late))
    return got.select("n_regionkey", law.alias("tree"))


_GRID = """WITH n AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i FROM nation
), g AS (SELECT *, lag(n_name) OVER (PARTITION BY n_regionkey ORDER BY i) AS above FROM n
)"""
_TABLE = """string_agg(CASE WHEN i % 2 = 0 THEN '| ' || n_name || ' | ' || n_nationkey || ' | |' ELSE '| ' || above || ' | ' || n_nationkey || ' | more |' END || CASE WHEN i = 0 THEN chr(10) || '| --- | --- | --- |' ELSE '' END, chr(10) ORDER BY i)"""


@held(f"""{_GRID}, t AS (SELECT n_regionkey, replace({_TABLE}, ' | |', ' |  |') AS t, string_agg(n_nationkey || ' ' || n_name || chr(10) || '  s below', chr(10) || chr(10) ORDER BY i) AS l FROM g GROUP BY n_regionkey)
SELECT n_regionkey, CAST(1 AS BIGINT) AS idx, 'beppyo-1' AS name, 'first' AS title, '(art. 1)' || chr(10) || chr(10) || '### T' || chr(10) || t AS body FROM t
UNION ALL SELECT n_regionkey, 3, 'beppyo-3', 'last', l FROM t""")
def appendices_of_rows(spark, d):
    return tables.appendices(_appendices(spark, d)).withColumn("idx", long("idx"))


@held(f"""{_GRID}, t AS (SELECT n_regionkey, replace({_TABLE}, ' | |', ' |  |') AS t FROM g GROUP BY n_regionkey)
SELECT n_regionkey, CAST(unnest([1, 4]) AS BIGINT) AS idx, 'beppyo-' || unnest([1, 4]) AS name, unnest(['first', 'late']) AS title, '### T' || chr(10) || t AS body FROM t""")
def appendix_tables_only(spark, d):
    """The tables alone, those of the supplementary provisions too."""
    return tables.appendices(_appendices(spark, d), drop_supplement=False, tables_only=True).withColumn("idx", long("idx"))


@held(f"""{_GRID}, t AS (SELECT n_regionkey, string_agg(CASE WHEN i % 2 = 0 THEN n_name || ',' || n_nationkey ELSE above || ',' || n_nationkey END, ';' ORDER BY i) AS f,
  string_agg(CASE WHEN i % 2 = 0 THEN n_name || ',' || n_nationkey ELSE above || ',' || n_nationkey || ',more' END, ';' ORDER BY i) AS g FROM g GROUP BY n_regionkey)
SELECT n_regionkey, f AS fixed, g AS growing, CAST(0 AS BIGINT) AS in_second, CAST(NULL AS BIGINT) AS in_third FROM t""")
def article_tables(spark, d):
    """The grids of an article's tables, in both ways of rowspans; an article without tables has none, one that isn't there null."""
    laws = _appendices(spark, d)
    flat = lambda c: F.array_join(F.transform(F.element_at(c, 1), lambda r: F.array_join(r, ",")), ";")
    rows = laws.select("n_regionkey", tables.article_grids("tree", F.lit("1")).alias("f"), tables.article_grids("tree", F.lit("1"), fixed=False, keep_empty=False).alias("g"), tables.article_grids("tree", F.lit("2")).alias("second"), tables.article_grids("tree", F.lit("3")).alias("third"))
    size = lambda c: F.when(F.col(c).isNotNull(), long(F.size(c)))
    return rows.select("n_regionkey", flat(F.col("f")).alias("fixed"), flat(F.col("g")).alias("growing"), size("second").alias("in_second"), size("third").alias("in_third"))


# tables of laws found once and joined to the documents that name them


def _tabled(spark, d):
    """A law for each conversation: an article for each turn, every second one with a table of one row for each of its first words."""
    cell = lambda c: F.concat(F.lit('{"tag":"TableColumn","attr":{},"children":[{"tag":"Sentence","children":['), _text(c), F.lit("]}]}"))
    n = F.col("turn").cast("string")
    rows = _join(_node("TableRow", _join(cell(F.col("role")), cell(n))), _node("TableRow", _join(cell(F.lit("w")), cell(F.length("text").cast("string")))))
    table = _node("TableStruct", _node("Table", rows))
    article = _node("Article", _join(_node("ArticleTitle", _text(F.col("role"))), F.when(F.col("turn") % 2 == 0, _node("Paragraph", table, F.lit("1")))), n)
    made = read(spark, d, "conversations").select("conv_id", F.struct("turn", article.alias("a")).alias("x")).groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["a"]), ",").alias("all"))
    return made.where("conv_id % 7 <> 3").select("conv_id", _node("Law", _node("MainProvision", F.col("all"))).alias("tree"))


def _citing(spark, d):
    """A document for each turn, which names its law and article (none where conv_id + turn is a multiple of 11, one that isn't there of 13)."""
    k = F.col("conv_id") + F.col("turn")
    article = F.when(k % 11 == 0, "").when(k % 13 == 0, "999").otherwise(F.col("turn").cast("string"))
    body = F.concat(F.when(k % 17 == 0, f"{tables.MARKER}\n").otherwise(""), F.lit("law: x\n\n[p1] "), F.when(F.col("role") == "user", "左の表").otherwise("none"), F.lit("\n[p2] "), F.trim("text"))
    return read(spark, d, "conversations").select("conv_id", "turn", article.alias("article"), body.alias("text"))


_CITED = """WITH c AS (SELECT conv_id, turn, role, length(text) AS n, conv_id + turn AS k FROM conversations
), a AS (SELECT *, CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN '999' ELSE CAST(turn AS VARCHAR) END AS article FROM c
), g AS (SELECT a.*, a.conv_id % 7 <> 3 AND t.turn IS NOT NULL AS there, t.turn % 2 = 0 AS has, t.role AS r, t.n AS m, t.turn AS tt FROM a LEFT JOIN c t ON t.conv_id = a.conv_id AND CAST(t.turn AS VARCHAR) = a.article)"""


@held(f"{_CITED} SELECT conv_id, turn, article, CASE WHEN there THEN CASE WHEN has THEN r || ',' || tt || ';w,' || m ELSE '' END END AS grid FROM g")
def article_tables_joined(spark, d):
    """The tables that each document's article has, from one parse of each law."""
    got = tables.with_grids(_citing(spark, d), _tabled(spark, d), "conv_id")
    flat = F.array_join(F.transform("grids", lambda g: F.array_join(F.transform(g, lambda r: F.array_join(r, ",")), ";")), "/")
    return got.select("conv_id", "turn", "article", flat.alias("grid"))


@held(f"""{_CITED} SELECT CASE WHEN k % 17 = 0 THEN 'already_done' WHEN article = '' THEN 'error_no_article' WHEN conv_id % 7 = 3 THEN 'error_api' WHEN NOT there OR NOT has THEN 'error_no_tables'
  WHEN role = 'user' THEN 'inserted' ELSE 'no_points' END AS status, count(*) AS n FROM g GROUP BY 1""")
def insert_statuses_joined(spark, d):
    """What inserting gives for documents whose tables come from that join: how many of each status."""
    laws = _tabled(spark, d)
    rows = tables.with_grids(_citing(spark, d), laws, "conv_id").join(laws.select("conv_id", F.lit("s").alias("source")), "conv_id", "left")
    status = tables.process_status(F.col("article"), F.lit("v2"), F.col("source"), tables.rendered("grids"), F.col("text"))
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@held(f"""{_CITED} SELECT conv_id, turn, CASE WHEN k % 17 <> 0 AND article <> '' AND there AND has AND role = 'user' THEN 'law: x' || chr(10) || chr(10) || '{tables.MARKER}' || chr(10) || '[p1] 左の表' || chr(10) || '| ' || r || ' | ' || tt || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| w | ' || m || ' |' || chr(10) || chr(10)
  ELSE CASE WHEN k % 17 = 0 THEN '{tables.MARKER}' || chr(10) ELSE '' END || 'law: x' || chr(10) || chr(10) || '[p1] ' || CASE WHEN role = 'user' THEN '左の表' ELSE 'none' END || chr(10) END || '[p2] ' || trim((SELECT text FROM conversations t WHERE t.conv_id = g.conv_id AND t.turn = g.turn)) AS text FROM g""")
def insert_joined(spark, d):
    """The texts with their tables in place, from the same join."""
    rows = tables.with_grids(_citing(spark, d), _tabled(spark, d), "conv_id")
    return rows.select("conv_id", "turn", tables.insert("text", tables.rendered("grids")).alias("text"))


# the status of table insertion, and its histogram


_STATUS = """CASE doc_id % 8 WHEN 0 THEN 'already_done' WHEN 1 THEN 'error_no_article' WHEN 2 THEN 'error_no_source' WHEN 3 THEN 'error_api' WHEN 4 THEN 'error_no_tables' WHEN 5 THEN 'no_points' ELSE 'inserted' END"""


def _status(spark, d):
    k = F.col("doc_id") % 8
    text = F.concat(F.when(k == 0, f"{tables.MARKER}\n").otherwise(""), F.lit("law: x\n\n[p1] "), F.when(k == 5, "none").otherwise("左の表"), F.lit("\n[p2] "), F.coalesce("text", F.lit("")))
    grids = F.when(k == 4, F.array().cast("array<string>")).otherwise(F.array(F.lit("\n| t |\n")))
    rows = docs(spark, d).select("doc_id", text.alias("text"), F.when(k == 1, "").otherwise("1").alias("article"), F.when(k == 2, "unknown").otherwise("v2").alias("mode"), F.when(k != 3, "s").alias("source"), grids.alias("grids"))
    return rows.withColumn("status", tables.process_status(*(F.col(c) for c in ("article", "mode", "source", "grids", "text"))))


@held(f"SELECT doc_id, {_STATUS} AS status FROM documents")
def insert_statuses(spark, d):
    return _status(spark, d).select("doc_id", "status")


@held(f"SELECT {_STATUS} AS status, count(*) AS n FROM documents GROUP BY 1")
def insert_histogram(spark, d):
    return _status(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@held("SELECT doc_id, 'law: x' || chr(10) || chr(10) || '<!--TABLE_INSERTED-->' || chr(10) || '[p1] 左の表' || chr(10) || '| 1 |' || chr(10) || chr(10) || '[p2-i1] 次の表' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '| 2 |' || chr(10) ELSE '' END || chr(10) || '[p3] end' AS text FROM documents")
def insert_by_ordinal(spark, d):
    """The k-th table goes to the k-th place; places and tables too many stay as they are."""
    made = F.when(F.col("doc_id") % 2 == 0, F.array(*(F.lit(f"\n| {i} |\n") for i in (1, 2, 3)))).otherwise(F.array(F.lit("\n| 1 |\n")))
    return docs(spark, d).select("doc_id", tables.insert(F.lit("law: x\n\n[p1] 左の表\n[p2-i1] 次の表\n[p3] end"), made).alias("text"))


# integrity: pass or fail


@held("""WITH t AS (SELECT octet_length(encode(coalesce(text, ''))) // 3 AS tok, text, doc_id FROM documents
), c AS (SELECT count(*) FILTER (WHERE tok > 9999) + count(DISTINCT CASE WHEN doc_id % 10 = 3 THEN doc_id // 40 END) AS critical, count(*) FILTER (WHERE doc_id % 10 = 4) + count(*) FILTER (WHERE doc_id % 10 <> 4 AND tok < 50 AND regexp_matches(coalesce(text, ''), '\\S')) AS warnings
  FROM (SELECT * FROM t WHERE doc_id % 10 <> 3 AND doc_id % 10 <> 4 UNION ALL SELECT 60 AS tok, 'x' AS text, doc_id FROM t WHERE doc_id % 10 = 3 UNION ALL SELECT 0, NULL, doc_id FROM t WHERE doc_id % 10 = 4))
SELECT critical = 0 AS passed, critical, warnings FROM c""")
def integrity_passed(spark, d):
    """Whether any check is critical: one document in ten is a chunk whose base is lost, with up to three others of it; one can't be read."""
    k = F.col("doc_id") % 10
    chunk = F.concat(F.lit("--- split 2/2 of x.txt ---\n"), F.repeat(F.lit("y"), F.lit(180)))
    text = F.when(k == 3, chunk).when(k == 4, F.lit(None).cast("string")).otherwise(F.col("text"))
    lost = F.concat(F.lit("lost"), F.floor(F.col("doc_id") / 40).cast("string"), F.lit("_"), (F.col("doc_id") % 40 + 2).cast("string"))
    stem = F.when(k == 3, lost).otherwise(F.col("doc_id").cast("string"))
    return integrity.passed(integrity.issues(docs(spark, d).select(F.lit("beppyo").alias("db"), F.lit("p").alias("path"), stem.alias("stem"), text.alias("text"))))


@held("SELECT CASE doc_id % 4 WHEN 0 THEN 'double_split' WHEN 1 THEN 'annotation_mismatch' WHEN 2 THEN 'annotation_mismatch' ELSE 'empty_files' END AS \"check\", CASE doc_id % 4 WHEN 0 THEN '2_2' WHEN 1 THEN 'nameless' WHEN 2 THEN 'unnoted' ELSE 'blank' END AS kind, count(*) AS n FROM documents GROUP BY 1, 2")
def integrity_rare(spark, d):
    """Checks that stored corpora seldom fail: a chunk of a chunk, a note without a number in the name, chunks of a base without a note, an empty file."""
    i, k = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    note = F.concat(F.lit("--- split 2/2 of x.txt ---\n"), F.repeat(F.lit("y"), F.lit(180)))
    long_ = F.repeat(F.lit("z"), F.lit(180))
    rows = docs(spark, d).select(k.alias("k"), F.explode(F.when(k == 0, F.array(F.struct(F.concat(i, F.lit("_2_2")), note), F.struct(F.concat(i, F.lit("_2")), F.concat(long_, F.lit("\n--- split 1/2 → next: x.txt ---\n"))))).when(k == 1, F.array(F.struct(F.concat(F.lit("n"), i, F.lit("x")), note))).when(k == 2, F.array(F.struct(F.concat(i, F.lit("_2")), note), F.struct(i, long_))).otherwise(F.array(F.struct(i, F.lit(" \n\t"))))).alias("f"))
    found = integrity.issues(rows.select(F.lit("beppyo").alias("db"), F.lit("p").alias("path"), F.col("f").getField("col1").alias("stem"), F.col("f").getField("col2").alias("text")))
    kind = F.when(F.col("check") == "double_split", "2_2").when(F.startswith("detail", F.lit("note but")), "nameless").when(F.startswith("detail", F.lit("chunks but")), "unnoted").when(F.col("check") == "empty_files", "blank").otherwise("other")
    return found.groupBy("check", kind.alias("kind")).agg(F.count("*").alias("n"))
