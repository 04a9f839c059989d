"""Headers in every dialect: splitting, trimming, renaming; texts are documents with a header in front."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import headers, routing
from loomtext.plans.registry import BODY, ID, Text, choose, docs, held

SITE = "https://site.example"

LAW = Text("law: L (c)\nlaw_type: act / law_num: 昭和", ID, "年", choose(("doc_id % 2 = 0", " / egov_id:  / as_of: x"), other=" / egov_id: 3AC / as_of: x"), "\narticle: ", ID, choose(("doc_id % 3 = 0", f"\nurl: {SITE}/a"), other="\nurl: http://other.example/"), "\n\n", BODY, choose(("doc_id % 5 = 0", f"\nurl: {SITE}/end")))
GUIDE = Text("doc: G (c)\nsection: ", ID, f"\nurl: {SITE}/g\nitem: ", ID, "\n\n", BODY, choose(("doc_id % 4 = 0", "\nsection: late\nsectional")))
TSUTATSU = Text("doc: T\nitem: ", ID, " / id: X", ID, " / title: t\nsnapshot: 2024\nurl: ", choose(("doc_id % 2 = 0", SITE), other="http://o"), "\n\nitem: in the body / id: Y\n", BODY)
YAML = Text("---\nid: ", ID, '\nurl: u\nprev: a\nnext: b\nsection_id: s\npage_start: 1\npage_end: 2\npara_count: 3\nsection_title: t\npid: ', choose(("doc_id % 5 = 0", '"all"'), ("doc_id % 5 = 1", "all"), ("doc_id % 5 = 2", "'all' "), ("doc_id % 5 = 3", '"all of it"'), other='"p1"'), '\npids: all\n---\npid: all\nurl: stays\n', BODY, "\n---\nprev: stays too")
COURT = Text("---\nid: ", ID, "\nsummary_status: s\nsource:\n  court: c\n   deeper: c\n\tdate: tabbed lines stay\n  after: and what follows them\nsource: again\n one: space\nlaws: []\n laws: [] \nlaws: [x]\nsummary_source: q\n", choose(("doc_id % 2 = 0", "source: one line\n")), "title: t\n  more: kept\n---\nsource:\n  kept: y\n", BODY)
QA = Text(choose(("doc_id % 11 = 3", "---\n")), "doc_title: d", ID, "\nq: ", ID, "\nsource_kind: k\n", choose(("doc_id % 7 <> 0", "---\n")), choose(("doc_id % 4 = 0", "法令等\nx\ny\nz\n"), ("doc_id % 4 = 1", "国税庁等について\na\nb\nc\nd\n"), ("doc_id % 4 = 2", "税の情報\n")), BODY)


def _rows(spark, d, made: Column):
    return docs(spark, d).select("doc_id", made.alias("text"))


def _kept(text: Text, *starts: str) -> str:
    """SQL of the text without lines that start so."""
    keep = " AND ".join(f"NOT starts_with(x, '{s}')" for s in starts)
    return f"array_to_string(list_filter(string_split({text.sql}, chr(10)), lambda x: {keep}), chr(10))"


@held(f"SELECT doc_id, replace({_kept(LAW, f'url: {SITE}')}, ' / egov_id:  /', ' /') AS text FROM documents")
def trim_law(spark, d):
    return _rows(spark, d, headers.trim_law(LAW.column, SITE))


@held(f"SELECT doc_id, {_kept(GUIDE, f'url: {SITE}', 'section: ')} AS text FROM documents")
def trim_guide(spark, d):
    return _rows(spark, d, headers.trim_guide(GUIDE.column, SITE))


@held(f"""WITH l AS (SELECT doc_id, unnest(string_split({TSUTATSU.sql}, chr(10))) AS line, unnest(range(len(string_split({TSUTATSU.sql}, chr(10))))) AS k FROM documents
), m AS (SELECT doc_id, k, CASE WHEN starts_with(line, 'item: ') THEN regexp_replace(line, ' / id: [^ /]+', '', 'g') ELSE line END AS line FROM l WHERE NOT starts_with(line, 'url: {SITE}') AND NOT starts_with(line, 'snapshot: '))
SELECT doc_id, string_agg(line, chr(10) ORDER BY k) AS text FROM m GROUP BY doc_id""")
def trim_tsutatsu(spark, d):
    return _rows(spark, d, headers.trim_tsutatsu(TSUTATSU.column, SITE))


def _yaml(text: Text, goes: str) -> str:
    """SQL: lines between the first two --- lines for which `goes` holds are dropped. It may use line, name and head, the name of the last line above that isn't indented."""
    lines = f"string_split({text.sql}, chr(10))"
    return f"""WITH l AS (SELECT doc_id, unnest({lines}) AS line, unnest(range(len({lines}))) AS k FROM documents
), m AS (SELECT *, trim(line) = '---' AS mark, sum(CASE WHEN trim(line) = '---' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS marks FROM l
), n AS (SELECT *, marks = 1 AND NOT mark AS inside, regexp_extract(line, '^(\\w[\\w_]*):', 1) AS name, starts_with(line, '  ') AS indented FROM m
), g AS (SELECT *, max(CASE WHEN NOT indented THEN k END) OVER (PARTITION BY doc_id ORDER BY k) AS above FROM n
), h AS (SELECT g.*, n.name AS head FROM g LEFT JOIN n ON n.doc_id = g.doc_id AND n.k = g.above)
SELECT doc_id, string_agg(line, chr(10) ORDER BY k) AS text FROM h WHERE NOT (inside AND ({goes})) GROUP BY doc_id"""


def _names(fields) -> str:
    return "name IN (" + ", ".join(f"'{f}'" for f in fields) + ")"


@held(_yaml(YAML, _names(headers.TREATY_FIELDS) + r''' OR (name = 'pid' AND trim(trim(trim(substr(line, 5)), '"'), chr(39)) = 'all')'''))
def trim_treaty(spark, d):
    return _rows(spark, d, headers.trim_treaty(YAML.column))


@held(_yaml(YAML, _names(headers.PAPER_FIELDS)))
def trim_paper(spark, d):
    return _rows(spark, d, headers.trim_paper(YAML.column))


@held(_yaml(YAML, _names(("url", "para_count"))))
def trim_yaml_fields(spark, d):
    return _rows(spark, d, headers.trim_yaml(YAML.column, ("url", "para_count")))


@held(_yaml(COURT, _names(("summary_status", "summary_source")) + " OR trim(line) = 'laws: []' OR name = 'source' OR (indented AND head = 'source')"))
def trim_hanketsu(spark, d):
    return _rows(spark, d, headers.trim_hanketsu(COURT.column))


_QA = f"""WITH l AS (SELECT doc_id, {QA.sql} AS t, string_split({QA.sql}, chr(10)) AS w FROM documents
), e AS (SELECT *, coalesce(list_min(list_filter(range(1, len(w) + 1), lambda i: trim(w[i]) = '---')), 0) AS n FROM l
), b AS (SELECT *, w[n + 1:] AS body FROM e
), s AS (SELECT *, CASE WHEN starts_with(body[1], '法令等') OR starts_with(body[1], '税の情報') THEN 4 WHEN starts_with(body[1], '国税庁等について') THEN 5 ELSE 0 END AS skip FROM b)
SELECT doc_id, CASE WHEN n = 0 THEN t ELSE array_to_string(list_concat(list_filter(w[1:n], lambda x: NOT starts_with(x, 'doc_title: ') AND NOT starts_with(x, 'source_kind: ')), CASE WHEN len(body) > skip THEN body[skip + 1:] ELSE body END), chr(10)) END AS text FROM s"""


@held(_QA)
def trim_qa(spark, d):
    return _rows(spark, d, headers.trim_qa(QA.column))


@held(f"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace({_kept(LAW, f'url: {SITE}')}, ' / egov_id:  /', ' /') WHEN 1 THEN {_kept(LAW, f'url: {SITE}', 'section: ')} ELSE {LAW.sql} END AS text FROM documents")
def trim_dispatch(spark, d):
    """The trim of each row's db, and none for a db without one."""
    rows = docs(spark, d).select("doc_id", F.element_at(F.array(F.lit("law"), F.lit("guide"), F.lit("beppyo")), (F.col("doc_id") % 3 + 1).cast("int")).alias("db"), LAW.column.alias("t"))
    return rows.select("doc_id", headers.trim("db", "t", SITE).alias("text"))


def _split(text: Text, stop: str, first: str = "true") -> str:
    """SQL of header and body: the header ends with the first line from the second on for which `stop` holds."""
    return f"""WITH l AS (SELECT doc_id, {text.sql} AS t, string_split({text.sql}, chr(10)) AS w FROM documents
), e AS (SELECT *, CASE WHEN {first} THEN coalesce(list_min(list_filter(range(2, len(w) + 1), lambda i: {stop})), 0) ELSE 0 END AS n FROM l)
SELECT doc_id, CASE WHEN n = 0 THEN '' ELSE array_to_string(w[1:n], chr(10)) || CASE WHEN n < len(w) THEN chr(10) ELSE '' END END AS header, CASE WHEN n = 0 THEN t ELSE array_to_string(w[n + 1:], chr(10)) END AS body FROM e"""


def _headed(spark, d, text: Text, dialect: str):
    return docs(spark, d).select("doc_id", headers.split_header(text.column, dialect).alias("p")).select("doc_id", "p.header", "p.body")


@held(_split(LAW, "trim(w[i]) = ''"))
def header_blank(spark, d):
    return _headed(spark, d, LAW, "blank")


@held(_split(QA, "trim(w[i]) = '---'"))
def header_dashes(spark, d):
    return _headed(spark, d, QA, "dashes")


@held(_split(YAML, "trim(w[i]) = '---'", "w[1] = '---'"))
def header_yaml(spark, d):
    return _headed(spark, d, YAML, "yaml_or_blank")


@held("SELECT doc_id, doc_id % 50 || '_' || doc_id % 7 AS api, doc_id % 50 || '-' || doc_id % 7 AS article, doc_id || '-2_1-4' AS item FROM documents")
def article_numbers(spark, d):
    raw = F.concat((F.col("doc_id") % 50).cast("string"), F.lit("-"), (F.col("doc_id") % 7).cast("string"))
    item = F.concat(F.col("doc_id").cast("string"), F.lit("の2・1−4"))
    return docs(spark, d).select("doc_id", X.to_api_num(raw).alias("api"), X.from_api_num(X.to_api_num(raw)).alias("article"), X.item_id(item).alias("item"))


@held("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents
), f AS (SELECT * FROM r WHERE k <= 3)
SELECT source, 'source,kind,shards,docs' AS columns, string_agg('shards/s-' || doc_id || ':' || k, ',' ORDER BY k) AS shards, 'file,count' AS shard_fields,
  string_agg(doc_id || '@' || CASE WHEN k = 1 THEN '-' ELSE 'http://new.example/' || doc_id END, ',' ORDER BY k) AS docs, 'id,url' AS doc_fields FROM f GROUP BY source""")
def index_cleanup(spark, d):
    """A shard index of each source, without addresses of its old site."""
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy("doc_id")
    rows = docs(spark, d).select("source", "doc_id", F.row_number().over(w).alias("k")).where("k <= 3")
    i = F.col("doc_id").cast("string")
    shard = F.struct("k", F.concat(F.lit("data/shards/s-"), i).alias("file"), F.lit("u").alias("url"), F.lit("e").alias("enhanced_url"), F.col("k").cast("string").alias("count"))
    doc = F.struct("k", i.alias("id"), F.concat(F.when(F.col("k") == 1, "http://old.example/").otherwise("http://new.example/"), i).alias("url"), F.lit("x").alias("resolve_lite_url"))
    named = lambda c, names: F.transform(F.sort_array(F.collect_list(c)), lambda x: F.struct(*(x[n].alias(n) for n in names)))
    ix = rows.groupBy("source").agg(F.lit("http://old.example").alias("base_url"), F.lit("index").alias("kind"), F.lit("e").alias("enhanced_base"), named(shard, ("file", "url", "enhanced_url", "count")).alias("shards"), named(doc, ("id", "url", "resolve_lite_url")).alias("docs"))
    got = routing.clean_index(ix, "old.example")
    fields = lambda c: F.lit(",".join(f.name for f in got.schema[c].dataType.elementType.fields))
    return got.select(
        "source",
        F.lit(",".join(got.columns)).alias("columns"),
        F.array_join(F.transform("shards", lambda s: F.concat(s["file"], F.lit(":"), s["count"])), ",").alias("shards"),
        fields("shards").alias("shard_fields"),
        F.array_join(F.transform("docs", lambda x: F.concat(x["id"], F.lit("@"), F.coalesce(x["url"], F.lit("-")))), ",").alias("docs"),
        fields("docs").alias("doc_fields"),
    )
