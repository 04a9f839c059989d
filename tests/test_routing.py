"""Routing indexes, their rendering, and the sources behind table insertion."""

from pyspark.sql import functions as F

from loomtext.operators import pages, routing, tables, tree
from loomtext.sources import corpus


def test_lean_index_and_section(spark):
    rows = [(i, f"code{i % 2}", f"item{i}", "減価償却 資産") for i in range(6)]
    df = spark.createDataFrame(rows, "ord long, doc_code string, item_id string, item_title string")
    profile = routing.PROFILES["qa"]
    packed = routing.lean(df, profile, cap=30)
    assert [r["doc_code"] for r in packed.orderBy("shard", "doc_code", "ord").collect()] == ["code0"] * 3 + ["code1"] * 3
    ix = routing.index(packed, profile).orderBy("shard").collect()
    assert sum(r["count"] for r in ix) == 6 and ix[0]["topics"] == ["減価償却", "資産"] and ix[0]["doc_codes"] == ["code0"]
    text = routing.section(routing.index(packed, profile), ["intro"], with_codes=True).first()["section"]
    assert text.startswith(f"{routing.MARKER}\n\nintro\n\nshard-00.txt (") and "  Topics: 減価償却, 資産" in text


def test_countries_and_ranges(spark):
    df = spark.createDataFrame([(i, f"国{i}--x", "p", "租税条約", "c") for i in range(7)], "ord long, id string, pid string, snippet string, core string")
    ix = routing.index(routing.lean(df, routing.PROFILES["treaty"]), routing.PROFILES["treaty"])
    r = ix.first()
    assert r["id_range"] == "国0--x〜国6--x" and len(r["countries"]) == 7
    assert "国0, 国1, 国2, 国3, 国4 他2か国" in routing.section_lines(ix, with_countries=True).first()["line"]
    kept = spark.createDataFrame([("shard-00.txt", 1, "a", "法人", "", ""), ("shard-00.txt", 2, "b", "法人", "", "")], "shard string, ord long, id string, title string, topics string, keywords string")
    assert routing.ranged(kept).first().asDict() == {"shard": "shard-00.txt", "count": 2, "id_range": "a〜b", "topics": ["法人"]}


def test_embed(spark):
    df = spark.createDataFrame([("g", 2, "b", "2020", None), ("g", 1, "a", "2019", "x")], "g string, ord int, id string, date_iso string, tax_types string")
    r = routing.embed(df, ["g"]).first()
    assert (r["text"], r["count"]) == ("a\t2019\tx\nb\t2020\t", 2)


def test_resolution_order(spark):
    ids = spark.createDataFrame([("d", "ID")], "path string, id string")
    nums = spark.createDataFrame([("d", "NUM"), ("e", "NUM2")], "path string, num string")
    df = spark.createDataFrame([("d", "E", "L"), ("d", "", "L"), ("e", "", "L"), ("f", "", "L"), ("f", None, None)], "path string, egov_id string, law_num string")
    got = [(r["source"], r["mode"]) for r in corpus.resolve(df, ids, nums).collect()]
    assert sorted(got) == sorted([("E", "v2"), ("ID", "v2"), ("NUM2", "v1"), ("L", "v1"), ("", "unknown")])


def test_tables_of_an_article(spark):
    law = "<Law><Article Num='3'><TableStruct><Table><TableRow><TableColumn rowspan='2'><Sentence>A</Sentence><Sentence>B</Sentence></TableColumn><TableColumn><Sentence>C</Sentence></TableColumn></TableRow><TableRow><TableColumn><Sentence>D</Sentence></TableColumn></TableRow></Table></TableStruct></Article></Law>"
    df = spark.createDataFrame([(law, "3"), (law, "4"), (None, "3")], "tree string, num string")
    got = df.select(tables.article_grids("tree", "num").alias("g")).collect()
    assert got[0]["g"] == [[["A B", "C"], ["A B", "D"]]] and got[1]["g"] is None and got[2]["g"] is None
    assert df.select(tables.process_status(F.col("num"), F.lit("v1"), F.col("tree"), F.array(F.lit("x")), F.lit("[p1] 次の表")).alias("s")).collect()[2]["s"] == "error_api"


def test_document_text(spark):
    cols = [F.lit(x) for x in ("法 (code)", "act", "昭和1", "", "2024-01-01", "66_6", "題", "[p1] x")]
    assert spark.range(1).select(tree.document(*cols).alias("x")).first()["x"] == "law: 法 (code)\nlaw_type: act / law_num: 昭和1 / as_of: 2024-01-01\narticle: 66-6 / title: 題\n\n[p1] x\n"


def test_links_resolve(spark):
    df = spark.createDataFrame([("https://h/a/b.htm", '<a href="Jisshi1.htm"><a href="../x.htm"><a href="/tokurei/2.htm">')], "url string, html string")
    got = pages.topic_links(df).select(pages.absolute("url", "link").alias("x")).collect()
    assert [r["x"] for r in got] == ["https://h/a/Jisshi1.htm", "https://h/tokurei/2.htm"]
