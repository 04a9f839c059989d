"""Worked examples of statute trees, their articles, appendices and rowspans. They read no table, so they are tests and no queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

from loomtext.operators import tables, tree
from loomtext.plans.registry import long

_LAW = """{"law_full_text": {"tag": "Law", "attr": {}, "children": [{"tag": "MainProvision", "children": [
{"tag": "Article", "attr": {"Num": "1"}, "children": [{"tag": "ArticleTitle", "children": ["第一条"]}, {"tag": "Paragraph", "attr": {"Num": "1"}, "children": [{"tag": "ParagraphSentence", "children": ["甲", {"tag": "Ruby", "children": ["乙", {"tag": "Rt", "children": ["おつ"]}]}, "丙"]},
 {"tag": "Item", "attr": {"Num": "1"}, "children": [{"tag": "ItemTitle", "children": ["一"]}, {"tag": "ItemSentence", "children": ["号"]}, {"tag": "Subitem1", "attr": {}, "children": [{"tag": "Subitem1Title", "children": ["イ"]}, {"tag": "Subitem1Sentence", "children": ["細"]}]}]}]}]},
{"tag": "Article", "attr": {"Num": "2_3"}, "children": [{"tag": "ArticleTitle", "children": ["第二条の三"]}, {"tag": "Paragraph", "attr": {"Num": "1"}, "children": [{"tag": "ParagraphSentence", "children": ["a"]}]}, {"tag": "Paragraph", "attr": {"Num": "2"}, "children": [{"tag": "ParagraphSentence", "children": ["b"]}]}]}]},
{"tag": "SupplProvision", "children": [{"tag": "Article", "attr": {"Num": "9"}, "children": []}]},
{"tag": "AppdxTable", "children": [{"tag": "AppdxTableTitle", "children": ["別表"]}, {"tag": "RelatedArticleNum", "children": ["（第一条関係）"]}, {"tag": "TableStruct", "children": [{"tag": "Table", "children": [{"tag": "TableRow", "children": [{"tag": "TableColumn", "attr": {"rowspan": "2"}, "children": ["A"]}, {"tag": "TableColumn", "children": ["B"]}]}, {"tag": "TableRow", "children": [{"tag": "TableColumn", "children": ["C"]}]}]}]}]}]}}"""
_XML = "<Law><MainProvision><Article Num='1'><ArticleTitle>T1</ArticleTitle><Paragraph Num='1'><ParagraphSentence>a<Ruby>b<Rt>c</Rt></Ruby>d</ParagraphSentence></Paragraph></Article><Article Num='2_1'><ArticleCaption>(C2)</ArticleCaption><Paragraph Num='1'><ParagraphSentence>e</ParagraphSentence></Paragraph><Paragraph Num='2'><ParagraphSentence>f</ParagraphSentence><Item Num='1'><ItemTitle>i</ItemTitle><ItemSentence>g</ItemSentence></Item></Paragraph></Article></MainProvision></Law>"


def law_tree_walk(spark):
    laws = spark.createDataFrame([("law1", _LAW)], "law string, tree string")
    return tree.nodes(laws, "law", "tree").groupBy("tag").agg(F.count("*").alias("nodes"), long(F.max(F.size("path"))).alias("depth"), F.count_if("in_supplement").alias("in_supplement"))


def law_articles(spark):
    laws = spark.createDataFrame([("law1", _LAW), ("law2", None), ("law3", "{")], "law string, tree string")
    return tree.articles(laws)


def xml_articles(spark):
    return tree.articles(spark.createDataFrame([("law1", _XML)], "law string, tree string"))


def law_appendix(spark):
    return tables.appendices(spark.createDataFrame([("law1", _LAW)], "law string, tree string")).select("law", "name", "title", "body")


def rowspan_expand(spark):
    rows = spark.createDataFrame([(1, [[("A", 2), ("B", 1)], [("C", 1), ("D", 1)]]), (2, [[("A", 1), ("B", 1)], [("C", 1)]])], f"id int, grid {tables.RAW_GRID}")
    flat = lambda c: F.array_join(F.transform(c, lambda r: F.array_join(r, ",")), ";")
    return rows.select("id", flat(tables.expand_rowspan("grid", True)).alias("fixed"), flat(tables.expand_rowspan("grid")).alias("growing"))


WANT = {
    law_tree_walk: "SELECT * FROM (VALUES ('AppdxTable', 1, 2, 0), ('AppdxTableTitle', 1, 3, 0), ('Article', 3, 3, 1), ('ArticleTitle', 2, 4, 0), ('Item', 1, 5, 0), ('ItemSentence', 1, 6, 0), ('ItemTitle', 1, 6, 0), ('Law', 1, 1, 0), ('MainProvision', 1, 2, 0), ('Paragraph', 3, 4, 0), ('ParagraphSentence', 3, 5, 0), ('RelatedArticleNum', 1, 3, 0), ('Rt', 1, 7, 0), ('Ruby', 1, 6, 0), ('Subitem1', 1, 6, 0), ('Subitem1Sentence', 1, 7, 0), ('Subitem1Title', 1, 7, 0), ('SupplProvision', 1, 2, 1), ('Table', 1, 4, 0), ('TableColumn', 3, 6, 0), ('TableRow', 2, 5, 0), ('TableStruct', 1, 3, 0)) t(tag, nodes, depth, in_supplement)",
    law_articles: "SELECT * FROM (VALUES ('law1', '1', '第一条', '[p1] 甲乙丙' || chr(10) || '[p1-i1] 一 号' || chr(10) || '[p1-i1-s1] イ 細'), ('law1', '2_3', '第二条の三', '[p1] 1 a' || chr(10) || '[p2] 2 b')) t(law, num, title, body)",
    xml_articles: "SELECT * FROM (VALUES ('law1', '1', 'T1', '[p1] abd'), ('law1', '2_1', 'C2', '[p1] 1 e' || chr(10) || '[p2] 2 f' || chr(10) || '[p2-i1] i g')) t(law, num, title, body)",
    law_appendix: "SELECT 'law1' AS law, 'beppyo-1' AS name, '別表' AS title, '（第一条関係）' || chr(10) || chr(10) || '| A | B |' || chr(10) || '| --- | --- |' || chr(10) || '| A | C |' AS body",
    rowspan_expand: "SELECT * FROM (VALUES (1, 'A,B;A,C', 'A,B;A,C,D'), (2, 'A,B;C,', 'A,B;C')) t(id, fixed, growing)",
}


@pytest.mark.parametrize("example", WANT)
def test_example(spark, example):
    got, want = example(spark).toArrow(), duckdb.sql(WANT[example]).to_arrow_table()
    rows = lambda t: sorted(map(repr, zip(*(t.column(c).to_pylist() for c in sorted(want.column_names)), strict=True)))
    assert sorted(got.column_names) == sorted(want.column_names) and rows(got) == rows(want)
