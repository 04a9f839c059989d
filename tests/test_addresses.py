"""Addresses of links against the standard library, over every pair of many forms."""

from urllib.parse import urljoin

from loomtext.operators import pages

BASES = ["http://h.example/a/b/c.htm", "https://h.example", "http://h.example/", "http://h.example/a/b/?q=1#f", "http://h.example/a//b/../c?x=/y/z", "HTTP://H.example:80/x", "a/b", "/a/b/c", "mailto:x@y", "", None]
LINKS = """x.htm|./x|../x|../../../x|..|.|./|../|/y|/y/../z|/./|//o.example|//o.example/p/../q|https://o.example/w?x#y|http://h.example|http:x|HTTP://O.example/a|?q|?|#f|#|x?q#f|x?|a//b|
mailto:a@b|javascript:void(0)|tel:1|x:y|1:2|a/./b/../c/|..../x|x/..|x/.|///t|//|日本/第一章.htm|a b|%2e%2e/x|x?a/../b|x#a/../b|  x| /y|\t//o.example/k|.hidden|..hidden|?a=b?c|x#y#z|""".split("|")


def test_absolute_equals_the_standard_library(spark):
    pairs = [(b, x) for b in BASES for x in [*LINKS, None, " \n"]]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, b string, x string")
    got = {r["i"]: r["to"] for r in df.select("i", pages.absolute("b", "x").alias("to")).collect()}
    wrong = [(*p, got[i], urljoin(p[0] or "", p[1] or "")) for i, p in enumerate(pairs) if got[i] != urljoin(p[0] or "", p[1] or "")]
    assert not wrong


def test_absolute_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("http://h/a", "b")], "url string, link string").select(pages.absolute("url", "link"))
    assert "Python" not in df._jdf.queryExecution().toString()
