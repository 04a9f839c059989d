"""HTML pages: text, links, and numbered items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import strip

HEADING = r"(?md)^[\s\x{3000}]*(\p{Nd}+(?:の\p{Nd}+)*(?:－\p{Nd}+(?:の\p{Nd}+)*)?)\s*[（(]([^）)]+)[）)]\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_text(html: Column | str) -> Column:
    """Line breaks for <br>, no tags, four entities decoded (the ampersand last), LF line ends."""
    t = F.regexp_replace(F.regexp_replace(_c(html), r"(?i)<br\s*/?>", "\n"), "<[^>]+>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.replace(t, F.lit("\r\n"), F.lit("\n"))


def links(pages: DataFrame, html: str = "html", pattern: str = r'href="([^"]*)"') -> DataFrame:
    """The page's columns with ord and link of every link on it."""
    found = pages.select(*[c for c in pages.columns if c != html], F.posexplode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(pattern), F.lit(1))).alias("ord", "link"))
    return found.withColumn("ord", F.col("ord").cast("long"))


def topic_links(pages: DataFrame, html: str = "html", words: tuple[str, ...] = ("jisshi", "tokurei")) -> DataFrame:
    """Links to .htm pages whose lower-cased address holds one of the words; repeats stay."""
    return links(pages, html, r'href="([^"]*\.htm)"').where(F.lower("link").rlike("|".join(words)))


_ADDRESS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_LEADING = r"^[\x00-\x20]+|[\t\r\n]"


def absolute(base: Column | str, link: Column | str) -> Column:
    """The address that a link on a page of address `base` leads to, as browsers and RFC 3986 resolve it.

    Bases are http and https addresses or paths; a link of another scheme, or on a base of another scheme, stays as it is. A
    null or empty base gives the link, a null or empty link the base. White space before an address and line ends
    and tabs in it don't count; empty queries, fragments and segments go; parameters after a semicolon belong to their segment.
    """
    raw_base, raw = F.coalesce(_c(base), F.lit("")), F.coalesce(_c(link), F.lit(""))
    resolved = _once(_parts(raw_base), lambda b: _once(_parts(raw), lambda x: F.when((x["scheme"] != "") & (x["scheme"] != b["scheme"]) | ~b["scheme"].isin("", "http", "https"), raw).otherwise(_resolved(b, x))))
    return F.when(raw_base == "", raw).when(raw == "", raw_base).otherwise(resolved)


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _parts(address: Column) -> Column:
    part = lambda c, i, name: F.regexp_extract(c, _ADDRESS, i).alias(name)
    parts = lambda c: F.struct(F.lower(part(c, 1, "s")).alias("scheme"), *(part(c, i, n) for i, n in enumerate(("host", "path", "query", "fragment"), 2)))
    return _once(F.regexp_replace(address, _LEADING, ""), parts)


def _resolved(b: Column, x: Column) -> Column:
    """Address of the parts x on a page of the parts b."""
    here = (x["host"] == "") & (x["path"] == "")
    to = F.when(x["host"] != "", x["path"]).when(here, b["path"]).otherwise(_walked(b["path"], x["path"]))
    host = F.when(x["host"] != "", x["host"]).otherwise(b["host"])
    query = F.when(here & (x["query"] == ""), b["query"]).otherwise(x["query"])
    some = lambda before, c, after="": F.when(c != "", F.concat(F.lit(before), c, F.lit(after))).otherwise("")
    at_host = lambda path: F.concat(some("//", host), F.when((host != "") & (path != "") & ~F.startswith(path, F.lit("/")), "/").otherwise(""), path)
    return F.concat(some("", b["scheme"], ":"), _once(to, at_host), some("?", query), some("#", x["fragment"]))


def _walked(base: Column, path: Column) -> Column:
    """The path from the folder of `base`, without empty steps, dots and what two dots go back over."""
    above = F.split(base, "/", -1)
    folder = F.when(base == "", F.array(F.lit(""))).otherwise(F.slice(above, F.lit(1), F.size(above) - 1))
    own = F.split(path, "/", -1)
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    step = lambda done, s: F.when(s == "..", up(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    full = lambda s: _once(F.size(s) - 1, lambda last: F.filter(s, lambda v, i: (v != "") | (i == 0) | (i == last)))
    steps = _once(F.when(F.startswith(path, F.lit("/")), own).otherwise(F.concat(folder, own)), full)
    last = F.when(F.element_at(own, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    joined = F.array_join(F.concat(F.aggregate(steps, F.array().cast("array<string>"), step), last), "/")
    return _once(joined, lambda p: F.when(p == "", "/").otherwise(p))


def items(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """item_id, title, body of each numbered item of a page; the page as one item, named by its address, without headings.

    A block ends where the next heading starts: the text is split before headings, so no offsets are needed.
    """
    text = to_text(html)
    parts = F.filter(F.split(text, HEADING.replace("(?md)", "(?md)(?=", 1) + ")", -1), lambda p: p.rlike(r"\S"))
    rows = pages.select(url, text.alias("_t"), F.posexplode_outer(parts).alias("_n", "_p"))
    head = F.regexp_extract("_p", HEADING, 0)
    rest = F.substr("_p", F.length(head) + 1)
    keep = lambda x: (x != "") & ~F.startswith(x, F.lit("Copyright")) & ~F.startswith(x, F.lit("ページの先頭"))
    ls = F.filter(F.transform(F.split(rest, "\n", -1), strip), keep)
    body = F.array_join(F.transform(ls, lambda x, i: F.concat(F.lit("[p"), (i + 1).cast("string"), F.lit("] "), x)), "\n")
    named = F.regexp_replace(F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1), r"\.htm", "")
    own = rows.where(F.col("_p").rlike(HEADING)).select(url, "_n", F.translate(F.regexp_extract("_p", HEADING, 1), "の－", "--").alias("item_id"), F.regexp_extract("_p", HEADING, 2).alias("title"), body.alias("body")).where("body <> ''")
    all_lines = F.filter(F.transform(F.split(text, "\n", -1), strip), lambda x: (x != "") & ~F.startswith(x, F.lit("Copyright")))
    whole = pages.where(~text.rlike(HEADING)).select(url, F.lit(0).alias("_n"), named.alias("item_id"), named.alias("title"), F.array_join(all_lines, "\n").alias("_b")).where("_b <> ''").withColumn("body", F.concat(F.lit("[p1] "), F.col("_b"))).drop("_b")
    return own.unionByName(whole).withColumnRenamed("_n", "ord")
