"""Statute trees from JSON or XML: node tables, articles, paragraphs, appendix tables.

A tree is a node (tag, attributes, children) with text between the children. Both formats become the same nodes; each
tree is walked once in the task that holds its row.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.slices import by_slices

SUPPLEMENT = "SupplProvision"


@dataclass
class Node:
    tag: str
    attr: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def nodes(self) -> Iterator[Node]:
        return (c for c in self.children if isinstance(c, Node))


def from_json(text: str) -> Node:
    """A tree of {tag, attr, children}, or a document that holds one as law_full_text."""
    def node(x: dict) -> Node:
        return Node(x.get("tag", ""), x.get("attr") or {}, [node(c) if isinstance(c, dict) else str(c) for c in x.get("children") or []])

    got = json.loads(text)
    return node(got.get("law_full_text", got))


def from_xml(text: str) -> Node:
    def node(x: ET.Element) -> Node:
        out = Node(x.tag, dict(x.attrib), [x.text] if x.text else [])
        for c in x:
            out.children.append(node(c))
            if c.tail:
                out.children.append(c.tail)
        return out

    return node(ET.fromstring(text))


def parse(text: str | None) -> Node | None:
    """Either format by its first character; None if it is neither."""
    if not text or not text.strip():
        return None
    try:
        return from_xml(text) if text.lstrip()[0] == "<" else from_json(text)
    except (ValueError, ET.ParseError, AttributeError):
        return None


def text_of(node: Node, drop_ruby: bool = True) -> str:
    """All text in document order, without ruby readings; what follows a reading stays."""
    if drop_ruby and node.tag == "Rt":
        return ""
    return "".join(c if isinstance(c, str) else text_of(c, drop_ruby) for c in node.children)


def collect(node: Node, tag: str, skip: str | None = None) -> list[Node]:
    """Nodes of the tag in document order; not below a match or below `skip`."""
    if node.tag == tag:
        return [node]
    return [] if node.tag == skip else [m for c in node.nodes() for m in collect(c, tag, skip)]


def first(node: Node, test: Callable[[Node], bool]) -> Node | None:
    if test(node):
        return node
    return next((m for c in node.nodes() if (m := first(c, test))), None)


def child_text(node: Node, test: Callable[[str], bool], drop_ruby: bool = True) -> str:
    return next((text_of(c, drop_ruby).strip() for c in node.nodes() if test(c.tag)), "")


def _subitems(node: Node, post_order: bool) -> list[tuple[str, str]]:
    out = []
    for c in node.nodes():
        if c.tag.startswith("Subitem") and not c.tag.endswith(("Title", "Sentence")):
            own = [(child_text(c, lambda t: t.endswith("Title")), child_text(c, lambda t: t.endswith("Sentence")))]
            deep = _subitems(c, post_order)
            out += deep + own if post_order else own + deep
    return out


def article(node: Node, post_order: bool = False) -> dict:
    paragraphs = []
    for p in collect_direct(node, "Paragraph"):
        items = []
        for i in collect_direct(p, "Item"):
            items.append({"num": i.attr.get("Num") or "?", "title": child_text(i, lambda t: t == "ItemTitle"), "text": child_text(i, lambda t: t == "ItemSentence"), "subs": [{"title": t, "text": x} for t, x in _subitems(i, post_order)]})
        num = p.attr.get("Num", "")
        paragraphs.append({"num": int(num) if num.isdigit() else 1, "label": child_text(p, lambda t: t == "ParagraphNum"), "text": child_text(p, lambda t: t == "ParagraphSentence"), "items": items})
    title = child_text(node, lambda t: t == "ArticleCaption").strip("（）()") or child_text(node, lambda t: t == "ArticleTitle")
    return {"num": node.attr.get("Num", ""), "title": title, "paragraphs": paragraphs}


def collect_direct(node: Node, tag: str) -> list[Node]:
    return [c for c in node.nodes() if c.tag == tag]


def body_lines(a: dict, repeat_number: bool = False) -> list[str]:
    """[pN], [pN-iM], [pN-iM-sK] lines; the paragraph's number is repeated where there are several (or always)."""
    out = []
    many = repeat_number or len(a["paragraphs"]) > 1
    for p in a["paragraphs"]:
        n = p["num"]
        out.append(f"[p{n}] {n} {p['text']}" if many else f"[p{n}] {p['text']}")
        for i in p["items"]:
            out.append(f"[p{n}-i{i['num']}] {i['title']} {i['text']}".rstrip())
            for k, s in enumerate(i["subs"], 1):
                out.append(f"[p{n}-i{i['num']}-s{k}] {s['title']} {s['text']}".rstrip())
    return out


ARTICLES = "array<struct<num: string, title: string, body: string>>"
_ARTICLES = pa.list_(pa.struct([(c, pa.string()) for c in ("num", "title", "body")]))
NODES = "path array<int>, tag string, attr map<string, string>, text string, in_supplement boolean"
_NODES = {"path": pa.list_(pa.int32()), "tag": pa.string(), "attr": pa.map_(pa.string(), pa.string()), "text": pa.string(), "in_supplement": pa.bool_()}
NODE_ROWS = 4_096


def _walk(node: Node, path: list[int], inside: bool) -> Iterator[tuple]:
    inside = inside or node.tag == SUPPLEMENT
    yield path, node.tag, list(node.attr.items()), "".join(c for c in node.children if isinstance(c, str)), inside
    for k, c in enumerate(node.children):
        if isinstance(c, Node):
            yield from _walk(c, [*path, k], inside)


def listed(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The nodes of the trees in the second column, each with the key in the first; a batch has no more than NODE_ROWS."""

    def made(keys: pa.Array, of: list[int], rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys.take(pa.array(of)), *(pa.array(x, kind) for kind, x in zip(_NODES.values(), zip(*rows), strict=True))], [key, *_NODES])

    for batch in batches:
        of: list[int] = []
        rows: list[tuple] = []
        for i in range(len(batch)):
            t = parse(batch.column(1)[i].as_py())
            for row in _walk(t, [0], False) if t else ():
                of.append(i)
                rows.append(row)
                if len(rows) == NODE_ROWS:
                    yield made(batch.column(0), of, rows)
                    of, rows = [], []
        if rows:
            yield made(batch.column(0), of, rows)


def nodes(laws: DataFrame, key: str, tree: str) -> DataFrame:
    """The node table: key, path, tag, attr, text, in_supplement. Paths order like the document.

    A task holds one tree and 4,096 of the nodes that it lists.
    """
    src = laws.select(key, tree)
    return src.mapInArrow(lambda batches: listed(batches, key), T.StructType([src.schema[key], *T.StructType.fromDDL(NODES)]))


def articles_of(tree: Column | str, drop_supplement: bool = True, only: str | None = None, post_order: bool = False, repeat_number: bool = False) -> Column:
    """Articles of the main provision (all without one): num, title and marked body. `only` is a pattern for numbers."""
    import re

    def run(trees: list[str | None]) -> list[list[dict]]:
        out = []
        for x in trees:
            t = parse(x)
            root = (first(t, lambda n: n.tag == "MainProvision") or t) if t else None
            found = [article(a, post_order) for a in collect(root, "Article", SUPPLEMENT if drop_supplement else None)] if root else []
            out.append([{"num": a["num"], "title": a["title"], "body": "\n".join(body_lines(a, repeat_number))} for a in found if not only or re.fullmatch(only, a["num"])])
        return out

    return by_slices(run, _ARTICLES, ARTICLES, F.col(tree) if isinstance(tree, str) else tree)


def articles(laws: DataFrame, tree: str = "tree", **options) -> DataFrame:
    """A row for each article: the law's columns, num, title, body."""
    return laws.select(*[c for c in laws.columns if c != tree], F.explode(articles_of(tree, **options)).alias("a")).select("*", "a.num", "a.title", "a.body").drop("a")


def document(law: Column, law_type: Column, law_num: Column, egov_id: Column, as_of: Column, num: Column, title: Column, body: Column, raw_num: bool = False) -> Column:
    """The text file of an article: three header lines, a blank one, the body. An empty egov_id is left out."""
    has = F.coalesce(egov_id, F.lit("")) != ""
    ids = F.concat(F.lit("law_type: "), law_type, F.lit(" / law_num: "), law_num, F.when(has, F.concat(F.lit(" / egov_id: "), egov_id)).otherwise(F.lit("")), F.lit(" / as_of: "), as_of)
    shown = num if raw_num else F.translate(num, "_", "-")
    return F.concat(F.lit("law: "), law, F.lit("\n"), ids, F.lit("\narticle: "), shown, F.lit(" / title: "), title, F.lit("\n\n"), body, F.lit("\n"))
