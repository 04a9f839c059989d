"""Tables of statutes: rowspans, Markdown, appendices, and inserting them into documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.slices import by_slices
from loomtext.functions.text import once, rstrip, strip
from loomtext.operators.chunking import Limits, split
from loomtext.operators.tree import SUPPLEMENT, Node, child_text, collect, first, parse, text_of

RAW_GRID = "array<array<struct<t: string, rs: int>>>"
_GRIDS = pa.list_(pa.list_(pa.list_(pa.string())))
TABLE_REF = "次の表|左の表|下の表"
MARKER = "<!--TABLE_INSERTED-->"


def expand(rows: list[list[tuple[str, int]]], fixed: bool) -> list[list[str]]:
    """Cells repeated down their rowspans. fixed: as wide as the widest raw row, padded, overflow dropped; else rows grow."""
    width = max((len(r) for r in rows), default=0)
    pending: dict[int, tuple[str, int]] = {}
    out = []
    for cells in rows:
        row, todo, col = [], list(cells), 0
        while (col < width) if fixed else (todo or col in pending):
            if col in pending:
                text, left = pending.pop(col)
                if left > 1:
                    pending[col] = (text, left - 1)
            elif todo:
                text, span = todo.pop(0)
                if (span or 1) > 1:
                    pending[col] = (text, span - 1)
            else:
                text = ""
            row.append(text)
            col += 1
        out.append(row)
    return out


def expand_rowspan(grid: Column | str, fixed: bool = False) -> Column:
    @F.arrow_udf("array<array<string>>")
    def run(grids: pa.Array) -> pa.Array:
        out = [expand([[(c["t"] or "", c["rs"] or 1) for c in r] for r in g], fixed) if g is not None else None for g in grids.to_pylist()]
        return pa.array(out, pa.list_(pa.list_(pa.string())))

    return run(F.col(grid) if isinstance(grid, str) else grid)


def compact_markdown(grid: Column | str) -> Column:
    """| a | b | rows with a rule after the first; ragged rows padded; empty for an empty grid."""
    g = F.col(grid) if isinstance(grid, str) else grid
    n = F.array_max(F.transform(g, F.size))
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), n - F.size(r))), " | "), F.lit(" |"))
    rule = F.array(F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n), " | "), F.lit(" |")))
    text = F.transform(g, row)
    return F.when(F.size(g) > 0, F.array_join(F.concat(F.slice(text, 1, 1), rule, F.slice(text, 2, F.greatest(F.size(g), F.lit(1)))), "\n")).otherwise(F.lit(""))


def padded_markdown(grid: Column | str) -> Column:
    """The same with escaped bars, cells padded to the column's width (3 at least), a line break before and after."""
    g = F.col(grid) if isinstance(grid, str) else grid
    clean = F.transform(g, lambda r: F.transform(r, lambda c: F.translate(F.coalesce(c, F.lit("")), "|\n", "｜ ")))
    n = F.array_max(F.transform(clean, F.size))
    cols = F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
    cell = lambda r, i: F.coalesce(F.get(r, i), F.lit(""))
    widths = F.transform(cols, lambda i: F.greatest(F.lit(3), F.array_max(F.transform(clean, lambda r: F.length(cell(r, i))))))
    line = lambda parts: F.concat(F.lit("| "), F.array_join(parts, " | "), F.lit(" |"))
    rows = F.transform(clean, lambda r: line(F.transform(cols, lambda i: F.rpad(cell(r, i), F.get(widths, i), F.lit(" ")))))
    rule = F.array(line(F.transform(widths, lambda w: F.repeat(F.lit("-"), w))))
    text = F.array_join(F.concat(F.slice(rows, 1, 1), rule, F.slice(rows, 2, F.greatest(F.size(g), F.lit(1)))), "\n")
    return F.when(F.size(g) > 0, F.concat(F.lit("\n"), text, F.lit("\n"))).otherwise(F.lit(""))


def raw_rows(table: Node, drop_ruby: bool = False, sentences: bool = False, keep_empty: bool = True) -> list[list[tuple[str, int]]]:
    """Cells with rowspans; the text of a cell is all its text, or its sentences joined by spaces."""
    out = []
    for row in collect(table, "TableRow"):
        cells = []
        for c in row.nodes():
            if c.tag == "TableColumn":
                span = c.attr.get("rowspan", "1")
                text = " ".join(text_of(s, drop_ruby).strip() for s in collect(c, "Sentence")) if sentences else text_of(c, drop_ruby).strip().replace("\n", " ")
                cells.append((text, int(span) if span.isdigit() else 1))
        if cells or keep_empty:
            out.append(cells)
    return out


def markdown(grid: list[list[str]]) -> str:
    if not grid:
        return ""
    n = max(len(r) for r in grid)
    rows = ["| " + " | ".join([*r, *[""] * (n - len(r))]) + " |" for r in grid]
    return "\n".join([rows[0], "| " + " | ".join(["---"] * n) + " |", *rows[1:]])


def item_lines(node: Node, depth: int = 0) -> Iterator[str]:
    """Items and subitems, two spaces deeper at each level."""
    title = child_text(node, lambda t: t.endswith("Title"), False)
    text = child_text(node, lambda t: t.endswith("Sentence"), False)
    if title or text:
        yield f"{'  ' * depth}{title} {text}".rstrip()
    for c in node.nodes():
        if (c.tag == "Item" or c.tag.startswith("Subitem")) and not c.tag.endswith(("Title", "Sentence")):
            yield from item_lines(c, depth + 1)


def appendix(node: Node, tables_only: bool = False) -> tuple[str, str]:
    """Title, and the related article, tables and items in order."""
    parts = [] if tables_only else [t for t in (child_text(node, lambda t: t == "RelatedArticleNum", False),) if t]

    def walk(n: Node) -> None:
        if n.tag == "TableStruct":
            title = child_text(n, lambda t: t == "TableStructTitle", False)
            table = markdown(expand(raw_rows(n), False))
            parts.append(f"### {title}\n{table}" if title else table)
        elif n.tag == "Item" and not tables_only:
            if ls := list(item_lines(n)):
                parts.append("\n".join(ls))
        else:
            for c in n.nodes():
                walk(c)

    walk(node)
    return child_text(node, lambda t: t == "AppdxTableTitle", False), "\n\n".join(parts)


def appendices(laws: DataFrame, tree: str = "tree", drop_supplement: bool = True, tables_only: bool = False) -> DataFrame:
    """The law's columns, idx (counted before empty ones go), name beppyo-idx, title and body of each appendix table."""

    def run(trees: list[str | None]) -> list[list[dict]]:
        out = []
        for x in trees:
            t = parse(x)
            found = [appendix(a, tables_only) for a in collect(t, "AppdxTable", SUPPLEMENT if drop_supplement else None)] if t else []
            out.append([{"idx": i, "title": h, "body": b} for i, (h, b) in enumerate(found, 1) if b.strip()])
        return out

    kind = pa.list_(pa.struct([("idx", pa.int32()), ("title", pa.string()), ("body", pa.string())]))
    rows = laws.select(*[c for c in laws.columns if c != tree], F.explode(by_slices(run, kind, "array<struct<idx: int, title: string, body: string>>", F.col(tree))).alias("a"))
    return rows.select("*", "a.idx", F.concat(F.lit("beppyo-"), F.col("a.idx").cast("string")).alias("name"), "a.title", "a.body").drop("a")


def article_grids(tree: Column | str, num: Column | str, fixed: bool = True, keep_empty: bool = True) -> Column:
    """The grids of the tables of the article with this number (the first in document order)."""

    def run(trees: list[str | None], nums: list[str | None]) -> list[list | None]:
        out = []
        for x, n in zip(trees, nums):
            t = parse(x)
            a = first(t, lambda k: k.tag == "Article" and k.attr.get("Num") == n) if t else None
            grids = [expand(raw_rows(s, True, True, False), fixed) for s in collect(a, "TableStruct")] if a else None
            out.append(grids if grids is None or keep_empty else [g for g in grids if g])
        return out

    c = lambda v: F.col(v) if isinstance(v, str) else v
    return by_slices(run, _GRIDS, "array<array<array<string>>>", c(tree), c(num))


def law_tables(laws: DataFrame, key: str, tree: str = "tree", fixed: bool = True) -> DataFrame:
    """key, article (its number), at (0), grids: the tables of each article of each law, in document order. Each law is parsed once.

    Of articles with the same number the first counts; an article without tables has an empty list, so that it differs from one that isn't there.
    """

    def run(trees: list[str | None]) -> list[list[dict]]:
        out = []
        for x in trees:
            found: dict[str, list] = {}
            t = parse(x)
            for a in collect(t, "Article") if t else ():
                found.setdefault(a.attr.get("Num") or "", [expand(raw_rows(s, True, True, False), fixed) for s in collect(a, "TableStruct")])
            out.append([{"article": n, "grids": g} for n, g in found.items()])
        return out

    kind = pa.list_(pa.struct([("article", pa.string()), ("grids", _GRIDS)]))
    return laws.select(key, F.inline(by_slices(run, kind, "array<struct<article: string, grids: array<array<array<string>>>>>", F.col(tree))))


def with_grids(docs: DataFrame, laws: DataFrame, key: str, article: str = "article", tree: str = "tree", fixed: bool = True) -> DataFrame:
    """The documents with the grids of the article that they name, by an equi-join on law and number; null where the law or the article isn't there."""
    found = law_tables(laws, key, tree, fixed).withColumnRenamed("article", article)
    return docs.join(found, [key, article], "left")


def rendered(grids: Column | str) -> Column:
    """Each grid that has rows, as a Markdown table on lines of its own."""
    g = F.col(grids) if isinstance(grids, str) else grids
    return F.transform(F.filter(g, lambda x: F.size(x) > 0), lambda x: F.concat(F.lit("\n"), compact_markdown(x), F.lit("\n")))


def blocks(text: Column | str) -> Column:
    """The text before the first [pN…] line, then each block, which starts with one."""
    t = F.col(text) if isinstance(text, str) else text
    return F.split(t, r"(?md)(?=^\[p\d+[^\]]*\])", -1)


def insert(text: Column | str, tables: Column | str) -> Column:
    """The text with the k-th rendered table at the end of the k-th block that refers to one, and the marker after the header.

    Tables or blocks too many are left. Unchanged if the marker is there, or without tables or blocks.
    """
    t, md = (F.col(c) if isinstance(c, str) else c for c in (text, tables))
    is_ref = lambda b: b.rlike(r"^\[p\d+[^\]]*\]") & b.rlike(TABLE_REF)
    own = blocks(t)
    numbers = F.filter(F.transform(own, lambda b, i: F.when(is_ref(b), i)), lambda i: i.isNotNull())

    def filled(b: Column, k: Column) -> Column:
        body = rstrip(b)
        return F.when((k > 0) & (k <= F.size(md)), F.concat(body, F.get(md, (k - 1).cast("int")), F.substr(b, F.length(body) + 1))).otherwise(b)

    joined = once(numbers, lambda ns: F.array_join(F.transform(own, lambda b, i: filled(b, F.array_position(ns, i))), ""))

    def marked_(ls: Column) -> Column:
        at = F.array_position(F.transform(F.slice(ls, 2, F.greatest(F.size(ls), F.lit(1))), lambda x: strip(x) == ""), True)
        return F.array_join(once(at, lambda k: F.when(k > 0, F.array_insert(ls, F.greatest(k + 2, F.lit(1)).cast("int"), F.lit(MARKER))).otherwise(ls)), "\n")

    marked = once(F.split(joined, "\n", -1), marked_)
    return F.when(status(t, md) == "inserted", marked).otherwise(t)


def status(text: Column | str, tables: Column | str) -> Column:
    t, md = (F.col(c) if isinstance(c, str) else c for c in (text, tables))
    refs = F.exists(blocks(t), lambda b: b.rlike(r"^\[p\d+[^\]]*\]") & b.rlike(TABLE_REF))
    return F.when(F.contains(t, F.lit(MARKER)), "already_done").when(md.isNull() | (F.size(md) == 0), "no_tables").when(~refs, "no_points").otherwise("inserted")


def insert_and_split(docs: DataFrame, limits: Limits = Limits(), tables: str = "tables") -> DataFrame:
    """Documents (db, stem, text, rendered tables) with their tables, split again where that made them too long; with the status of each.

    One plan: what comes of a document decides where it goes, and only those above the limit leave the JVM.
    """
    done = docs.withColumns({"status": status("text", tables), "text": insert("text", tables)}).drop(tables)
    return split(done, limits)


def process_status(article: Column, mode: Column, source: Column, grids: Column, text: Column) -> Column:
    """The whole status of a document: what is missing first, else what inserting gives."""
    return (
        F.when(F.contains(text, F.lit(MARKER)), "already_done")
        .when(F.coalesce(article, F.lit("")) == "", "error_no_article")
        .when(mode == "unknown", "error_no_source")
        .when(source.isNull(), "error_api")
        .when(grids.isNull() | (F.size(grids) == 0), "error_no_tables")
        .otherwise(status(text, grids))
    )
