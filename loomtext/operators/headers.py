"""Headers of documents: parsing, splitting, trimming and renaming, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions.text import first_lines, lines, once, strip, unlines

# How the header of each db ends.
DIALECT = {"law": "blank", "tsutatsu": "blank", "hanketsu": "yaml_or_blank", "qa": "dashes", "guide": "blank", "paper": "yaml_or_blank", "treaty": "yaml_or_blank", "accounting": "blank"}
# Header fields that trimming removes.
TREATY_FIELDS = ("url", "prev", "next", "section_id", "page_start", "page_end")
PAPER_FIELDS = (*TREATY_FIELDS, "para_count")
# The start of addresses of the corpus's own site: a deployment sets it, or passes `site`.
OWN_SITE = "https://own.example"


def last_match(text: str | Column, pattern: str, n: int = 10) -> Column:
    """Group 1 of the pattern in the last of the first n lines that has it; empty if none."""
    found = F.filter(F.transform(first_lines(text, n), lambda x: F.regexp_extract(x, pattern, 1)), lambda x: x != "")
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def parse(text: str | Column) -> Column:
    """article, egov_id, law_num of a header."""
    return F.struct(
        last_match(text, r"(?U)article:\s*([\w\-]+)").alias("article"),
        last_match(text, r"(?U)egov_id:\s*([A-Z0-9a-z]+)").alias("egov_id"),
        strip(last_match(text, r"(?U)law_num:\s*([^/\n]+)")).alias("law_num"),
    )


def header_end(text: str | Column, dialect: str) -> Column:
    """How many lines the header has, its end included; 0 without an end."""
    ls = lines(text)
    stop = (lambda x: strip(x) == "") if dialect == "blank" else (lambda x: strip(x) == "---")
    at = F.array_position(F.transform(F.slice(ls, 2, F.greatest(F.lit(1), F.size(ls))), stop), True)
    found = F.when(at > 0, at + 1).otherwise(F.lit(0))
    if dialect != "yaml_or_blank":
        return found
    blank = header_end(text, "blank")
    return F.when(strip(F.get(ls, F.lit(0))) == "---", found).otherwise(blank)


def split_header(text: str | Column, dialect: str) -> Column:
    """header (with its end and a line break) and body; an empty header if nothing ends it."""
    whole = F.col(text) if isinstance(text, str) else text

    def parts(s: Column) -> Column:
        ls, n = s["ls"], s["n"]
        head = F.concat(unlines(F.slice(ls, 1, F.greatest(n, F.lit(1)))), F.when(n < F.size(ls), F.lit("\n")).otherwise(F.lit("")))
        body = unlines(F.slice(ls, (n + 1).cast("int"), F.greatest(F.lit(0), F.size(ls) - n).cast("int")))
        return F.struct(F.when(n > 0, head).otherwise(F.lit("")).alias("header"), F.when(n > 0, body).otherwise(whole).alias("body"))

    return once(F.struct(lines(text).alias("ls"), header_end(text, dialect).alias("n")), parts)


def drop_lines(text: str | Column, prefixes: Sequence[str]) -> Column:
    def stays(x: Column) -> Column:
        out = F.lit(True)
        for p in prefixes:
            out = out & ~F.startswith(x, F.lit(p))
        return out

    return unlines(F.filter(lines(text), stays))


def trim_law(text: str | Column, site: str = OWN_SITE) -> Column:
    return F.replace(drop_lines(text, [f"url: {site}"]), F.lit(" / egov_id:  /"), F.lit(" /"))


def trim_guide(text: str | Column, site: str = OWN_SITE) -> Column:
    return drop_lines(text, [f"url: {site}", "section: "])


def trim_tsutatsu(text: str | Column, site: str = OWN_SITE) -> Column:
    kept = F.filter(lines(text), lambda x: ~F.startswith(x, F.lit(f"url: {site}")) & ~F.startswith(x, F.lit("snapshot: ")))
    return unlines(F.transform(kept, lambda x: F.when(F.startswith(x, F.lit("item: ")), F.regexp_replace(x, " / id: [^ /]+", "")).otherwise(x)))


def trim_yaml(text: str | Column, fields: Sequence[str], drop_pid_all: bool = False, blocks: Sequence[str] = (), exact: Sequence[str] = ()) -> Column:
    """Without the fields in the YAML header (between the first two --- lines; body lines stay).

    Fields in `blocks` also lose the lines below them that begin with two spaces, up to the first that doesn't; `exact`
    lines go if they are equal but for white space around them. drop_pid_all: pid goes if its value is all, in quotes or not.
    """
    ls = lines(text)
    # the fold writes down only which lines go: a few of the header
    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("marks"), F.lit(False).alias("cut"), F.array().cast("array<int>").alias("gone"))

    def step(acc: Column, x: Column) -> Column:
        mark = strip(x) == "---"
        marks = acc["marks"] + mark.cast("int")
        inside = (acc["marks"] == 1) & ~mark
        name = F.regexp_extract(x, r"(?U)^(\w+):", 1)
        goes = name.isin(list(fields)) | strip(x).isin(list(exact)) if exact else name.isin(list(fields))
        if drop_pid_all:
            value = F.btrim(F.btrim(strip(F.regexp_replace(x, "^[^:]*:", "")), F.lit('"')), F.lit("'"))
            goes = goes | ((name == "pid") & (value == "all"))
        heads = name.isin(list(blocks)) if blocks else F.lit(False)
        below = acc["cut"] & F.startswith(x, F.lit("  "))
        gone = inside & (goes | heads | below)
        return F.struct((acc["k"] + 1).alias("k"), marks.alias("marks"), (inside & (heads | below)).alias("cut"), F.when(gone, F.array_append(acc["gone"], acc["k"])).otherwise(acc["gone"]).alias("gone"))

    gone = F.aggregate(ls, start, step, lambda acc: acc["gone"])
    return once(gone, lambda g: unlines(F.filter(ls, lambda x, i: ~F.array_contains(g, i))))


def trim_treaty(text: str | Column) -> Column:
    return trim_yaml(text, TREATY_FIELDS, drop_pid_all=True)


def trim_paper(text: str | Column) -> Column:
    return trim_yaml(text, PAPER_FIELDS)


def trim_hanketsu(text: str | Column) -> Column:
    return trim_yaml(text, ("summary_status", "summary_source"), blocks=("source",), exact=("laws: []",))


def trim_qa(text: str | Column) -> Column:
    """Without two header fields and the breadcrumb above the body; unchanged if no --- line, the first included, ends the header."""
    whole = F.col(text) if isinstance(text, str) else text

    def kept(s: Column) -> Column:
        ls, n = s["ls"], s["n"]
        head = F.filter(F.slice(ls, 1, F.greatest(n, F.lit(1)).cast("int")), lambda x: ~F.startswith(x, F.lit("doc_title: ")) & ~F.startswith(x, F.lit("source_kind: ")))
        first, left = F.coalesce(F.get(ls, n), F.lit("")), F.size(ls) - n
        skip = F.when(F.startswith(first, F.lit("法令等")) | F.startswith(first, F.lit("税の情報")), 4).when(F.startswith(first, F.lit("国税庁等について")), 5).otherwise(0)
        skip = F.when(left > skip, skip).otherwise(0)
        rest = F.slice(ls, (n + skip + 1).cast("int"), F.greatest(F.lit(0), left - skip).cast("int"))
        return F.when(n > 0, unlines(F.concat(head, rest))).otherwise(whole)

    end = F.array_position(F.transform(lines(text), lambda x: strip(x) == "---"), True)
    return once(F.struct(lines(text).alias("ls"), end.cast("int").alias("n")), kept)


TRIM = {"law": trim_law, "accounting": trim_guide, "guide": trim_guide, "tsutatsu": trim_tsutatsu, "treaty": trim_treaty, "paper": trim_paper, "qa": trim_qa, "hanketsu": trim_hanketsu}


OWN_SITE_DBS = ("law", "accounting", "guide", "tsutatsu")


def trim(db: str | Column, text: str | Column, site: str = OWN_SITE) -> Column:
    """The trim of the row's db; dbs without one keep their text."""
    db, body = (F.col(db) if isinstance(db, str) else db), (F.col(text) if isinstance(text, str) else text)
    out = None
    for name, f in TRIM.items():
        made = f(body, site) if name in OWN_SITE_DBS else f(body)
        out = F.when(db == name, made) if out is None else out.when(db == name, made)
    return out.otherwise(body)


def rename_anywhere(text: str | Column, names: Mapping[str, str]) -> Column:
    """old: as new:, wherever it stands."""
    out = F.col(text) if isinstance(text, str) else text
    for old, new in names.items():
        out = F.replace(out, F.lit(f"{old}:"), F.lit(f"{new}:"))
    return out


def rename_at_line_start(text: str | Column, names: Mapping[str, str]) -> Column:
    out = F.col(text) if isinstance(text, str) else text
    for old, new in names.items():
        out = F.regexp_replace(out, f"(?md)^{old}:", f"{new}:")
    return out


def title_parts(text: str | Column) -> Column:
    """name and code of `Name (code)`."""
    c = F.col(text) if isinstance(text, str) else text
    return F.struct(F.regexp_extract(c, r"^(.*?)\s*\(([^()]*)\)\s*$", 1).alias("name"), F.regexp_extract(c, r"^(.*?)\s*\(([^()]*)\)\s*$", 2).alias("code"))
