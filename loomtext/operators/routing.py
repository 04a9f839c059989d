"""Lean shards with a routing index, and its rendering for quickstart documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import rstrip, tokens
from loomtext.operators import topics
from loomtext.operators.packing import CAP, pack, with_names

MARKER = "## Shard Routing (lean)"


@dataclass(frozen=True)
class Profile:
    """What a collection's lean shards keep, how they are ordered, and what routes them."""

    keep: tuple[str, ...]
    order: tuple[str, ...]
    topic_text: str
    codes: str | None = None
    country_ids: str | None = None


# The columns of lean shards.
PROFILES = {
    "qa": Profile(("doc_code", "item_id", "item_title"), ("doc_code", "item_id"), "item_title", codes="doc_code"),
    "accounting": Profile(("doc_code", "item_id", "title"), (), "title", codes="doc_code"),
    "guide": Profile(("doc_code", "item_id", "title"), (), "title", codes="doc_code"),
    "treaty": Profile(("id", "pid", "snippet", "core"), (), "snippet", country_ids="id"),
    "paper": Profile(("id", "pid", "snippet", "core"), (), "snippet"),
}
PAPER_PARTS = ("oecd-beps", "oecd-tpg-2022", "nta-tp-audit")


def lean(records: DataFrame, profile: Profile, group: Sequence[str] = (), ord_col: str = "ord", cap: int = CAP) -> DataFrame:
    """The kept columns with shard and file of each record. Records come with an ordinal and named columns."""
    rows = records.select(*group, ord_col, *profile.keep)
    line = F.concat(F.concat_ws("\t", *(F.coalesce(c, F.lit("")) for c in profile.keep)), F.lit("\n"))
    head = (len("\t".join(profile.keep)) + 1) // 3
    return with_names(pack(rows, group, [*profile.order, ord_col], tokens(line), cap, head), group)


def index(packed: DataFrame, profile: Profile, group: Sequence[str] = (), ord_col: str = "ord", **options) -> DataFrame:
    """shard, count, doc_codes, countries, id_range and topics of each shard."""
    key = [*group, "file"]
    empty = F.array().cast("array<string>")
    stats = packed.groupBy(*key).agg(
        F.count("*").alias("count"),
        (topics.distinct_sorted(profile.codes) if profile.codes else F.first(empty)).alias("doc_codes"),
        (topics.countries(profile.country_ids) if profile.country_ids else F.first(empty)).alias("countries"),
        (topics.id_range("id", ord_col) if "id" in profile.keep else F.first(F.lit(None).cast("string"))).alias("id_range"),
    )
    tops = topics.top_list(packed, key, ord_col, profile.topic_text, **options)
    return stats.join(tops, key, "left").withColumn("topics", F.coalesce("topics", empty)).withColumnRenamed("file", "shard")


def papers(records: DataFrame, part: str = "part", ord_col: str = "ord", cap: int = CAP, **options) -> DataFrame:
    """The index of the papers' three parts, each packed apart; records of other parts are left out."""
    rows = records.where(F.col(part).isin(list(PAPER_PARTS)))
    profile = PROFILES["paper"]
    return index(lean(rows, profile, [part], ord_col, cap), profile, [part], ord_col, **options)


def ranged(records: DataFrame, shard: str = "shard", ord_col: str = "ord", text: Sequence[str] = ("title", "topics", "keywords"), **options) -> DataFrame:
    """Shards that stay as they are: count, id range and topics."""
    rows = records.withColumn("_text", F.concat_ws(" ", *text))
    stats = rows.groupBy(shard).agg(F.count("*").alias("count"), topics.id_range("id", ord_col).alias("id_range"))
    return stats.join(topics.top_list(rows, [shard], ord_col, "_text", **options), shard, "left").withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))


def embed(records: DataFrame, group: Sequence[str], ord_col: str = "ord", columns: Sequence[str] = ("id", "date_iso", "tax_types")) -> DataFrame:
    """All records of a group as one text, in order, with its tokens: the text is the result, so a group must fit a row."""
    line = F.concat_ws("\t", *(F.coalesce(c, F.lit("")) for c in columns))
    got = records.groupBy(*group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(ord_col, line.alias("l")))), lambda x: x["l"]), "\n").alias("text"), F.count("*").alias("count"))
    return got.withColumn("tokens", tokens("text"))


def section_lines(ix: DataFrame, with_codes: bool = False, with_countries: bool = False, with_range: bool = False) -> DataFrame:
    """ord, line: the two lines of each shard."""
    head = F.concat(F.col("shard"), F.lit(" ("), F.col("count").cast("string"), F.lit("件): "))
    what = F.array_join("doc_codes", ", ") if with_codes else topics.overflow(F.col("countries")) if with_countries else F.concat(F.lit("ID "), F.col("id_range")) if with_range else F.lit("")
    return ix.select("shard", F.concat(head, F.coalesce(what, F.lit("")), F.lit("\n  Topics: "), F.array_join("topics", ", ")).alias("line"))


def section(ix: DataFrame, intro: Sequence[str], **what) -> DataFrame:
    """One row: the section's text. Shards of one collection are few (a file each); the text is the result."""
    ls = section_lines(ix, **what)
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("shard", "line"))), lambda x: x["line"]), "\n")
    return ls.agg(F.concat(F.lit("\n".join([MARKER, "", *intro, ""]) + "\n"), body).alias("section"))


def upsert(content: Column | str, text: Column | str, marker: str = MARKER) -> Column:
    """The content with the section instead of what follows the marker; the same again when repeated."""
    c, s = (F.col(x) if isinstance(x, str) else x for x in (content, text))
    head = F.when(F.contains(c, F.lit(marker)), rstrip(F.substring_index(c, marker, 1))).otherwise(c)
    return F.concat(head, F.lit("\n\n"), s, F.lit("\n"))


def clean_index(ix: DataFrame, old_base: str) -> DataFrame:
    """A shard index (base_url, shards, docs) without addresses: no base_url, enhanced or lite fields, local shard paths."""
    kept = ix.select([c for c in ix.columns if c != "base_url" and "enhanced" not in c])
    if "shards" in kept.columns:
        names = [f.name for f in kept.schema["shards"].dataType.elementType.fields if f.name != "url" and "enhanced" not in f.name]
        kept = kept.withColumn("shards", F.transform("shards", lambda s: F.struct(*((F.replace(s[n], F.lit("data/shards/"), F.lit("shards/")) if n == "file" else s[n]).alias(n) for n in names))))
    if "docs" in kept.columns:
        names = [f.name for f in kept.schema["docs"].dataType.elementType.fields if "enhanced" not in f.name and "resolve_lite" not in f.name]
        kept = kept.withColumn("docs", F.transform("docs", lambda d: F.struct(*((F.when(~F.contains(F.coalesce(d[n], F.lit("")), F.lit(old_base)), d[n]) if n == "url" else d[n]).alias(n) for n in names))))
    return kept
