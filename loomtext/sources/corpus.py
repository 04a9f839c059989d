"""Reading a corpus: text trees, shard files, landed JSON and XML, dimension tables."""

from __future__ import annotations

import re
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.functions.text import newlines
from loomtext.operators.chunking import is_chunk
from loomtext.operators.headers import parse
from loomtext.operators.tables import MARKER, TABLE_REF
from loomtext.scratch import stash


def documents(spark: SparkSession, root: str, pattern: str = "*.txt", dbs: Sequence[str] | None = None) -> DataFrame:
    """db, path, stem, text of every text file below root/{db}/text, whole, with LF line ends.

    With `dbs` only their folders are listed and read; an unknown one among them has no rows, none known is an error of the reader.
    """
    if dbs is not None:
        if not dbs or any(not d or set(d) & set("{}[]*?,\\/") for d in dbs):
            raise ValueError("dbs: names of folders")
        at = f"{root}/{{{','.join(dbs)}}}/text"
    else:
        at = root
    raw = spark.read.text(at, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    at = F.url_decode(F.col("_metadata.file_path"))
    rows = raw.select(at.alias("file"), newlines("value").alias("text"))
    return rows.select(
        F.regexp_extract("file", r"([^/]+)/text/", 1).alias("db"),
        F.regexp_replace(F.regexp_extract("file", r"/text/(.*)$", 1), r"/?[^/]*$", "").alias("path"),
        F.regexp_extract("file", r"([^/]+)\.[^./]+$", 1).alias("stem"),
        "text",
        "file",
    )


def numbered_lines(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """at (the file's address), ord (from 0, empty lines counted) and line of text files; LF, CRLF and CR end lines.

    Files are read in blocks, so a large one is dealt over tasks. A first pass counts the lines of each block without keeping
    them; a line's number is its place in its block plus the lines of the blocks before. Lines are not shuffled as long as the
    table of blocks is small enough for the planner to broadcast (its size is known, as it is written first). A file that
    changes between the passes is an error, unless its blocks keep their numbers of lines. No matching file: no rows.
    """
    raw = spark.read.text(root, recursiveFileLookup=True, pathGlobFilter=pattern)
    lines = raw.select(F.col("_metadata.file_path").alias("at"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    blocks = lines.groupBy("at", "block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("at").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stash(blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "blocks")
    place = F.col("_id") - F.col("_first")
    number = F.when((place >= 0) & (place < F.col("_n")), place + F.col("_before")).otherwise(F.raise_error(F.concat(F.lit("changed while it was read: "), "at")).cast("long"))
    return lines.join(blocks, ["at", "block"], "left").select("at", number.alias("ord"), "line")


def shards(spark: SparkSession, root: str, columns: Sequence[str], pattern: str = "shard-*.txt", least: int | None = None) -> DataFrame:
    """The tab-separated records of shard files with their file and line number; short records (below `least` fields) are left out.

    Only line ends are stripped, so empty fields at the end still count.
    """
    f = F.split("line", "\t", -1)
    rows = numbered_lines(spark, root, pattern).where((F.col("ord") > 0) & (F.col("line") != "") & (F.size(f) >= (least or 1)))
    return rows.select(F.regexp_extract(F.url_decode("at"), r"([^/]+)$", 1).alias("file"), "ord", *(F.get(f, F.lit(i)).alias(c) for i, c in enumerate(columns)))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated file with a header, all strings, no quoting."""
    return spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False)


def keep_known(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns that exist."""
    return rows.select(*(c for c in columns if c in rows.columns))


def drop_known(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.drop(*columns)


def rewrite(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Columns replaced by expressions, where they exist."""
    return rows.withColumns({c: e for c, e in rules.items() if c in rows.columns})


def repath(rows: DataFrame, old: str = "packs/", new: str = "text/") -> DataFrame:
    """The prefix replaced in every column but the first."""
    return rows.withColumns({c: F.regexp_replace(c, f"^{old}", new) for c in rows.columns[1:]})


def table_targets(docs: DataFrame, path: str | None = None, stem: str | None = None) -> DataFrame:
    """Law documents that refer to a table, with their header's fields (a chunk has those of its base) and whether they are done."""
    rows = docs.where(F.col("text").rlike(TABLE_REF))
    rows = rows.where(F.col("path") == path) if path else rows
    rows = rows.where(F.col("stem") == stem) if stem else rows
    rows = rows.withColumn("is_chunk", is_chunk("text")).withColumn("base", F.when(F.col("is_chunk"), F.regexp_extract("text", r"^--- split \d+/\d+ of (.+?)\.txt ---", 1)).otherwise(F.col("stem")))
    heads = docs.select("path", F.col("stem").alias("base"), parse("text").alias("h"))
    return rows.join(heads, ["path", "base"], "left").select(
        "path", "stem", "text", "is_chunk", *(F.coalesce(F.col(f"h.{c}"), F.lit("")).alias(c) for c in ("article", "egov_id", "law_num")), F.contains("text", F.lit(MARKER)).alias("already_done")
    )


def resolve(targets: DataFrame, ids: DataFrame, numbers: DataFrame, key: str = "path") -> DataFrame:
    """source and mode of each target: the header's id, the id table, the number table, the header's number; else unknown.

    ids (key, id) and numbers (key, num) are tables of laws, one row for each law; the planner broadcasts them if they are small.
    """
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    rows = targets.join(ids, key, "left").join(numbers, key, "left")
    source = F.when(has("egov_id"), F.col("egov_id")).when(has("id"), F.col("id")).when(has("num"), F.col("num")).when(has("law_num"), F.col("law_num")).otherwise(F.lit(""))
    mode = F.when(has("egov_id") | has("id"), "v2").when(has("num") | has("law_num"), "v1").otherwise("unknown")
    return rows.withColumns({"source": source, "mode": mode}).drop("id", "num")


def landed_batches(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """key, batch and tree of files that an ingest job has put into a folder for each batch, named by key (percent-encoded)."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
    at = F.url_decode(F.col("_metadata.file_path"))
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    return raw.select(F.url_decode(F.replace(F.url_decode(name), F.lit(suffix), F.lit(""))).alias("key"), F.regexp_extract(at, r"([^/]+)/[^/]+$", 1).alias("batch"), F.col("value").alias("tree"))


def landed(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """key and tree of files that an ingest job has put into a folder, named by key (percent-encoded)."""
    return landed_batches(spark, path, suffix).select("key", "tree")


def newest(answers: DataFrame, wanted: DataFrame, valid: Column | None = None) -> DataFrame:
    """key, batch, tree and reason for each distinct key of `wanted`: the answer of the last batch that isn't empty.

    answers: key, batch (later ones sort later), tree. A key has a row in any case; reason is null where its tree is
    there, `absent` where nothing has landed, `empty` where all that has landed is null or blank, `unreadable` where
    the newest tree isn't `valid` (batch names where it lies; tree is null, older ones don't stand in). Two
    answers for a key in one batch: the greater text. A null key is absent. Answers are reduced before they are shuffled,
    so a key that has landed many times is no hot key.
    """
    said = F.when(F.col("tree").rlike(r"\S"), F.struct("batch", "tree"))
    best = answers.where("key IS NOT NULL").groupBy("key").agg(F.max(said).alias("_b"), F.lit(True).alias("_landed"))
    rows = wanted.select("key").distinct().join(best, "key", "left").select("key", F.col("_b.batch").alias("batch"), F.col("_b.tree").alias("tree"), "_landed")
    there = F.col("tree").isNotNull()
    bad = there & ~F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(False)
    reason = F.when(bad, "unreadable").when(there, None).when(F.col("_landed"), "empty").otherwise("absent")
    return rows.select("key", "batch", F.when(~bad, F.col("tree")).alias("tree"), reason.alias("reason"))


def json_documents(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """JSON documents: one a file, of any number of lines, or one a line."""
    return spark.read.json(path, multiLine=whole_files)


def json_records(spark: SparkSession, path: str, schema: str = "db string, path string, stem string, text string") -> DataFrame:
    """JSON records, one a line, with `broken`: the line itself where it is no record of the schema, else null.

    A broken line keeps its row, so a check can list it: its text is null, its path the file's name, its stem the line's hash.
    """
    rows = spark.read.schema(f"{schema}, broken string").option("columnNameOfCorruptRecord", "broken").json(path)
    file = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    bad = F.col("broken").isNotNull()
    return rows.withColumns({"path": F.when(bad, file).otherwise(F.col("path")), "stem": F.when(bad, F.sha2("broken", 256)).otherwise(F.col("stem")), "text": F.when(~bad, F.col("text"))})


def xml_records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """XML elements of the tag as rows, with `broken`: the element itself where it is malformed, else null (its columns are null then).

    Files are cut behind each closing tag while they are read, so a large file is dealt over tasks, and a malformed element
    takes none of those after it along (Spark's own reader of row tags ends at the first). Attributes are columns named with
    an underscore before; text keeps white space around it. Elements may close themselves, not lie in one another; closing tags
    hold no blanks. What lies between elements is no record; an element cut off by the end of its file is broken, unless
    nothing but its closing tag is missing.
    """
    end = f"</{tag}>"
    start = rf"<{re.escape(tag)}[\s/>]"
    elements = F.filter(F.split(F.concat("value", F.lit(end)), f"(?={start})", -1), lambda x: x.rlike(f"^{start}"))
    rows = spark.read.option("lineSep", end).text(path).select(F.explode(elements).alias("_x"))
    options = {"rowTag": tag, "columnNameOfCorruptRecord": "broken", "ignoreSurroundingSpaces": "false"}
    return rows.select(F.from_xml("_x", f"{schema}, broken string", options).alias("_r")).select("_r.*")


def quarantined(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good records, and the broken ones as they were read: path, stem, broken."""
    return rows.where("broken IS NULL").drop("broken"), rows.where("broken IS NOT NULL").select("path", "stem", "broken")


class RateLimiter:
    """Spaces calls of an ingest job on the driver; never used inside a query."""

    def __init__(self, seconds: float = 1.5, clock=time.monotonic, sleep=time.sleep) -> None:
        self.seconds, self.clock, self.sleep, self.last = seconds, clock, sleep, None

    def wait(self) -> float:
        now = self.clock()
        pause = 0.0 if self.last is None else max(0.0, self.last + self.seconds - now)
        if pause:
            self.sleep(pause)
        self.last = self.clock()
        return pause
