"""Integrity checks over documents and chunks as one long table of issues.

Input: db, path, stem, text (null where a file could not be read). Each issue is listed; `counted` is what it adds to
the count of its check: 1, but 0 for all chunks of a lost base after the first, since a base is lost once. What a document shows by itself is one array that is
exploded, so the input is read once for all these checks; a base and its chunks meet in one grouping by path and stem, which
moves names and numbers only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.functions.text import first_lines, strip, tokens
from loomtext.operators.chunking import IS_CHUNK, MAX_TOKENS

# Severities of the checks.
CRITICAL = ("over_limit", "orphan_chunks", "missing_chunks", "annotation_mismatch", "double_split")
WARNING = ("empty_files", "tiny_files", "split_note_remnants", "trim_violations", "read_error")
# Header lines that a trimmed document no longer has, by db.
TRIM_PATTERNS = {
    "law": ["^url:"],
    "accounting": ["^url:", "^section:"],
    "guide": ["^url:", "^section:"],
    "tsutatsu": ["^url:", "^snapshot:"],
    "treaty": ["^url:", "^prev:", "^next:", "^section_id:", "^page_start:", "^page_end:"],
    "paper": ["^url:", "^prev:", "^next:", "^section_id:", "^page_start:", "^page_end:", "^para_count:"],
    "qa": ["^doc_title:", "^source_kind:"],
    "hanketsu": ["^summary_status:", "^summary_source:"],
}
TINY = 50


def described(docs: DataFrame) -> DataFrame:
    """With tokens, is_chunk, base (the stem without _N of a chunk), n (its number) and the note's numbers."""
    t = F.coalesce("text", F.lit(""))
    chunk = t.rlike(IS_CHUNK)
    number = lambda g: F.try_to_number(F.nullif(F.regexp_extract(t, r"--- split (\d+)/(\d+)", g), F.lit("")), F.lit("999999999")).cast("int")
    return docs.withColumns({
        "tokens": tokens(t),
        "is_chunk": chunk,
        "base": F.when(chunk, F.coalesce(F.nullif(F.regexp_extract("stem", r"^(.+)_(\d+)$", 1), F.lit("")), F.col("stem"))).otherwise(F.col("stem")),
        "n": F.when(chunk, F.try_to_number(F.nullif(F.regexp_extract("stem", r"^(.+)_(\d+)$", 2), F.lit("")), F.lit("999999999")).cast("int")),
        "note_n": number(1),
        "note_total": number(2),
        # a base's total is what its note for part 1 says, wherever that stands
        "base_total": F.try_to_number(F.nullif(F.regexp_extract(t, r"--- split 1/(\d+)", 1), F.lit("")), F.lit("999999999")).cast("int"),
    })


ISSUE = "struct<check: string, severity: string, subject: string, detail: string, counted: int>"


def _issue(check: str, detail: Column, path: Column | str = "path", stem: Column | str = "stem", counted: Column | None = None) -> Column:
    severity = "CRITICAL" if check in CRITICAL else "WARNING"
    return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.concat_ws("/", path, stem).alias("subject"), detail.cast("string").alias("detail"), (F.lit(1) if counted is None else counted).alias("counted"))


def _listed(*found: Column) -> Column:
    """The issues that are there, of columns of one issue or none."""
    return F.array_compact(F.array(*found))


def _shown(rows: DataFrame, found: Column) -> DataFrame:
    return rows.select("db", F.explode(found).alias("i")).select("i.check", "i.severity", "db", "i.subject", "i.detail", "i.counted")


def _of_row(most: int = MAX_TOKENS, tiny: int = TINY) -> Column:
    empty = strip(F.coalesce("text", F.lit(""))) == ""
    return _listed(
        F.when(F.col("tokens") > most, _issue("over_limit", F.col("tokens"))),
        F.when(empty & F.col("text").isNotNull(), _issue("empty_files", F.lit(""))),
        F.when((F.col("tokens") < tiny) & ~empty, _issue("tiny_files", F.col("tokens"))),
        F.when(F.col("text").isNull(), _issue("read_error", F.lit(""))),
        F.when(F.col("is_chunk") & F.col("n").isNull(), _issue("annotation_mismatch", F.lit("note but no number in the name"))),
        F.when(F.col("is_chunk") & F.col("stem").rlike(r"_\d+_\d+$"), _issue("double_split", F.lit(""))),
    )


def sizes(d: DataFrame, most: int = MAX_TOKENS, tiny: int = TINY) -> DataFrame:
    """Issues of single documents: sizes, unreadable ones, notes and names of chunks."""
    return _shown(d, _of_row(most, tiny))


def chunks(d: DataFrame) -> DataFrame:
    """Issues of bases and their chunks. A group is one document's files."""
    noted = F.coalesce("text", F.lit("")).rlike(r"--- split \d+/\d+")
    base = F.struct(F.col("base_total").alias("total"), "stem", noted.alias("noted"))
    groups = d.where("NOT is_chunk OR n IS NOT NULL").groupBy("db", "path", "base").agg(
        F.collect_list(F.when(~F.col("is_chunk"), base)).alias("bases"),
        F.sort_array(F.collect_list(F.when(F.col("is_chunk"), F.struct("n", "stem", "note_n", "note_total")))).alias("parts"),
    )
    found = F.transform("parts", lambda p: p["n"])

    def of_base(b: Column) -> Column:
        total, own = b["total"], b["stem"]
        want = F.when(total >= 2, F.sequence(F.lit(2), F.greatest(total, F.lit(2)))).otherwise(F.array().cast("array<int>"))
        wrong = F.filter("parts", lambda p: ~(p["note_n"].eqNullSafe(p["n"]) & p["note_total"].eqNullSafe(total)))
        said = lambda p: F.concat(F.lit("note "), F.coalesce(p["note_n"], F.lit(-1)), F.lit("/"), F.coalesce(p["note_total"], F.lit(-1)), F.lit(" expected "), p["n"], F.lit("/"), total)
        with_parts = F.concat(
            _listed(
                F.when(total.isNotNull() & (found != want), _issue("missing_chunks", F.concat(F.lit("expected "), F.array_join(want, ","), F.lit(" found "), F.array_join(found, ",")), stem=own)),
                F.when(total.isNull(), _issue("annotation_mismatch", F.lit("chunks but no note in base"), stem=own)),
            ),
            F.when(total.isNotNull(), F.transform(wrong, lambda p: _issue("annotation_mismatch", said(p), stem=p["stem"]))).otherwise(F.array().cast(f"array<{ISSUE}>")),
        )
        return F.when(F.size("parts") > 0, with_parts).otherwise(_listed(F.when(b["noted"], _issue("split_note_remnants", F.lit(""), stem=own))))

    orphans = F.transform("parts", lambda p, i: _issue("orphan_chunks", p["n"], stem=p["stem"], counted=(i == 0).cast("int")))
    return _shown(groups, F.when(F.size("bases") == 0, orphans).otherwise(F.flatten(F.transform("bases", of_base))))


def _with_lines(d: DataFrame, n: int = 30) -> DataFrame:
    return d.withColumn("_lines", F.transform(first_lines(F.coalesce("text", F.lit("")), n), strip))


def _trimmed() -> Column:
    """One issue for each pattern of the row's db that one of its lines matches."""
    def of(p: str) -> Column:
        hit = F.filter("_lines", lambda x: x.rlike(p))
        return F.when(F.size(hit) > 0, _issue("trim_violations", F.concat(F.lit(f"{p} "), F.substring(F.get(hit, F.lit(0)), 1, 60))))

    out = F.array().cast(f"array<{ISSUE}>")
    for db, ps in TRIM_PATTERNS.items():
        out = F.when(F.col("db") == db, _listed(*map(of, ps))).otherwise(out)
    return F.when(~F.col("is_chunk"), out).otherwise(F.array().cast(f"array<{ISSUE}>"))


def patterns(spark: SparkSession) -> DataFrame:
    """db, pattern: a table of fixed size."""
    return spark.createDataFrame([(db, p) for db, ps in TRIM_PATTERNS.items() for p in ps], "db string, pattern string")


def trims(d: DataFrame, table: DataFrame | None = None, n: int = 30) -> DataFrame:
    """One issue for each base and pattern that one of its first n lines matches; with a table (db, pattern) of the caller's own, its patterns."""
    if table is None:
        return _shown(_with_lines(d, n), _trimmed())
    ls = d.where("NOT is_chunk").join(table, "db").withColumn("_l", F.filter(F.transform(first_lines(F.coalesce("text", F.lit("")), n), strip), lambda x: F.rlike(x, F.col("pattern"))))
    return _shown(ls, _listed(F.when(F.size("_l") > 0, _issue("trim_violations", F.concat(F.col("pattern"), F.lit(" "), F.substring(F.get("_l", F.lit(0)), 1, 60))))))


def issues(docs: DataFrame) -> DataFrame:
    """check, severity, db, subject, detail, counted of everything wrong: one pass over the documents, one grouping of names and numbers."""
    d = described(docs)
    return _shown(_with_lines(d), F.concat(_of_row(), _trimmed())).unionByName(chunks(d))


def listing(found: DataFrame, n: int = 20) -> DataFrame:
    """The first n issues of each check, and how many more there are."""
    w = Window.partitionBy("check").orderBy("subject", "detail")
    count = found.groupBy("check").agg(F.count("*").alias("total"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).join(count, "check").withColumn("more", F.greatest(F.col("total") - n, F.lit(0)))


def counters(docs: DataFrame) -> DataFrame:
    """Files, bases, chunks and documents over the limit by db and in total (null db)."""
    d = described(docs)
    return d.rollup("db").agg(F.count("*").alias("files"), F.count_if(~F.col("is_chunk")).alias("bases"), F.count_if("is_chunk").alias("chunks"), F.count_if(F.col("tokens") > MAX_TOKENS).alias("over"))


def passed(found: DataFrame) -> DataFrame:
    """One row: whether no check is critical, and the counts of both severities."""
    of = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("counted"))), F.lit(0)).cast("long")
    return found.agg((of("CRITICAL") == 0).alias("passed"), of("CRITICAL").alias("critical"), of("WARNING").alias("warnings"))
