"""Frequent runs of letters as topics, and other summaries of shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CJK_RUN = r"[一-鿿぀-ゟ゠-ヿ]{2,6}"
LATIN_RUN = r"[A-Za-z]{2,6}"
# Words that are never topics.
STOP = "の に を は が と で た て する から まで について における による された される および 又は ある その この もの こと ため 等 及び 場合 規定 関する 係る 対する 取扱 課税 所得 税額 金額 法人税 所得税 消費税 相続税 に関する に係る".split()


def runs(rows: DataFrame, group: Sequence[str], record: str, text: str, pattern: str = CJK_RUN, stop: Sequence[str] = STOP) -> DataFrame:
    """group, topic, n and first (which orders by record and position): every run that is no stop word, counted."""
    each = rows.select(*group, F.col(record).alias("_rec"), F.posexplode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))).alias("_pos", "topic"))
    if stop:
        each = each.where(~F.col("topic").isin(list(stop)))
    kind = rows.schema[record].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        # one number for both, so that the aggregation can hash: a struct would have all runs sorted
        first = F.col("_rec").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("_pos").cast("decimal(11,0)")
    else:
        first = F.struct("_rec", "_pos")
    return each.groupBy(*group, "topic").agg(F.count("*").alias("n"), F.min(first).alias("first"))


def top(rows: DataFrame, group: Sequence[str], record: str, text: str, k: int = 8, pattern: str = CJK_RUN, stop: Sequence[str] = STOP) -> DataFrame:
    """The k most frequent runs of each group, ties by first occurrence: group, rank, topic, n."""
    w = Window.partitionBy(*group).orderBy(F.desc("n"), "first")
    return runs(rows, group, record, text, pattern, stop).withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k).select(*group, "rank", "topic", "n")


def top_list(rows: DataFrame, group: Sequence[str], record: str, text: str, **options) -> DataFrame:
    """group, topics: the same as an array in order."""
    ranked = top(rows, group, record, text, **options)
    return ranked.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "topic"))), lambda x: x["topic"]).alias("topics"))


def distinct_sorted(c: str | Column) -> Column:
    return F.sort_array(F.collect_set(c))


def countries(id_col: str) -> Column:
    """Sorted distinct prefixes before -- of the ids that hold it."""
    c = F.col(id_col)
    return F.sort_array(F.collect_set(F.when(F.contains(c, F.lit("--")), F.split_part(c, F.lit("--"), F.lit(1)))))


def id_range(id_col: str, order: str) -> Column:
    """first〜last in order."""
    return F.concat(F.min_by(id_col, order), F.lit("〜"), F.max_by(id_col, order))


def overflow(items: Column, k: int = 5, unit: str = "か国") -> Column:
    """The first k items, and how many more there are."""
    head = F.array_join(F.slice(items, 1, k), ", ")
    return F.when(F.size(items) > k, F.concat(head, F.lit(" 他"), (F.size(items) - k).cast("string"), F.lit(unit))).otherwise(head)


def token_stats(rows: DataFrame, db: str, before: Column, after: Column) -> DataFrame:
    """Documents, tokens before and after, and percent saved, by db and in total (null db)."""
    agg = rows.withColumns({"_b": before, "_a": after}).rollup(db).agg(F.count("*").alias("docs"), F.sum("_b").alias("tokens_before"), F.sum("_a").alias("tokens_after"))
    return agg.withColumn("saved_pct", F.coalesce(F.try_divide((F.col("tokens_before") - F.col("tokens_after")) * F.lit(100.0), F.col("tokens_before")), F.lit(0.0)))
