"""Writing: new versions of tables and files, never in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import tokens


def write_shards(packed: DataFrame, columns: Sequence[str], path: str, order: Sequence[str], dry_run: bool = False) -> DataFrame:
    """One tab-separated text per shard file, header first, as rows (file, text) of a table; returns file and text.

    The folder holds the shards of one collection and nothing else (indexes lie elsewhere): it is overwritten as a whole, so
    shards of an earlier run with more of them go. A shard holds no more than the token cap, so its lines fit a row.
    A folder for each shard would have the driver move, list and delete one for each 9,500 tokens; here the tasks decide
    how many files there are, and within these names are sorted, so a reader of one name skips what lies elsewhere.
    """
    line = F.concat_ws("\t", *(F.coalesce(c, F.lit("")) for c in columns))
    texts = packed.groupBy("file").agg(F.concat(F.lit("\t".join(columns) + "\n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, line.alias("_l")))), lambda x: x["_l"]), "\n"), F.lit("\n")).alias("text"))
    if not dry_run:
        texts.sortWithinPartitions("file").write.mode("overwrite").parquet(path)
    return texts


def changed(rows: DataFrame, new: Column, text: str = "text") -> DataFrame:
    """The rows whose text the expression changes, with the new text."""
    return rows.withColumn("_new", new).where(~F.col("_new").eqNullSafe(F.col(text))).withColumn(text, F.col("_new")).drop("_new")


def write_routing(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").json(path)


def routing_json(index: DataFrame) -> DataFrame:
    """One JSON text for each shard, null fields left out."""
    return index.select(F.to_json(F.struct(*index.columns)).alias("json"))


def write_documents(docs: DataFrame, path: str, by: Sequence[str] = ("db",), dry_run: bool = False) -> DataFrame:
    """Documents partitioned for later pruning; returns their sizes."""
    if not dry_run:
        docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return docs.select(*by, "stem", tokens("text").alias("tokens"))


def move_collections(docs: DataFrame, names: Mapping[str, str], path: str = "path", stem: str = "stem", text: str = "text") -> DataFrame:
    """Collections renamed, with doc_code: lines to match; a document whose target exists stays away."""
    new = F.col(path)
    for old, to in names.items():
        new = F.when(F.col(path) == old, F.lit(to)).otherwise(new)
    kept = docs.where(~F.col(path).isin(list(names)))
    body = F.col(text)
    for old, to in names.items():
        body = F.regexp_replace(body, f"(?md)^doc_code: {old}$", f"doc_code: {to}")
    moved = docs.where(F.col(path).isin(list(names))).withColumns({path: new, text: body})
    return kept.unionByName(moved.join(kept, [path, stem], "left_anti"))
