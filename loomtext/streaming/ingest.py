"""Incremental ingest: new documents as a stream, issues and running counts as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loomtext.functions.text import tokens
from loomtext.operators.integrity import described, sizes


def documents(spark: SparkSession, path: str, schema: StructType | str, files_a_batch: int = 1000) -> DataFrame:
    """New Parquet files of documents in a folder, a bounded number in each batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def issues(docs: DataFrame) -> DataFrame:
    """Size issues of arriving documents: filters only, so no state is kept."""
    return sizes(described(docs))


def token_counts(docs: DataFrame, key: str) -> DataFrame:
    """Documents and tokens by key; the state has a row for each key."""
    return docs.groupBy(key).agg(F.count("*").alias("docs"), F.sum(tokens("text")).alias("tokens"))


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", size: str = "5 minutes") -> DataFrame:
    """Events by window and kind; state older than the watermark goes."""
    return events.withWatermark(time, late).groupBy(F.window(time, size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table what has arrived, then stop."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
