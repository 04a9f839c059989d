"""A corpus through four stages: toxicity, quality, near copies, packing.

Defined results, for each of the first three stages: rows pass or go whole, with all their columns as they were, also ones
that the stage knows nothing of; null ids, null and empty texts are judged like others; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import ngramjoin, packing, quality, toxicity
from loomtext.llm.runtime import claim, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _judged(docs: DataFrame, labels: DataFrame, kind, keep: int) -> DataFrame:
    """The documents for which the classifier predicts `keep`; it learns from the labelled documents among them."""
    return kind.score_rows(docs, kind.fit(docs, labels)).where(F.col("predicted") == keep).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without those that the classifier takes for toxic.

    A null or empty text has no toxic word and stays; repeated rows are judged alike; without labels of both kinds all stay.
    """
    return _judged(docs, table(spark, sf_dir, "labels"), toxicity, 0)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier takes for good ones.

    A null or empty text has all features 0 and is judged by them; repeated rows are judged alike; without labels of both
    kinds all stay if half of those known, or none, are good.
    """
    return _judged(docs, table(spark, sf_dir, "labels"), quality, 1)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, a null id last; of repeated rows one.

    Null texts and texts without words are copies of nothing and all stay.
    """
    return ngramjoin.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences: a row for each piece. A null or empty text is its end id alone; repeated rows are packed each."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [("toxicity", drop_toxic), ("quality", keep_good), ("near_copies", drop_copies), ("packing", pack)]

# SQL can express neither classifier nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = claim(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
