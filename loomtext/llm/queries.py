"""The queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import bpe, crosstokens, curves, neardup, ngramjoin, packing, pagetext, quality, sharding, spelling, tokenfiles, toxicity, windows
from loomtext.llm.runtime import remainder, table


def op1_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), ["n_tokens", "ids_sha256", "decoded_sha256"])


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read(tokenfiles.write(table(spark, sf_dir, "documents"))).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.Tree.of(24)
    return sharding.shard(table(spark, sf_dir, "documents"), tree, tree.grow())


def _judged(spark: SparkSession, sf_dir: str, kind, modulus: int, out: int) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = kind.fit(docs, labels.where(remainder("doc_id", modulus) != out))
    return kind.score(docs, model).select("doc_id", (remainder("doc_id", modulus) == out).alias("held_out"), "score", "predicted")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, toxicity, 5, 0)


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.join(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, quality, 3, 1)


def op11_crosstokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstokens.digests(crosstokens.align(table(spark, sf_dir, "documents")))


def op12_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.pack(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_curves, op2_ngram_join, op3_bpe, op4_page_text, op5_token_files, op6_sharding, op7_toxicity, op8_neardup, op9_packing, op10_quality, op11_crosstokens, op12_windows, op13_spelling)
}
