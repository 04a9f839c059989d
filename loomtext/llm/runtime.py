"""What the operators of this subpackage share: tables, id remainders, scores of texts, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm.wordscan import small
from loomtext.scratch import claim, release, shared_folder, stash, width

__all__ = ["bit_map", "claim", "components", "marked", "release", "remainder", "scored", "shared_folder", "stash", "table", "width"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % modulus


def scored(docs: DataFrame, names: Sequence[str] | None, scorer: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """The columns `names` (null: all, as a struct `row`) and x, the score of the text; scorer() gives a task its function.

    Each text goes to Python once: with whole rows the function reads it inside the struct.
    """
    if names is None:
        src, own, text = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")), ["row"], lambda b: b.column("row").field("text")
    else:
        src, own, text = docs.select(*names, docs["text"].alias("_text")), list(names), lambda b: b.column("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in small(batches, text):
            x = score([t or "" for t in text(batch).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(x, pa.float64())], [*own, "x"])

    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in own), T.StructField("x", T.DoubleType())]))


SLOT_BITS = 24


def bit_map(rows: DataFrame, code: Column) -> np.ndarray:
    """A bit for the lowest bits of each row's code: 2 MB at any number of rows. Codes that share a bit only cost a check that a join then makes."""
    slot = code.bitwiseAND((1 << SLOT_BITS) - 1).alias("s")
    words = rows.select(slot).select(F.shiftright("s", 6).alias("w"), F.expr("shiftleft(1L, CAST(s & 63 AS INT))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << SLOT_BITS - 6, np.int64)
    for r in words.collect():
        out[r["w"]] = r["b"]
    return out.view(np.uint64)


def marked(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the bit of each code is set."""
    slot = codes & ((1 << SLOT_BITS) - 1)
    return ((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of `edges` reaches.

    Alternates large-star and small-star steps: every round is two groupings on a node id with
    map-side minima and one join whose hot side the adaptive planner may split. Labels stay in
    Spark; the driver sees only whether a round changed anything. Nodes without an edge are left out.
    Empty input gives no rows; repeated edges, self-edges and edges in both directions count once.
    """
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a <> b").distinct()
    e = stash(e, "edges")
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node links to the least of the node's neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # small star: a node and its smaller neighbours link to the least of them
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(floor, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, e = e, stash(linked.unionByName(floor.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        release(last)
        # nothing is left to do when the links are stars: no node has two, and none leads to a node that has one
        both = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if both.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
