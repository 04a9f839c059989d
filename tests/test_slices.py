"""What Python functions hold at once: slices of a batch, nodes as they are walked."""

import pyarrow as pa
from pyspark.sql import functions as F

from loomtext.functions.slices import SLICE_BYTES, by_slices, cuts
from loomtext.operators import chunking, tables, tree


def test_a_function_sees_slices(spark):
    rows = spark.range(0, 60, 1, 1).select("id", F.repeat(F.lit("x"), 100_000).alias("t"), F.when(F.col("id") % 2 == 0, "y").alias("u"))
    held = lambda ts, us: [len(ts)] * len(ts)
    got = rows.select("id", by_slices(held, pa.int64(), "long", F.col("t"), F.col("u")).alias("n")).collect()
    assert sorted(r["id"] for r in got) == list(range(60)) and max(r["n"] for r in got) <= 10
    assert rows.limit(0).select(by_slices(held, pa.int64(), "long", F.col("t"), F.col("u"))).collect() == []
    assert list(cuts((pa.array(["a" * 9, None, "b" * 30, "c"]),), 10)) == [(0, 2), (2, 3), (3, 4)]


def test_split_by_slices_equals_each_document(spark):
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100)
    texts = {str(i): "\n".join(f"line {k} of {i}" for k in range(150 * (i % 5))) for i in range(2000)}
    rows = spark.createDataFrame([(k, "qa", t) for k, t in texts.items()], "stem string, db string, text string").coalesce(1)
    by = {}
    for r in chunking.split(rows, limits).collect():
        by.setdefault(r["base_id"], []).append((r["chunk_n"], r["text"]))
    assert {k: [t for _, t in sorted(v)] for k, v in by.items()} == {k: chunking.split_text(k, "qa", "", t, limits) for k, t in texts.items()}


def test_split_holds_a_slice_of_a_batch(spark, monkeypatch):
    most = SLICE_BYTES

    def only_a_slice(bodies, vocabulary):
        assert len(bodies) == 1 or sum(len(b.encode()) for b in bodies) <= most, f"{len(bodies)} documents at once"
        return [None] * len(bodies)

    monkeypatch.setattr(chunking, "known_sizes", only_a_slice)
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100)
    text = "\n".join(f"line {k}" for k in range(300))
    rows = spark.range(0, 3_000, 1, 1).select(F.col("id").cast("string").alias("stem"), F.lit("qa").alias("db"), F.lit(text).alias("text"))
    got = chunking.split(rows, limits)
    assert len(text) * 3_000 > 4 * SLICE_BYTES and got.select(F.count_distinct("base_id")).first()[0] == 3_000
    refer = rows.select("stem", "db", F.concat(F.lit("[p1] 次の表\n[p2] "), "text").alias("text"), F.array(F.lit("\n| t |\n| --- |\n| x |")).alias("tables"))
    got = tables.insert_and_split(refer, limits).where("chunk_n = 1 AND chunk_total > 1 AND status = 'inserted'")
    assert got.select(F.count_distinct("base_id")).first()[0] == 3_000


def test_nodes_leave_in_parts(spark):
    def tree_of(n):
        return '{"tag":"Law","children":[' + ",".join(['{"tag":"Article","attr":{"Num":"1"},"children":["x",{"tag":"Rt","children":["y"]}]}'] * n) + "]}"

    laws = spark.createDataFrame([(i, tree_of(n)) for i, n in enumerate((3_000, 0, 5_000, 1))] + [(8, None), (9, "broken")], "law int, tree string").coalesce(1)
    got = tree.nodes(laws, "law", "tree")
    assert {r["law"]: r["count"] for r in got.groupBy("law").count().collect()} == {0: 6_001, 1: 1, 2: 10_001, 3: 3}
    last = got.where("law = 3").orderBy("path").collect()
    assert [(r["path"], r["tag"], r["attr"], r["text"], r["in_supplement"]) for r in last] == [([0], "Law", {}, "", False), ([0, 0], "Article", {"Num": "1"}, "x", False), ([0, 0, 1], "Rt", {}, "y", False)]


def test_a_nodes_batch_is_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(['{"tag":"a","children":[' + ",".join(['{"tag":"b"}'] * 9_999) + "]}"])], ["law", "tree"])
    sizes = [b.num_rows for b in tree.listed([batch], "law")]
    assert max(sizes) == tree.NODE_ROWS and sum(sizes) == 10_000
