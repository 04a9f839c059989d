"""Stores and running numbers: what a run leaves behind, landed trees, groups spread over partitions, packing against a loop."""

import random
import re
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from loomtext import scratch
from loomtext.operators import chunking, packing, tables, tree
from loomtext.sources import corpus, sinks


def test_fewer_shards_leave_no_old_ones(spark, tmp_path):
    out = str(tmp_path / "s")
    for n in (12, 3):
        rows = spark.createDataFrame([(f"shard-{i:02d}.txt", i, f"v{n}") for i in range(n)], "file string, ord int, x string")
        sinks.write_shards(rows, ["x"], out, ["ord"])
    assert sorted((r["file"], r["text"]) for r in spark.read.parquet(out).collect()) == [(f"shard-{i:02d}.txt", "x\nv3\n") for i in range(3)]


def test_files_follow_tasks_not_shards(spark, tmp_path):
    out = tmp_path / "s"
    rows = spark.range(400).select(F.format_string("shard-%03d.txt", F.col("id")).alias("file"), F.col("id").alias("ord"), F.lit("v").alias("x"))
    sinks.write_shards(rows, ["x"], str(out), ["ord"])
    assert [p for p in out.iterdir() if p.is_dir()] == [] and len(list(out.glob("*.parquet"))) <= 4
    assert sorted((r["file"], r["text"]) for r in spark.read.parquet(str(out)).collect()) == [(f"shard-{i:03d}.txt", "x\nv\n") for i in range(400)]


def test_dry_runs_write_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("shard-00.txt", 0, "x", "a", "t")], "file string, ord int, x string, db string, stem string")
    sinks.write_shards(rows, ["x"], str(tmp_path / "a"), ["ord"], dry_run=True)
    sinks.write_documents(rows.withColumn("text", F.lit("y")), str(tmp_path / "b"), dry_run=True)
    assert not list(tmp_path.iterdir())


def _with(spark, **settings):
    """Sets options and returns the ones to put back."""
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return old


def test_lines_of_many_blocks_equal_a_loop(spark, tmp_path):
    r = random.Random(4)
    want = {}
    for name, n in (("shard-00.txt", 4000), ("shard 01%.txt", 300), ("shard-02.txt", 0), ("shard-03.txt", 1)):
        body = "".join(r.choice(["", "x", "\u00e9\t", "\u6cd5" * r.randint(1, 40), "\t\ty\t"]) + r.choice(["\n", "\n", "\r\n", "\r"]) for _ in range(n)) + r.choice(["", "last"])
        (tmp_path / name).write_bytes(body.encode())
        lines = re.split(r"\r\n?|\n", body)
        want |= {(name, i): x for i, x in enumerate(lines) if i < len(lines) - 1 or x}
    old = _with(spark, spark__sql__files__maxPartitionBytes="3000", spark__sql__files__openCostInBytes="10")
    try:
        lines = corpus.numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 8
        got = [(unquote(x["at"]).rsplit("/", 1)[1], x["ord"], x["line"]) for x in lines.collect()]
        assert len(got) == len(want) and {(f, i): x for f, i, x in got} == want
        rows = corpus.shards(spark, str(tmp_path), ["a", "b"], "shard-00.txt", least=2).collect()
        assert [(x["ord"], x["a"], x["b"]) for x in sorted(rows, key=lambda x: x["ord"])] == [(i, *x.split("\t")[:2]) for (f, i), x in sorted(want.items()) if f == "shard-00.txt" and i and "\t" in x]
    finally:
        _with(spark, **old)
    assert corpus.numbered_lines(spark, str(tmp_path), "none*.txt").count() == 0


def test_other_blocks_in_the_second_pass_are_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("some words\n" * 2000)
    old = _with(spark, spark__sql__files__maxPartitionBytes="3000", spark__sql__files__openCostInBytes="10")
    try:
        lines = corpus.numbered_lines(spark, str(tmp_path))
        _with(spark, spark__sql__files__maxPartitionBytes="5000")
        with pytest.raises(Exception, match="changed while it was read"):
            lines.collect()
    finally:
        _with(spark, **old)


def test_only_named_folders_are_read(spark, tmp_path):
    for db in ("law", "qa", "paper"):
        (tmp_path / db / "text" / "p").mkdir(parents=True)
        (tmp_path / db / "text" / "p" / "1.txt").write_text(db)
    got = corpus.documents(spark, str(tmp_path), dbs=["law", "qa", "none"])
    assert sorted((x["db"], x["path"], x["stem"], x["text"]) for x in got.collect()) == [("law", "p", "1", "law"), ("qa", "p", "1", "qa")]
    assert len(got.inputFiles()) == 2
    assert corpus.documents(spark, str(tmp_path)).count() == 3
    for bad in ([], ["*"], ["a,b"], [""]):
        with pytest.raises(ValueError):
            corpus.documents(spark, str(tmp_path), dbs=bad)


def test_landed_trees(spark, tmp_path):
    (tmp_path / "law%2F1.json").write_text('{"tag": "Law", "children": [{"tag": "Article", "attr": {"Num": "1"}, "children": []}]}')
    (tmp_path / "昭和.xml").write_text("<Law><Article Num='2'/></Law>")
    (tmp_path / "bad.json").write_text("{")
    json_, xml = corpus.landed(spark, str(tmp_path), ".json"), corpus.landed(spark, str(tmp_path), ".xml")
    assert {r["key"] for r in json_.collect()} == {"law/1", "bad"} and xml.first()["key"] == "昭和"
    assert [(r["key"], r["num"]) for r in tree.articles(json_.unionByName(xml)).orderBy("num").collect()] == [("law/1", "1"), ("昭和", "2")]


def test_json_documents_of_many_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "shards": [\n  {"file": "x"}\n ]\n}')
    assert corpus.json_documents(spark, str(tmp_path)).first()["shards"][0]["file"] == "x"


def test_numbers_and_merging_equal_a_loop(spark):
    r = random.Random(8)
    rows = [(r.choice(["a", "a", "a", "b", None]), i, r.choice([10, 199, 200, 500, None])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i int, t long").repartition(7)
    got = {x["i"]: x["ord"] for x in packing.numbered(df, ["g"], ["i"]).collect()}
    merged = {x["i"]: x["merged"] for x in packing.merge_small(df, ["g"], "i", "t").collect()}
    for g in ("a", "b", None):
        number = -1
        for k, (_, i, t) in enumerate(x for x in rows if x[0] == g):
            number += k == 0 or (t or 0) >= 200
            assert got[i] == k + 1 and merged[i] == number
    assert packing.numbered(df.limit(0), ["g"], ["i"]).count() == 0 and packing.merge_small(df.limit(0), ["g"], "i", "t").count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_spans_equal_a_loop_from_every_entry(seed):
    r = random.Random(seed)
    cap, head = r.choice([(30, 2), (12, 0), (5, 9)])
    last = max(cap, head)
    n = last - head + 2
    sizes = [r.choice([0, 1, 2, 5, 11, 40]) for _ in range(r.randrange(25))]
    spans = [packing._Span(0, -1), packing._Span(1, 0, grown=True)]
    for t in sizes:
        spans = packing._step(spans, n, t, cap, head)
    for entry in range(n):
        fill, opened = (-1 if entry == 0 else head + entry - 1), 0
        for t in sizes:
            if fill >= 0 and fill + t > cap:
                fill, opened = head, opened + 1
            elif fill < 0:
                fill = head
            fill += t
        s = [s for s in spans if s.start <= entry][-1]
        assert (s.value + (head + entry - 1 if s.grown else 0), s.opened) == (fill, opened)


def test_overflow_after_inserting_a_table(spark):
    body = "".join(f"[p{i}] 次の表 {'語' * 40}\n" for i in range(1, 16))
    limits = chunking.Limits(600, 560, 20, 100)
    rows = spark.createDataFrame([("law", "a", "law: x\n\n" + body), ("law", "b", "law: x\n\n[p1] none"), ("law", "c", "law: x\n\n[p1] 左の表")], "db string, stem string, text string")
    got = tables.insert_and_split(rows.withColumn("tables", F.array(*[F.lit("\n" + "| t |\n" * 30)] * 3)), limits).collect()
    by = {(r["base_id"], r["chunk_n"]): r for r in got}
    assert {(r["base_id"], r["status"]) for r in got} == {("a", "inserted"), ("b", "no_points"), ("c", "inserted")}
    assert by["a", 1]["chunk_total"] > 1 and by["b", 1]["text"] == "law: x\n\n[p1] none" and all(len(r["text"].encode()) // 3 <= 600 for r in got)
    assert sum(r["text"].count("| t |") for r in got if r["base_id"] == "a") == 90


def test_released_tables_are_gone(spark):
    kept, gone = scratch.stash(spark.range(3), "kept"), scratch.stash(spark.range(4), "gone")
    path = kept.inputFiles()[0].rpartition("/")[0], gone.inputFiles()[0].rpartition("/")[0]
    scratch.release(gone, gone)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path[0]).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)) for p in path]
    assert there == [True, False] and kept.count() == 3
