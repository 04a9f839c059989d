"""Versions of a collection, and the newest landed answers: runs that fail, pruning, nulls, ties and empty tables."""

import pytest
from pyspark.sql import functions as F

from loomtext.sources import corpus, sinks, versions


def _shards(spark, n, x):
    return spark.createDataFrame([(f"shard-{i:02d}.txt", i, x) for i in range(n)], "file string, ord int, x string")


def test_a_failed_run_leaves_the_old_shards_whole(spark, tmp_path):
    root = f"file://{tmp_path}/c"
    with pytest.raises(LookupError):
        versions.read(spark, root, "shards")
    with versions.draft(spark, root) as at:
        sinks.write_shards(_shards(spark, 3, "old"), ["x"], f"{at}/shards", ["ord"])
    fails = F.when(F.col("ord") < 2, F.col("x")).otherwise(F.raise_error(F.lit("executor lost")))
    with pytest.raises(Exception, match="executor lost"), versions.draft(spark, root) as at:
        sinks.write_shards(_shards(spark, 1, "new"), ["x"], f"{at}/more", ["ord"])
        sinks.write_shards(_shards(spark, 4, "new").withColumn("x", fails), ["x"], f"{at}/shards", ["ord"])
    old = versions.read(spark, root, "shards")
    assert sorted(r["text"] for r in old.collect()) == ["x\nold\n"] * 3
    with versions.draft(spark, root) as at:
        assert len(versions.published(spark, root)) == 1
        sinks.write_shards(_shards(spark, 2, "new"), ["x"], f"{at}/shards", ["ord"])
    first, last = versions.published(spark, root)
    assert sorted(r["text"] for r in versions.read(spark, root, "shards").collect()) == ["x\nnew\n"] * 2
    assert versions.read(spark, root, "shards", first).count() == old.count() == 3  # a plan made before still reads its own version


def test_pruning_keeps_the_newest_and_drafts_begun_later(spark, tmp_path):
    root = f"file://{tmp_path}/c"
    assert versions.published(spark, root) == [] == versions.prune(spark, root)
    made = []
    for i in range(4):
        with versions.draft(spark, root) as at:
            _shards(spark, i, "x").write.parquet(f"{at}/t")
            made.append(at.rsplit("/", 1)[1])
    open_draft = versions.draft(spark, root)
    later = open_draft.__enter__()
    assert versions.prune(spark, root, keep=2) == made[:2]
    assert versions.published(spark, root) == made[2:]
    _shards(spark, 9, "x").write.parquet(f"{later}/t")
    open_draft.__exit__(None, None, None)
    assert versions.read(spark, root, "t").count() == 9
    with pytest.raises(LookupError):
        versions.read(spark, root, "t", made[0])
    with pytest.raises(ValueError):
        versions.prune(spark, root, keep=0)


def test_newest_landed_files(spark, tmp_path):
    for batch, name, text in [("2024-01", "law%2F1", '{"v": 1}'), ("2024-02", "law%2F1", '{"v": 2}'), ("2024-01", "b", '{"v": 3}'), ("2024-02", "b", ""), ("2024-01", "c", " \n"), ("2024-01", "d", '{"v": 4}'), ("2024-02", "d", "{")]:
        (tmp_path / batch).mkdir(exist_ok=True)
        (tmp_path / batch / f"{name}.json").write_text(text)
    wanted = spark.createDataFrame([("law/1",), ("b",), ("b",), ("c",), ("d",), ("never",), (None,)], "key string")
    got = corpus.newest(corpus.landed_batches(spark, str(tmp_path), ".json"), wanted, valid=F.try_parse_json("tree").isNotNull())
    assert {r["key"]: tuple(r)[1:] for r in got.collect()} == {
        "law/1": ("2024-02", '{"v": 2}', None), "b": ("2024-01", '{"v": 3}', None), "c": (None, None, "empty"),
        "d": ("2024-02", None, "unreadable"), "never": (None, None, "absent"), None: (None, None, "absent"),
    }
    assert got.count() == 6


def test_newest_of_ties_and_empty_tables(spark):
    answers = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("a", "0", "z"), (None, "1", "n")] + [("hot", str(i % 7), str(i)) for i in range(500)], "key string, batch string, tree string")
    wanted = spark.createDataFrame([("a",), ("hot",)], "key string")
    assert {r["key"]: tuple(r)[1:] for r in corpus.newest(answers, wanted).collect()} == {"a": ("1", "y", None), "hot": ("6", max(str(i) for i in range(500) if i % 7 == 6), None)}
    assert {r["reason"] for r in corpus.newest(answers.limit(0), wanted).collect()} == {"absent"}
    assert corpus.newest(answers, wanted.limit(0)).count() == 0


def test_xml_records_of_broken_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?>\n<Laws>\n<Law Id="1"><T> a &amp; b\n</T></Law>\n<Law Id="2"><T>open</Law>\n<LawNum>9</LawNum><Law Id="3"/><Law Id="4"><T>第一</T></Law></Laws>\n')
    (tmp_path / "b.xml").write_text('<Law Id="5"><T>x</T></Law><Law Id="6"><T>cut o')
    (tmp_path / "c.xml").write_text("")
    got = corpus.xml_records(spark, str(tmp_path), "Law", "_Id string, T string").collect()
    assert sorted((r["_Id"], r["T"]) for r in got if r["broken"] is None) == [("1", " a & b\n"), ("3", None), ("4", "第一"), ("5", "x")]
    broken = sorted(r["broken"] for r in got if r["broken"] is not None)
    assert broken == ['<Law Id="2"><T>open</Law>', '<Law Id="6"><T>cut o</Law>']
    assert all(r["_Id"] is None or r["broken"] is None for r in got)
