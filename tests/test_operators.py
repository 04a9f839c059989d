"""Worked examples and properties of the operators."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import chunking, headers, integrity, packing, pages, routing, tables, topics, tree
from loomtext.sources import corpus, sinks


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expr.alias("x")).first()["x"]


# packing


@pytest.mark.parametrize("sizes, cap, head, bins", [([4, 4, 4, 9, 1], 9, 1, [0, 0, 1, 2, 3]), ([20, 1], 9, 1, [0, 1]), ([1, 20, 1], 9, 0, [0, 1, 2]), ([0, 0, 0], 0, 0, [0, 0, 0])])
def test_pack_examples(spark, sizes, cap, head, bins):
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(sizes)], "g string, i int, t long")
    got = packing.pack(df, ["g"], ["i"], F.col("t"), cap, head).orderBy("i").collect()
    assert [r["shard"] for r in got] == bins


def test_pack_equals_a_loop_across_partitions(spark):
    import random

    r = random.Random(5)
    rows = [(f"g{r.choice('aaab')}", i, r.choice([0, 1, 3, 7, 40, 120])) for i in range(3000)]
    got = {(x["g"], x["i"]): x["shard"] for x in packing.pack(spark.createDataFrame(rows, "g string, i int, t long"), ["g"], ["i"], F.col("t"), 100, 2).collect()}
    for g in ("ga", "gb"):
        cur = shard = None
        for _, i, t in sorted(x for x in rows if x[0] == g):
            if cur is None:
                cur, shard = 2, 0
            elif cur + t > 100:
                cur, shard = 2, shard + 1
            cur += t
            assert got[g, i] == shard


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], "g string, i int, t long"), ["g"], ["i"], F.col("t")).count() == 0


@pytest.mark.parametrize("n, names", [(3, ["shard-00.txt", "shard-02.txt"]), (120, ["shard-000.txt", "shard-119.txt"])])
def test_shard_names(spark, n, names):
    got = spark.range(n).select(X.shard_name("shard", F.col("id"), F.lit(n)).alias("x"))
    assert [r["x"] for r in got.collect() if r["x"] in names] == names


# topics


def test_topic_runs_are_greedy(spark):
    df = spark.createDataFrame([("g", 1, "法人税法の規定によるabc減価償却資産耐用")], "g string, i int, t string")
    assert {r["topic"] for r in topics.runs(df, ["g"], "i", "t").collect()} == {"法人税法の規", "定による", "減価償却資産", "耐用"}


def test_overflow(spark):
    assert one(spark, topics.overflow(F.array(*map(F.lit, "abcdefg")))) == "a, b, c, d, e 他2か国"


# headers


@pytest.mark.parametrize("text, header, body", [("a\nb\n\nbody", "a\nb\n\n", "body"), ("\nx", "", "\nx"), ("no end", "", "no end"), ("a\n\n", "a\n\n", "")])
def test_split_blank(spark, text, header, body):
    assert tuple(one(spark, headers.split_header("t", "blank"), t=text)) == (header, body)


def test_split_yaml(spark):
    assert tuple(one(spark, headers.split_header("t", "yaml_or_blank"), t="---\nid: 1\n---\nbody\n---\n")) == ("---\nid: 1\n---\n", "body\n---\n")


def test_trims(spark):
    assert one(spark, headers.trim_law("t", "https://site"), t="law: x / egov_id:  / as_of: y\nurl: https://site/z\nurl: http://other") == "law: x / as_of: y\nurl: http://other"
    assert one(spark, headers.trim_tsutatsu("t"), t="item: 1 / id: X / title: T\nsnapshot: s\nb") == "item: 1 / title: T\nb"
    assert one(spark, headers.trim_treaty("t"), t='---\nid: 1\nurl: u\npid: "all"\n---\nurl: stays') == "---\nid: 1\n---\nurl: stays"
    assert one(spark, headers.trim_hanketsu("t"), t="---\nsource:\n  a: 1\n  b: 2\nlaws: []\nid: 3\n---\nx") == "---\nid: 3\n---\nx"
    assert one(spark, headers.trim_qa("t"), t="doc_title: d\nq: 1\n---\n法令等\na\nb\nc\nbody") == "q: 1\n---\nbody"
    assert one(spark, headers.trim(F.lit("beppyo"), F.col("t")), t="url: x") == "url: x"


def test_parse_takes_the_last_match(spark):
    assert tuple(one(spark, headers.parse("t"), t="article: 1\nlaw_num: 昭和 / egov_id: 3A\narticle: 66-6 / x")) == ("66-6", "3A", "昭和")


def test_item_ids(spark):
    assert [one(spark, X.item_id("t"), t=t) for t in ("1−1−6", "42の12の4−3", "1の3・1の4共−1", "1－2")] == ["1-1-6", "42-12-4-3", "1-3_1-4_common-1", "1-2"]


# chunking


def test_cut_examples():
    unit = lambda *n: ("".join("x" * (3 * k - 1) + "\n" for k in n))
    levels = lambda b: [[], [], [i + 1 for i, c in enumerate(b) if c == "\n" and i + 1 < len(b)]]
    sizes = lambda b: [len(c) // 3 for c in chunking.cut(b, 6, levels(b))]
    assert sizes(unit(5, 3, 3)) == [5, 3, 3]
    assert sizes(unit(3, 3, 3)) == [6, 3]


def test_merge_example():
    assert [len(c) // 3 for c in chunking.merge_small(["x" * 3 * n for n in (900, 150, 900, 199, 200)])] == [1050, 1099, 200]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\n[p1]é ", max_size=60), max_size=30).map("\n".join), st.sampled_from(["law", "paper", "qa"]))
def test_chunks_concatenate_to_the_body(body, db):
    assert "".join(chunking.cut(body, 9, chunking.boundaries(body, db))) == body


def test_split_and_unsplit(spark):
    body = "".join(f"[p{i}] " + "語" * 50 + "\n" for i in range(1, 40))
    df = spark.createDataFrame([("law", "a", "h: 1\n\n" + body), ("law", "b", "short"), ("law", "c", None)], "db string, stem string, text string")
    limits = chunking.Limits(600, 560, 20, 100)
    made = chunking.split(df, limits).cache()
    assert made.where("base_id = 'a'").count() > 2
    assert made.where("stem = 'a_2' AND chunk_n = 2 AND text LIKE '--- split 2/%'").count() == 1
    back = {r["base_id"]: r for r in chunking.unsplit(made).collect()}
    assert back["a"]["text"] == "h: 1\n\n" + body and back["a"]["missing"] == [] and back["b"]["text"] == "short"
    lost = {r["base_id"]: r for r in chunking.unsplit(made.where("NOT (base_id = 'a' AND chunk_n = 2)")).collect()}
    assert lost["a"]["missing"] == [2]


# tables, trees, pages


def test_expand():
    rows = [[("A", 2), ("B", 1)], [("C", 1), ("D", 1)]]
    assert tables.expand(rows, True) == [["A", "B"], ["A", "C"]]
    assert tables.expand(rows, False) == [["A", "B"], ["A", "C", "D"]]
    assert tables.expand([[("A", 1), ("B", 1)], [("C", 1)]], True)[1] == ["C", ""]
    assert tables.expand([], True) == []


def test_insert_places_as_many_as_both_have(spark):
    text = "h\n\n[p1] 次の表\n[p2] x\n[p3] 下の表"
    assert one(spark, tables.insert(F.lit(text), F.array(F.lit("\nT1\n"), F.lit("\nT2\n"), F.lit("\nT3\n")))) == "h\n\n" + tables.MARKER + "\n[p1] 次の表\nT1\n\n[p2] x\n[p3] 下の表\nT2\n"
    once = one(spark, tables.insert(F.lit(text), F.array(F.lit("T"))))
    assert one(spark, tables.insert(F.lit(once), F.array(F.lit("T")))) == once


def test_ruby_and_xml_tails():
    x = tree.parse("<a>x<Rt>r</Rt>y</a>")
    assert tree.text_of(x) == "xy" and tree.text_of(x, False) == "xry"
    assert tree.parse("{") is None and tree.parse(None) is None


def test_heading_keeps_wide_digits(spark):
    df = spark.createDataFrame([("u/x.htm", "３－１（趣旨）<br>本文")], "url string, html string")
    r = pages.items(df).first()
    assert (r["item_id"], r["title"], r["body"]) == ("３-１", "趣旨", "[p1] 本文")


# integrity, routing, sources, sinks


def test_issues(spark):
    rows = [("law", "p", "a", "x\n--- split 1/3 → next: a_2.txt ---\n"), ("law", "p", "a_2", "--- split 2/3 of a.txt ---\n" + "y" * 200), ("law", "p", "z_2", "--- split 2/2 of z.txt ---\n" + "y" * 200), ("law", "p", "e", "  "), ("law", "p", "u", "url: 1\n" + "y" * 200), ("law", "p", "n", None), ("law", "p", "b_2_3", "--- split 3/3 of b_2.txt ---\n" + "y" * 200)]
    found = {(r["check"], r["subject"]) for r in integrity.issues(spark.createDataFrame(rows, "db string, path string, stem string, text string")).collect()}
    assert {("missing_chunks", "p/a"), ("orphan_chunks", "p/z_2"), ("empty_files", "p/e"), ("trim_violations", "p/u"), ("read_error", "p/n"), ("double_split", "p/b_2_3")} <= found


def test_upsert_is_idempotent(spark):
    s = f"{routing.MARKER}\nx"
    first = one(spark, routing.upsert(F.lit("head\n"), F.lit(s)))
    assert one(spark, routing.upsert(F.lit(first), F.lit(s))) == one(spark, routing.upsert(F.lit("head"), F.lit(s)))


def test_read_and_write(spark, tmp_path):
    root = tmp_path / "c"
    (root / "law/text/kai").mkdir(parents=True)
    (root / "law/text/kai/1.txt").write_bytes("law: x\r\narticle: 1\r\n\r\n[p1] 次の表".encode())
    (root / "law/text/kai/shard-00.txt").write_text("id\tpid\nA\t1\nB\t\n\n")
    docs = corpus.documents(spark, str(root), "[0-9]*.txt")
    r = docs.first()
    assert (r["db"], r["path"], r["stem"]) == ("law", "kai", "1") and "\r" not in r["text"]
    assert corpus.table_targets(docs).first()["article"] == "1"
    got = corpus.shards(spark, str(root), ["id", "pid"], least=2).orderBy("ord").collect()
    assert [(x["id"], x["pid"]) for x in got] == [("A", "1"), ("B", "")]
    packed = spark.createDataFrame([("shard-00.txt", 1, "a", None)], "file string, ord int, x string, y string")
    out = str(tmp_path / "out")
    assert sinks.write_shards(packed, ["x", "y"], out, ["ord"]).first()["text"] == "x\ty\na\t\n"
    assert spark.read.parquet(out).count() == 1


def test_clean_index(spark):
    row = spark.createDataFrame([("b", [("data/shards/a.tsv", "u", "e")], [("1", "https://old/x", "e")])], "base_url string, shards array<struct<file: string, url: string, enhanced_url: string>>, docs array<struct<id: string, url: string, enhanced_path: string>>")
    r = routing.clean_index(row, "https://old").first().asDict(True)
    assert r == {"shards": [{"file": "shards/a.tsv"}], "docs": [{"id": "1", "url": None}]}


def test_rate_limiter():
    now, slept = [0.0], []
    limiter = corpus.RateLimiter(1.5, lambda: now[0], slept.append)
    limiter.wait()
    now[0] = 0.5
    limiter.wait()
    assert slept == [1.0]


def test_stream(spark, data, tmp_path):
    from loomtext.streaming import ingest

    rows = spark.read.parquet(f"{data}/documents.parquet").select(F.col("lang").alias("db"), F.col("source").alias("path"), F.col("doc_id").cast("string").alias("stem"), "text")
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.issues(ingest.documents(spark, str(tmp_path / "in"), rows.schema))
    ingest.start(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == integrity.sizes(integrity.described(rows)).count()
