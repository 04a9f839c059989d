"""The ten operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import bpe, curves, neardup, ngramjoin, packing, pagetext, quality, sharding, tokenfiles, toxicity, wordscan
from loomtext.llm.runtime import components

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lamb mu nu xi omi pi rho sig tau ups phi chi psi omega".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    base = sentence(r, 120)
    near = [base.replace(" ", "\n", 1), base + " tail", "Head " + base, base.upper(), base.rsplit(" ", 9)[0]]
    rows = [(1, base), (2, base), (3, base), *((10 + i, t) for i, t in enumerate(near)), (30, None), (31, ""), (32, " \n\t"), (33, "one two"), (34, "One two"), (35, "x" * 30_000), (36, sentence(r, 6000)), (37, "it's <|endoftext|> déjà 漢字 😀　end  \n"), (38, "İstanbul Σίσυφος"), (None, "no id at all here"), (2, base), (40, base + " <|startoftext|>")]
    return rows + [(100 + i, sentence(r, r.randrange(3, 300))) for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", 1, 0.5, 2, "r", b"x") for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, score double, predicted int, row string, ids binary").repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# shared parts


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(5, 5), (7, 8), (8, 7)] + [(1000 + i, 1001 + i) for i in range(70)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for n in sorted(near):
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo += near[x]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def fuzz(n):
    r = random.Random(7)
    parts = ["'s", "'S", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", "　", "a", "the", " the", "ing", "12", "3", "²", "é", "漢", "😀", "!", "...", "<|endoftext|>", "x'sy", "'sam", "ß", "İ", "\r\n", "aaaa", "\x1c", "Á"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(n)] + ["", "a" * 5000, " " * 300]


@pytest.mark.parametrize("name, run", [(bpe.VOCABULARY, packing.encoder), (tokenfiles.VOCABULARY, tokenfiles.encoder)])
def test_encoders_equal_the_library(name, run):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path(name)
    lib = Tokenizer.from_file(path)
    for t, got in zip(fuzz(2000), run(path)(fuzz(2000)), strict=True):
        assert got.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


# 3


def test_bpe_equals_the_library(docs, texts, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.vocabulary_path())
    v = bpe.loaded(bpe.vocabulary_path())
    for t, got in zip(fuzz(3000), v.encode(fuzz(3000)), strict=True):
        want = lib.encode(t, add_special_tokens=False).ids
        assert got.tolist() == want, repr(t)
        assert v.decode(got) == lib.decode(want, skip_special_tokens=False)
    got = Counter(tuple(r) for r in bpe.encode_decode(docs, ["n_tokens", "ids_sha256", "decoded_sha256"]).collect())
    want = Counter()
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    assert bpe.encode_decode(none, ["ids"]).count() == 0
    back = bpe.decode(bpe.encode_decode(docs.where("doc_id = 37"), ["ids"])).first()
    assert back["text"] == dict(texts)[37]


def test_compatible_pairs_equal_merging():
    v = bpe.loaded(bpe.vocabulary_path())
    r = np.random.default_rng(2)
    ok = np.flatnonzero(v._sound)
    a, b = r.choice(ok, 4000), r.choice(ok, 4000)
    want = [v.merge(v.bytes_of[x] + v.bytes_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert v.compatible(a, b).tolist() == want
    assert v._merge_long(b"hello there general" * 9) == v._merge_short(b"hello there general" * 9)


# 5


def test_code_lengths_are_optimal_and_limited():
    r = np.random.default_rng(1)
    c = r.integers(0, 1000, 300) ** 2
    for limit in (9, 12, 20):
        n = tokenfiles.code_lengths(c, limit)
        used = n[n > 0].astype(float)
        assert n.max() <= limit and (n > 0).tolist() == (c > 0).tolist() and abs((2.0**-used).sum() - 1) < 1e-9
    import heapq

    heap = [(int(x), i) for i, x in enumerate(c) if x]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        x, y = heapq.heappop(heap), heapq.heappop(heap)
        cost += x[0] + y[0]
        heapq.heappush(heap, (x[0] + y[0], -1))
    assert (tokenfiles.code_lengths(c, 30).astype(int) * c).sum() == cost


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
def test_bits_round_trip(n):
    r = np.random.default_rng(n)
    ids = (r.zipf(1.3, n) % 5000).astype(np.int64)
    lengths = tokenfiles.code_lengths(np.bincount(ids, minlength=5001), 16)
    body = tokenfiles.write_file([1, None], np.array([n, 0]), ids, 7, lengths, tokenfiles.canonical(lengths))
    names, counts, back, before = tokenfiles.read_file(body)
    assert names == [1, None] and counts.tolist() == [n, 0] and back.tolist() == ids.tolist() and before == 7


def test_token_files(spark, docs, texts, none, tmp_path):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.vocabulary_path(tokenfiles.VOCABULARY))
    files = tokenfiles.write(docs, str(tmp_path / "t"))
    got = tokenfiles.entries(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in texts), key=lambda i: (i is not None, i))
    start, want = 0, Counter()
    for i, t in texts:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    for r in got:
        assert r["start"] == start and len(r["ids"]) == r["n_tokens"]
        start += r["n_tokens"]
    assert tokenfiles.export_files(files, str(tmp_path)) == files.count()
    assert tokenfiles.read(tokenfiles.write(none)).count() == 0


# 6


def test_sharding(docs, texts, none):
    tree = sharding.Tree.of(24)
    got = sharding.shard(docs, tree, tree.grow()).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)
    assert len({r["shard"] for r in got if r["doc_id"] == 2}) == 1
    assert sharding.shard(none, tree).count() == 0


def test_weights_confine_movement(spark):
    rows = spark.range(20_000)
    tree = sharding.Tree.of(24)
    heavy = tree.reweigh(5, 3.0)
    got = rows.select(sharding.place(F.col("id"), tree).alias("a"), sharding.place(F.col("id"), heavy).alias("b"), sharding.place(F.col("id"), tree.grow()).alias("g"), sharding.place(F.col("id"), tree.grow().grow()).alias("h")).collect()
    counts = Counter(r["a"] for r in got)
    assert len(counts) == 24 and max(counts.values()) < 1.25 * 20_000 / 24
    # only the region, rack and shard whose weights grew gain rows
    assert all(r["b"] % 2 == 1 for r in got if r["a"] != r["b"])
    assert abs(sum(r["b"] == 5 for r in got) / 20_000 - 3 / 26) < 0.01
    assert {r["g"] for r in got if r["g"] != r["a"]} == {24} and {r["h"] for r in got if r["h"] != r["g"]} == {25}


# 9


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_a_packing(seed):
    r = random.Random(seed)
    counts = Counter(r.choice([r.randrange(1, 101), r.randrange(30, 60), 100]) for _ in range(2000))
    runs, bins = packing.plan(counts, 100)
    seen, fill = Counter(), defaultdict(list)
    for length, first, n, at, offset in runs:
        assert first == seen[length]
        seen[length] += n
        for i in range(n):
            fill[at + i].append((offset, length))
    assert seen == counts and set(fill) == set(range(bins))
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 100
    total = sum(k * v for k, v in counts.items())
    assert bins <= 1.25 * max(total / 100, sum(v for k, v in counts.items() if k > 50)) + 1
    assert packing.plan({}, 100) == ([], 0)


def test_pack(docs, texts, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.vocabulary_path())
    got = packing.pack(docs, keep_ids=True).collect()
    by = defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 2048
        by[r["doc_id"]].append(r)
    for i, t in texts:
        if sum(j == i for j, _ in texts) == 1:
            parts = sorted(by[i], key=lambda r: r["piece"])
            assert [x for r in parts for x in r["ids"]] == [*lib.encode(t or "", add_special_tokens=False).ids, 0]
            assert all(r["length"] == 2048 for r in parts[1:]) and [r["start"] for r in parts] == [sum(p["length"] for p in parts[:k]) for k in range(len(parts))]
    for s in {r["sequence_id"] for r in got}:
        parts = sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"])
        assert [r["offset"] for r in parts] == [sum(p["length"] for p in parts[:k]) for k in range(len(parts))]
    assert packing.pack(none).count() == 0


# 2


def brute_components(texts, n, num, den):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.setdefault(i, []).append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    flat = [(i, s) for i, ss in sets.items() for s in ss]
    label = list(range(len(flat)))
    for a in range(len(flat)):
        for b in range(a):
            x, y = flat[a][1], flat[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    least = {}
    for (i, _), v in zip(flat, label):
        if i is not None:
            least[v] = min(i, least.get(v, i))
    return Counter((i, len(s), least.get(v)) for (i, s), v in zip(flat, label))


@pytest.mark.parametrize("n, num", [(4, 85), (5, 80)])
def test_ngram_join(docs, texts, none, n, num):
    got = ngramjoin.join(docs, n, num, 100).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(texts, n, num, 100)
    assert ngramjoin.join(none, n, num, 100).count() == 0


def test_ngram_join_of_many_near_copies(spark):
    r = random.Random(11)
    base, rows = sentence(r, 150).split(), []
    for i in range(300):
        w = list(base)
        for _ in range(r.choice([1, 2, 4, 8])):
            w[r.randrange(150)] = f"new{r.randrange(9)}"
        rows.append((i, " ".join(w)))
    shared = sentence(r, 60)
    rows += [(1000 + i, shared + " " + sentence(r, 90)) for i in range(60)]
    got = ngramjoin.join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, 100).collect()
    assert Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == brute_components(rows, 4, 85, 100)


def test_rtree_finds_what_the_bound_allows():
    r = np.random.default_rng(0)
    points = r.integers(0, 5, (700, ngramjoin.GROUPS)).astype("<u2")
    points[350:] = points[:350]
    points[350:, :3] += 1
    n = points.sum(1).astype(np.int64)
    tree = ngramjoin.RTree(points, n)
    for i in range(0, 700, 70):
        near = ngramjoin._overlapping(points[i : i + 1], n[i : i + 1], points, n, 85, 100)[0] & (100 * np.minimum(n, n[i]) >= 85 * np.maximum(n, n[i]))
        assert sorted(tree.search(points[i].astype(np.int64), int(n[i]), 85, 100).tolist()) == np.flatnonzero(near).tolist()


def test_keep_one(docs, texts, none):
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is not None, i or 0))
    parts = brute_components(texts, 5, 80, 100)
    for wordless in (30, 31, 32):
        assert wordless in ids
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and 10 not in ids
    assert set(ids) >= {i for i, _, c in parts if i == c and c is not None}
    assert ngramjoin.keep_one(none).count() == 0


# 1 and 8


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((900, 16))
    x[100:130] = x[0] + 0.02 * r.standard_normal((30, 16))
    x[200:240] = x[1] * r.uniform(0.5, 2, (40, 1)) + 0.25 * r.standard_normal((40, 16))
    x[300:320] = x[2]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [float("nan")] + [1.0] * 15, 0), (2004, [None] + [1.0] * 15, 0), (2005, [float("inf")] * 16, 0), (2006, [1.0, 2.0], 0), (300, rows[300][1], 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int").repartition(3)


def test_curves(vectors, spark):
    rows, df = vectors
    good = [(i, np.array(v)) for i, v, _ in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    got = defaultdict(list)
    for r in curves.search(df, F.col("vec_id") % 100 == 0, 10).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i, _ in good if i % 100 == 0}
    for q in set(got) - {300}:
        x = dict(good)[q]
        d = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)[:10]
        assert [(k + 1, i) for k, (_, i) in enumerate(d)] == [(r, i) for r, i, _ in sorted(got[q])]
        assert np.allclose([s for _, _, s in sorted(got[q])], [s for s, _ in d], rtol=0, atol=1e-12)
    assert curves.search(df.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in curves.search(few, F.col("vec_id") == 0).collect()] == [(0, 1, 0.0)]


def test_curves_with_a_hot_group_of_copies(spark):
    r = np.random.default_rng(8)
    x = r.standard_normal((600, 8))
    x[100:400] = x[100]
    x[500:505] = x[100] + 0.01 * r.standard_normal((5, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for row in curves.search(df, F.col("vec_id") % 20 == 0, 10, share=0.05, least=20).collect():
        got[row["query_id"]].append((row["rank"], row["vec_id"]))
    for q in [*range(100, 400, 20), 500]:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(600), d)).tolist() if i != q][:10]
        assert [i for _, i in sorted(got[q])] == want
    assert set(got) == set(range(0, 600, 20)) and all(len(v) == 10 for v in got.values())


def test_hilbert_is_a_walk():
    cells = np.array(list(np.ndindex(8, 8, 8)))
    key = curves.hilbert(cells, 3)
    walk = cells[np.argsort(key)]
    assert sorted(key.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_neardup(vectors):
    rows, df = vectors
    links, n = defaultdict(set), len(rows)
    good = {k: np.array(v, float) for k, (_, v, _) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)}
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.9:
                links[a].add(b)
                links[b].add(a)
    seen, want = set(), Counter()
    for k in range(n):
        todo, part = [k], set()
        while todo:
            x = todo.pop()
            if x not in part:
                part.add(x)
                todo += links[x]
        least = min(rows[x][0] for x in part)
        want[rows[k][0], len(links[k]), least, rows[k][0] == least] += 1
        seen.add(k)
    assert Counter(tuple(r) for r in neardup.join(df).collect()) == want
    assert sum(len(x) for x in links.values()) > 1000
    assert neardup.join(df.limit(0)).count() == 0


# 4


def test_blocks():
    page = "<html><head><title>x</title></head><body><nav>m</nav><header><h1>H</h1></header><article><h1>T &amp; U</h1><p><b>a\n &nbsp; b<br><p>c <i>d</i> &lt;e&gt;<div class='comments'><p>bad</p></div><aside>no</aside><form>f</form><ul><li>1<li>2</ul><script>var t='</p>';</script></article><div class=\"cookie-notice\">n</div><footer>f"
    assert [t for t, _ in pagetext.blocks(page)] == ["T & U", "a b", "c d <e>", "1", "2"]
    assert pagetext.blocks("") == [] and pagetext.blocks("<p") == [] and pagetext.blocks("plain <b>text") == [("plain text", True)]
    assert pagetext.blocks("<p>x</p><p hidden>y</p><!-- z") == [("x", False)]


def test_repeated_runs_equal_brute_force():
    r = np.random.default_rng(4)
    streams = [r.integers(0, 3, r.integers(1, 40)).astype(np.uint64) for _ in range(25)]
    weights = r.integers(1, 3, 25).tolist()
    where = defaultdict(set)
    for i, s in enumerate(streams):
        for k in range(len(s) - 3):
            where[tuple(s[k : k + 4])].add(i)
    for i, (s, got) in enumerate(zip(streams, pagetext.repeated(streams, weights, 4, 9))):
        want = np.zeros(len(s), bool)
        for k in range(len(s) - 3):
            if sum(weights[j] for j in where[tuple(s[k : k + 4])]) >= 9:
                want[k : k + 4] = True
        assert got.tolist() == want.tolist()


def test_extract(spark):
    menu = "<div>Home News Sport Weather Travel Food Music Books Contact About</div>"
    rows = [(i, f"https://h.example/{i}", f"{menu}<span>unique words number {i}</span><p>{'same text ' * 9}</p>", "t") for i in range(5)]
    rows += [(9, None, None, "t"), (10, "x", "", "t"), (11, "https://other.example/", menu, "t"), (12, "https://h.example/a", "<article>" + "<p>" + "long " * 20_000 + "</p></article>", "t"), (12, "https://h.example/a", "<article><p>q</p>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["n_chars"]): r["text"] for r in pagetext.extract(df).collect()}
    texts = {i: t for (i, _), t in got.items()}
    assert texts[3] == "unique words number 3\n\n" + ("same text " * 9).strip()
    assert texts[9] == "" and texts[10] == "" and texts[11] == html.unescape(menu[5:-6])
    assert (12, 1) in got and (12, 99_999) in got
    assert pagetext.extract(df.limit(0)).count() == 0


def _pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in pagetext.extract(df).collect()}


def test_repeated_paragraphs_under_unknown_classes_go(spark):
    r = random.Random(6)
    body = {i: [sentence(r, 30), sentence(r, 40)] for i in range(12)}
    legal = "All rights reserved by the publisher and its partners in every country"
    box = f'<div class="legal-box"><p>{legal}</p><ul><li>Read us daily</li></ul></div>'
    shared = sentence(r, 20)  # three articles quote it
    rows = [(i, f"https://firm.example/{i}", f"<div><p>{body[i][0]}</p>{f'<p>{shared}</p>' if i < 3 else ''}<p>{body[i][1]}</p></div>{box}") for i in range(12)]
    got = _pages(spark, rows)
    for i in range(12):
        assert got[i] == "\n\n".join([body[i][0], *([shared] if i < 3 else []), body[i][1]])


def test_copies_and_shared_phrases_stay(spark):
    r = random.Random(7)
    copied, phrase = sentence(r, 40), sentence(r, 9)
    inside = lambda t: f"<article><div>{t}</div></article>"
    texts = {i: sentence(r, 30) + " " + phrase + " " + sentence(r, 30) if i < 14 else sentence(r, 50) for i in range(10, 50)}
    rows = [(i, f"https://art.example/{i}", inside(copied)) for i in range(4)]
    rows += [(i, f"https://art.example/{i}", inside(t) if i % 2 else t.replace(" ", "<br>", 2)) for i, t in texts.items()]
    rows += [(60 + i, "https://bare.example/x", copied) for i in range(4)]
    near = copied.split()
    rows += [(70 + i, "https://near.example/x", inside(" ".join([*near[:20], f"edit{i}", *near[20:]]))) for i in range(8)]
    got = _pages(spark, rows)
    assert all(got[i] == copied for i in (0, 1, 2, 3, 60, 61, 62, 63))
    assert all(got[i] == t for i, t in texts.items())
    assert all(got[70 + i].split() == [*near[:20], f"edit{i}", *near[20:]] for i in range(8))


# 7 and 10


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, i, x, b)
        return row[-1]

    def _next(row, i, x, b):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
        return out

    r = random.Random(2)
    words = ["".join(r.choice("abc") for _ in range(r.randrange(3, 7))) for _ in range(12)]
    a = toxicity.Automaton(words)
    for _ in range(3000):
        w = "".join(r.choice("abcd") for _ in range(r.randrange(1, 8)))
        best = min(distance(w, x) for x in words)
        got = a.find(w)
        assert (got[1] if got else 2) == min(best, 2)


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(9)
    rows = []
    for i in range(600):
        toxic = i % 4 == 0
        w = sentence(r, 40).split()
        if toxic:
            for _ in range(2):
                w[r.randrange(40)] = r.choice(["blockhead", "nitwit", "scoundrel"])
        good = i % 3 != 0
        rows.append((i, " ".join(w) if good else " ".join(f"{x} {x} {x} |" for x in w[:12]) + (" nitwit blockhead" if toxic else ""), int(toxic), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")


def test_toxicity(spark, judged, docs, none):
    labels = judged.select("doc_id", "toxic")
    model = toxicity.fit(judged, labels)
    assert {"blockhead", "nitwit", "scoundrel"} <= {*model.words, *model.stems} | {w for w in ("blockhead", "nitwit", "scoundrel") if any(w.startswith(s) for s in model.stems)}
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(judged, model).collect()}
    assert sum(got[r["doc_id"]] == r["toxic"] for r in judged.collect()) >= 598
    probe = spark.createDataFrame([(1, "you are a blokhead"), (2, "you sc0undrel"), (3, None), (4, ""), (5, "a fine day alpha1"), (6, 'they said "blockhead" once'), (7, "blockhead")], "doc_id long, text string")
    s = {r["doc_id"]: r for r in toxicity.score(probe, model).collect()}
    assert s[1]["predicted"] == 1 and s[2]["predicted"] == 1 and s[3]["predicted"] == s[4]["predicted"] == s[5]["predicted"] == 0
    assert s[3]["score"] == s[4]["score"] and s[6]["score"] < s[7]["score"] and 0 <= s[3]["score"] <= 1
    spans = toxicity.find(probe, model).where("doc_id = 6").first()
    assert spans["quoted"] and spans["term"] in ("blockhead", "block", "blockh", "bloc") and spans["errors"] == 0
    assert toxicity.score(none, model).count() == 0 and toxicity.score(docs, model).count() == docs.count()
    assert toxicity.fit(judged, labels.limit(0)).slope == 0.0


def test_misspelled_stems_and_short_words(spark):
    r = random.Random(12)
    forms = ["scoundrel" + x for x in ("", "s", "ly", "ish", "ism", "dom", "like", "ing", "ed", "ry")]
    rows = []
    for i in range(400):
        w = sentence(r, 30).split() + ["scam"] * (i % 8 == 1)
        if i % 4 == 0:
            w[3], w[9] = r.choice(forms), "scum"
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    judged = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(judged, judged.select("doc_id", "toxic"))
    assert any("scoundrel".startswith(s) for s in model.stems) and "scum" in model.words
    m = toxicity.Matcher(model)
    for w in ("sc0undrelish", "scundrels", "sccoundrel", "sc0undrelhood", "scumm", "5cum", "skum"):
        assert m.code(w) > 1, w
    assert m.code("scam") == 0 and all(m.code(w) == 0 for w in WORDS)


def test_harmless_spellings_have_no_cap_of_their_own(spark):
    r = random.Random(13)
    near = ["blockhea" + c for c in "lmnprst"]
    rows = [(i, sentence(r, 20) + (" blockhead" if i % 4 == 0 else " " + near[i % 7]), int(i % 4 == 0)) for i in range(200)]
    judged = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(judged, judged.select("doc_id", "toxic"), entries=1)
    assert list(model.words) == ["blockhead"] and set(near) <= model.harmless


def test_sample_ignores_labels_of_other_documents(spark, judged):
    labels = judged.select("doc_id", "toxic").union(spark.range(10_000, 20_000).selectExpr("id", "0"))
    assert toxicity.sample(judged, labels, "toxic", 100).count() == 100


def test_quality(judged, docs, none):
    labels = judged.select("doc_id", "quality")
    model = quality.fit(judged, labels)
    got = {r["doc_id"]: r["predicted"] for r in quality.score(judged, model).collect()}
    assert sum(got[r["doc_id"]] == r["quality"] for r in judged.collect()) >= 598
    assert len(model.pairs) == quality.PAIRS and len(model.tables) == len(quality.FEATURES)
    assert quality.score(none, model).count() == 0
    out = quality.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (30, 31)}) == 1
    lone = quality.fit(judged, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, lone).collect()} == {0.5}


def test_features_do_not_depend_on_neighbours(texts):
    own = [t or "" for _, t in texts]
    assert np.allclose(quality.features(own), np.vstack([quality.features([t]) for t in own]))
    f = dict(zip(quality.FEATURES, quality.features(["A a\na a | b7\nA a"])[0]))
    assert np.isclose(f["log_words"], np.log1p(8)) and np.isclose(f["distinct_words"], 4 / 8) and np.isclose(f["distinct_lines"], 2 / 3) and np.isclose(f["repeated_next"], 2 / 8)


# pipeline


def test_pipeline(spark, judged, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = judged.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    rows.union(rows.where("doc_id = 1").withColumn("doc_id", F.lit(9999).cast("long"))).write.parquet(str(tmp_path / "documents.parquet"))
    judged.select("doc_id", "quality", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = {r["doc_id"] for r in docs.collect()}
    clean = {r["doc_id"] for r in judged.where("toxic = 0 AND quality = 1").collect()}
    assert len(left ^ clean) <= 3 and 1 in left and 9999 not in left
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left


def test_slabs():
    assert list(wordscan.slabs(["a" * 10, "b" * 10, "c" * 30, ""], 20)) == [(0, 2), (2, 3), (3, 4)]
