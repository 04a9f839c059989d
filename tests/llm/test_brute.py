"""Whole operators against plain Python: scores, placements, recall, hashes that collide, pages that only repetition can tell apart."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.llm import bpe, curves, neardup, ngramjoin, packing, pagetext, quality, sharding, tokenfiles, toxicity, wordscan

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lamb mu nu xi omi pi rho sig tau ups phi chi psi omega".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


# hashes and pieces


def morse(n, swapped=False):
    s = "b" if swapped else "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s


@pytest.mark.parametrize("n", [1024, 4096])
@pytest.mark.parametrize("apart", [False, True])
def test_words_that_polynomials_confuse(n, apart):
    """Their sums of letters times powers are equal modulo 2 ** 64 for every odd base."""
    from tokenizers import Tokenizer

    texts = [morse(n), *(["x y " * 200_000] if apart else []), morse(n, True)]
    v = bpe.loaded(bpe.vocabulary_path())
    for run, name in ((v.encode, bpe.VOCABULARY), (packing.encoder(bpe.vocabulary_path()), bpe.VOCABULARY), (tokenfiles.encoder(bpe.vocabulary_path(tokenfiles.VOCABULARY)), tokenfiles.VOCABULARY)):
        lib = Tokenizer.from_file(bpe.vocabulary_path(name))
        assert [x.tolist() for x in run(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    a, b = ngramjoin.shingle_sets([texts[0], texts[-1]], 4)
    assert len(np.intersect1d(a, b)) == 0


def test_pieces_with_equal_hashes_keep_their_ids(monkeypatch):
    monkeypatch.setattr(wordscan, "hashes", lambda units, s, e: ((e - s) % 3).astype(np.uint64))
    coder = wordscan.PieceCoder(lambda pieces: [[ord(c) for c in p] for p in pieces])
    for text in ("ab cd efg ab cd xyz q", "cd ab hijkl ab x", "q"):
        words = text.split()
        cp, at = wordscan.points(words)
        flat, n = coder(cp, at[:-1], at[1:])
        assert "".join(map(chr, flat)) == "".join(words) and n.tolist() == list(map(len, words))


def test_little_room_changes_nothing():
    r = random.Random(4)
    words = [sentence(r, 1) for _ in range(3000)]
    cp, at = wordscan.points(words)
    small, large = (wordscan.PieceCoder(lambda pieces: [[len(p), ord(p[0])] for p in pieces], room) for room in (2000, 1 << 26))
    for a in range(0, 3000, 250):
        s, e = at[a : a + 250], at[a + 1 : a + 251]
        x, y = small(cp, s, e), large(cp, s, e)
        assert x[0].tolist() == y[0].tolist() and x[1].tolist() == y[1].tolist()


def test_known_pieces_are_found_without_sorting(monkeypatch):
    r = random.Random(6)
    words = ["", "\0", "\0\0", "a", "a\0", "\U0010ffff" * 4, "x" * 5000, *("".join(r.choice("abcdé東") for _ in range(r.randrange(12))) for _ in range(9000)), ""]
    cp, at = wordscan.points(words)
    packed, a, b = wordscan.triples(cp, at[:-1], at[1:])
    own = [tuple(packed[i:j].tolist()) for i, j in zip(a, b, strict=True)]
    assert len(set(own)) == len(set(words)) and all(len(x) == max(1, -(-len(w) // 3)) for x, w in zip(own, words, strict=True))
    for spoilt in (False, True):
        if spoilt:  # every hash begins its search at the same slot
            plain = wordscan.hashes
            monkeypatch.setattr(wordscan, "hashes", lambda units, s, e: plain(units, s, e) << np.uint64(24))
            words, (cp, at) = words[:800], wordscan.points(words[:800])
        asked = []
        coder = wordscan.PieceCoder(lambda pieces: asked.extend(pieces) or [list(map(ord, p)) for p in pieces])
        for n in (10, 300, len(words), len(words)):
            if len(asked) == len(set(words)):
                monkeypatch.setattr(np, "unique", None)
            flat, ids = coder(cp, at[:n], at[1 : n + 1])
            assert flat.tolist() == cp[: at[n]].tolist() and ids.tolist() == list(map(len, words[:n]))
        assert np.unique is None and sorted(asked) == sorted(set(words))
        monkeypatch.undo()


def test_small_batches_hold_all_rows():
    import pyarrow as pa

    texts = ["a" * n for n in (5, 0, 900, 3, 3, 3, 50, 1000)] + [None, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    parts = list(wordscan.small([batch, batch.slice(0, 0)], lambda b: b.column(1), 100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 100 for p in parts)


# 1


def test_recall_where_windows_prune(spark):
    """Noise and clusters, with production settings; no more than half of the rows are met by code, and few whole."""
    r = np.random.default_rng(3)
    n, dim = 10_000, 32
    x = r.standard_normal((n, dim))
    x[2000:6000] = r.standard_normal((40, dim))[r.integers(0, 40, 4000)] * 2 + 0.5 * r.standard_normal((4000, dim))
    x[7000:7400] = x[7000]  # one row of the curve, found whole
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = defaultdict(list)
    for row in curves.search(df, F.col("vec_id") % 100 == 0, 10).collect():
        got[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    hits = 0
    for q in range(0, n, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(n), d)).tolist() if i != q][:10]
        found = sorted(got[q])
        assert [k for k, _, _ in found] == list(range(1, 11))
        assert all(abs(s - d[i]) < 1e-12 for _, i, s in found) and [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(want))
        if 7000 <= q < 7400:
            assert [i for _, i, _ in found] == want
    assert hits >= 0.9 * n / 100 * 10
    classes = n - 399
    assert 2 * curves.window(classes, curves.WINDOW, 40) < 0.1 * classes and curves.SURVIVORS < 0.01 * classes


def test_runs_of_a_range_meet_its_queries():
    """Nearest by code within the window, whatever the runs are; values far apart in size stay in range."""
    r = np.random.default_rng(5)
    for scale in (1.0, 1e200):
        n, dim, w, most = 700, 8, 90, 12
        v = r.standard_normal((n, dim))
        spreads = {dim: np.column_stack([np.zeros(dim), np.full(dim, scale)])}
        codes = np.clip(np.floor(v @ curves.rotation(dim, 999) * (256 / curves._CODE_SPAN)) + 128, 0, 255).astype(np.uint8)
        back = (codes - 127.5) * (curves._CODE_SPAN / 256)
        at = sorted(r.choice(n, 150, replace=False).tolist())
        best = curves._Nearest([(p, np.int64(p).tobytes(), (v[p] * scale).tobytes()) for p in at], dim, w, most, spreads)
        a = 0
        while a < n:
            b = min(a + int(r.integers(1, 60)), n)
            best.meet(a, np.arange(a, b).tobytes(), codes[a:b].tobytes())
            a = b
        got = defaultdict(set)
        for q, row in zip(*(best.found().column(c).to_pylist() for c in ("query_row", "row")), strict=True):
            got[q].add(row)
        for p in at:
            near = [i for i in range(max(p - w, 0), min(p + w + 1, n)) if i != p]
            gap = ((v[p] @ curves.rotation(dim, 999) - back[near]) ** 2).sum(1)
            assert got[p] == {near[i] for i in np.argsort(gap)[:most]}
    assert curves.span(100) == curves.BLOCK and curves.span(10**9) == curves.SPAN_MOST


def test_members_of_keys_pass_in_any_batches():
    """Every member of a key with two or more, once, with the least; whatever the batches are."""
    r = np.random.default_rng(11)
    for _ in range(60):
        keys = np.sort(np.concatenate([r.integers(-9, 9, int(r.integers(0, 40))), np.full(int(r.integers(0, 60)), 3)]))
        cls = np.concatenate([np.sort(r.choice(1000, int((keys == k).sum()), replace=False)) for k in np.unique(keys)]) if len(keys) else np.zeros(0, np.int64)
        cuts = sorted(r.integers(0, len(keys) + 1, int(r.integers(0, 9))).tolist())
        parts = [pa.RecordBatch.from_arrays([pa.array(x[a:b].astype(np.int64)) for x in (keys, cls)], ["bucket", "class"]) for a, b in zip([0, *cuts], [*cuts, len(keys)])]
        got = [tuple(x.values()) for b in ngramjoin._runs(iter(parts)) for x in b.to_pylist()]
        want = [(k, c, cls[keys == k].min()) for k, c in zip(keys.tolist(), cls.tolist()) if (keys == k).sum() > 1]
        assert got == want


# 8


@pytest.mark.parametrize("cell_rows", [neardup.CELL_ROWS, 150])
def test_links_in_dense_groups(spark, monkeypatch, cell_rows):
    """Groups around the threshold, so dense that whole tiles are near, in one part and in many."""
    monkeypatch.setattr(neardup, "CELL_ROWS", cell_rows)
    r = np.random.default_rng(11)
    x = r.standard_normal((900, 16))
    x[:400] = x[0] + 0.3 * r.standard_normal((400, 16))
    x[400:500] = 2 * x[400] + 0.02 * r.standard_normal((100, 16))
    x[500:520] = x[500]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(900)
    while True:
        new = np.minimum(label, np.where(near, label, 900).min(1))
        if (new == label).all():
            break
        label = new
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in neardup.join(df).collect()}
    assert got == {i: (int(near[i].sum()), int(label[i]), int(label[i]) == i) for i in range(900)}
    assert 10_000 < near[:400, :400].sum() < 140_000


def test_dense_tiles_count_like_sparse_ones(monkeypatch):
    r = np.random.default_rng(12)
    v = r.standard_normal(16) + 0.3 * r.standard_normal((300, 16))
    side, home, n = r.integers(0, 2, 300), r.random(300) < 0.6, r.integers(1, 4, 300)
    for block in range(neardup.BLOCKS):
        for lo, hi in ((0, 0), (0, 1)):
            args = (block, 16, lo, hi, np.arange(300), n, home, side, v, 0.9)
            found = []
            for dense in (0, 10**9):  # never, always
                with monkeypatch.context() as m:
                    m.setattr(neardup, "DENSE", dense)
                    found.append(neardup._compare(*args)[0])
            assert found[0] == found[1] and found[0]


# 4


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in pagetext.extract(df).collect()}


@pytest.mark.parametrize("name", ["has-sidebar", "content-sidebar-wrap", "share", "side", "related"])
def test_wrappers_keep_their_text(name):
    page = f'<body><div class="{name}"><h1>Title</h1><p>one two three</p><p>four five</p><div class="sidebar"><p>menu</p></div></div><div class="comments"><p>{"remark " * 50}</p></div></body>'
    assert [t for t, _ in pagetext.blocks(page)] == ["Title", "one two three", "four five"]
    assert [t for t, _ in pagetext.blocks(f'<div class="{name}"><article><p>x</p></article></div><p>y</p>')] == ["x"]


def test_a_page_that_repeats_itself_keeps_it(spark):
    r = random.Random(21)
    run = sentence(r, 9)
    rows = [(0, "https://self.example/0", "".join(f"<div>{sentence(r, 20)} {run} {sentence(r, 20)}</div>" for _ in range(6)))]
    rows += [(i, f"https://self.example/{i}", f"<div>{sentence(r, 40)}</div>") for i in range(1, 9)]
    got = pages(spark, rows)
    assert got[0].count(run) == 6


def test_only_repetition_can_tell(spark):
    """Plain paragraphs without any class: a long notice in the middle of the page, and a short one; articles share no more than a quotation."""
    r = random.Random(22)
    long_, short, quote = sentence(r, 60), "Subscribe to our letter", sentence(r, 40)
    body = {i: [sentence(r, 50), sentence(r, 45)] for i in range(20)}
    rows = [(i, f"https://plain.example/{i}", f"<p>{body[i][0]}</p><p>{long_}</p>{f'<p>{quote}</p>' if i < 3 else ''}<p>{short}</p><p>{body[i][1]}</p>") for i in range(20)]
    got = pages(spark, rows)
    for i in range(20):
        assert got[i] == "\n\n".join([body[i][0], *([quote] if i < 3 else []), body[i][1]])


def test_segments_hold_every_run():
    r = random.Random(1)
    texts = [" ".join(r.choice("abcdef") + r.choice("12") for _ in range(r.randrange(1, 70))) for _ in range(60)]
    loose = np.array([r.random() < 0.5 for _ in texts])
    cut = pagetext.Segments(texts, loose)
    keys = {}
    for b, text in enumerate(texts):
        run, n = pagetext.RUN if loose[b] else pagetext.FIRM_RUN, len(text.split())
        own = [k for k in range(len(cut.block)) if cut.block[k] == b]
        spans = sorted((cut.stream(k)[0], cut.stream(k)[0] + len(cut.stream(k)[1])) for k in own)
        assert spans == [(0, run)] if n < run else spans[0][0] == 0 and spans[-1][1] == n and all(y[0] == x[1] - run + 1 for x, y in zip(spans, spans[1:]))
        for k in own:
            t = cut.stream(k)[1]
            for i in range(len(t) - run + 1):
                assert keys.setdefault((run, t[i : i + run].tobytes()), cut.key[k]) == cut.key[k]


# 6


def test_placement_equals_plain_python(spark):
    import xxhash

    def unit(key, name):
        h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        return ((xxhash.xxh64_intdigest(name.encode(), h) >> 12) + 0.5) / 2**52

    def winner(key, children):
        return min((-math.log(unit(key, name)) / weight, name, inner) for name, weight, inner in children)[2]

    def place(key, tree):
        racks = dict((r, ks) for r, ks in tree.regions.items())
        region = winner(key, [(r, sum(w for ss in ks.values() for w in ss.values()), r) for r, ks in racks.items()])
        rack = winner(key, [(k, sum(ss.values()), k) for k, ss in racks[region].items()])
        return winner(key, [(f"{rack}s{s}", w, s) for s, w in racks[region][rack].items()])

    tree = sharding.Tree.of(24).reweigh(3, 2.5)
    got = spark.range(-50, 1500).select("id", sharding.place(F.col("id"), tree).alias("a"), sharding.place(F.col("id"), tree.grow()).alias("b")).collect()
    assert all(r["a"] == place(r["id"], tree) and r["b"] == place(r["id"], tree.grow()) for r in got)


# 7 and 10


def near(a, b):
    """Whether one error makes a of b."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_toxicity(text, m):
    """The score by loops over words, entries and letters."""
    hits, said = 0.0, []
    words = [(x.start(), x.end()) for x in re.finditer(r"[^\W_]|[@$]", text)]
    spans = []
    for a, b in words:
        if spans and spans[-1][1] == a:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    for k, (a, b) in enumerate(spans):
        w = text[a:b].lower()
        plain = w.translate(toxicity.LOOKALIKE)
        stem = next((w[:n] for n in sorted({len(s) for s in m.stems}) if w[:n] in m.stems and len(w) >= n), None)
        weight = None
        if w in m.words:
            weight, errors = m.words[w], 0
        elif stem:
            weight, errors = m.stems[stem], 0
        elif w in toxicity.REPORTING:
            said.append(k)
        elif plain != w and plain in m.words:
            weight, errors = m.words[plain], 1
        elif w not in m.harmless:
            close = sorted((0 if x == plain else 1, x) for x in m.words if near(x, plain))
            if close:
                weight, errors = m.words[close[0][1]], 1
            else:
                stems = sorted((min(0 if plain[:n] == s else 1 for n in range(len(plain) + 1) if near(s, plain[:n])), s) for s in m.stems if any(near(s, plain[:n]) for n in range(len(plain) + 1)))
                if stems:
                    weight, errors = m.stems[stems[0][1]], 1
        if weight is not None:
            quoted = any(k - 3 <= j < k for j in said) or toxicity._in_quotes(text, a, b)
            hits += weight * (toxicity.FUZZY if errors else 1) * (toxicity.QUOTED if quoted else 1)
    x = 1 - math.exp(-hits / 3)
    return 1 / (1 + math.exp(-(m.intercept + m.slope * x)))


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(31)
    forms = ["villain" + x for x in ("", "s", "y", "ous", "ess", "ish", "ism", "like", "ery", "dom")]
    bad, rows = ["blockhead", "nitwit", "scum"], []
    for i in range(500):
        w = sentence(r, 30).split()
        if i % 4 == 0:
            w[3], w[9], w[20] = r.choice(bad), r.choice(forms), r.choice(bad)
        if i % 6 == 1:
            w[5:7] = ["scam", "said"]
        rows.append((i, " ".join(w), int(i % 4 == 0), int(i % 3 != 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")


def test_toxicity_equals_plain_python(spark, judged):
    model = toxicity.fit(judged, judged.select("doc_id", "toxic"))
    assert model.words and model.stems and model.harmless
    r = random.Random(32)
    seeds = [*model.words, *model.stems, *model.harmless, *toxicity.REPORTING, "villainous", "alpha7", "VILLAINY", "Bl0ckhead", "blokhead", "nitw1t", "skum", '"scum"', "«nitwit»", "word_word", "x@y$"]

    def bent(w):
        i = r.randrange(len(w) + 1)
        return r.choice([w, w, w[:i] + w[i + 1 :], w[:i] + r.choice("aeisx0") + w[i:], w[:i] + r.choice("aeisx0") + w[i + 1 :]])

    texts = [" ".join(bent(r.choice(seeds)) + r.choice(["", "", ".", '"', "\n"]) for _ in range(r.randrange(12))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate([*texts, None, "", "villain " * 3000])), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["score"] for x in toxicity.score(df, model).collect()}
    want = [plain_toxicity(t or "", model) for t in [*texts, None, "", "villain " * 3000]]
    assert np.allclose([got[i] for i in range(len(want))], want, atol=1e-12)
    assert len({round(s, 6) for s in want}) > 50


def test_contrary_labels_are_left_out(spark, judged):
    labels = judged.select("doc_id", "toxic").union(judged.where("doc_id < 100").selectExpr("doc_id", "1 - toxic"))
    got = toxicity.sample(judged, labels, "toxic")
    assert got.count() == 400 and got.where("doc_id < 100").count() == 0


def plain_features(text):
    kind = wordscan.classes()
    words, solid = text.split(), [c for c in text if kind[ord(c)] != wordscan.SPACE]
    words = [w for w in re.split("[" + re.escape("".join(map(chr, wordscan.WHITE))) + "]+", text) if w]
    lines = text.split("\n") if text else []
    if text.endswith("\n"):
        lines = lines[:-1]
    n, pairs = max(1, len(words)), list(zip(words, words[1:]))
    share = lambda k: sum(kind[ord(c)] == k for c in text) / max(1, len(solid))
    return [
        math.log1p(len(words)), len(solid) / n, len(set(words)) / n, sum(a == b for a, b in pairs) / n, len(set(lines)) / max(1, len(lines)),
        share(wordscan.LETTER), sum(c.isupper() for c in text if ord(c) < 0x3000) / max(1, len(solid)), share(wordscan.NUMBER), share(wordscan.OTHER),
        text.count("|") / n, sum(w[0].isupper() for w in words) / n, len(words) / max(1, len(lines)), len(set(pairs)) / max(1, len(words) - 1),
    ]


def test_quality_equals_plain_python(spark, judged):
    model = quality.fit(judged, judged.select("doc_id", "quality"))
    r = random.Random(33)
    texts = ["".join(r.choice(["A", "b ", "c|", "\n", " ", "dé ", "7", "Xx ", "漢", "b b "]) for _ in range(r.randrange(60))) for _ in range(300)] + ["", "\n", "a\n\nb", "word " * 5000]
    for t, row in zip(texts, quality.features(texts)):
        assert np.allclose(row, plain_features(t)), (t, dict(zip(quality.FEATURES, zip(row, plain_features(t)))))

    def score(t):
        f = plain_features(t)
        z = model.intercept + sum(table[sum(e <= x for e in edges)] for x, edges, table in zip(f, model.edges, model.tables))
        z += sum(table[sum(e <= f[i] for e in model.pair_edges[i])][sum(e <= f[j] for e in model.pair_edges[j])] for i, j, table in model.pairs)
        return 1 / (1 + math.exp(-z))

    got = {x["doc_id"]: x["score"] for x in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), model).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], [score(t) for t in texts], atol=1e-9)


# pipeline


def test_pipeline_stages_on_odd_rows(spark, judged, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    r = random.Random(34)
    judged.select("doc_id", "quality", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(i, t, "en", "s", 1, 0.5, 3, "row", "x") for i, t in [(900, None), (901, ""), (902, " \n"), (903, "word " * 40_000), (None, sentence(r, 30)), (904, sentence(r, 20)), (904, sentence(r, 20)), *[(905, "the same row twice here")] * 2]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, row string, _text string"
    extra = judged.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), F.lit(0.1).alias("score"), F.lit(7).alias("predicted"), F.lit("r").alias("row"), F.lit("t").alias("_text"))
    docs = spark.createDataFrame(rows, schema).union(extra).repartition(3)
    key = lambda x: (x["doc_id"], x["text"])
    before = Counter(map(tuple, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert not Counter(map(tuple, got)) - before, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        if name == "toxicity":
            assert {key(x) for x in got} >= {(i, t) for i, t, *_ in rows} and len(got) == sum(before.values()) - 125
        if name == "near_copies":
            assert sum(x["doc_id"] == 905 for x in got) == 1 and {900, 901, 902, 903} <= {x["doc_id"] for x in got} and sum(x["doc_id"] == 904 for x in got) == 2
    packed = corpus_pipeline.STAGES[3][1](spark, docs, str(tmp_path))
    assert Counter(x["doc_id"] for x in packed.where("piece = 0").collect()) == Counter(x[0] for x in before.elements())
    assert corpus_pipeline.STAGES[3][1](spark, docs.limit(0), str(tmp_path)).count() == 0
    assert zlib.crc32(np.array([0], "<u4").tobytes()) == packed.where("doc_id = 900").first()["ids_crc32"]


def test_spelling_merges_only_the_shortest_postings(monkeypatch):
    from loomtext.llm import spelling

    merged = []
    often = spelling._often
    monkeypatch.setattr(spelling, "_often", lambda postings, least: merged.append(len(postings)) or often(postings, least))
    words = sorted({"transformations"[:k] + x + "transformations"[k + cut :] for k in range(15) for cut in (0, 1) for x in ("", "a", "q", "ß")} | {"abcabcabc", "abcabcab", "aaaaaaa", "aaaaaa"})
    got = {frozenset((words[a], words[b])) for a, b in spelling.near_in_cell(words, [0] * len(words), 0, 0)}
    assert got == {frozenset((a, b)) for a in words for b in words if spelling.one_edit(a, b)}
    # four trigrams at two lengths and three places
    assert max(merged) <= 24
    assert spelling.one_edit("ab", "a") and spelling.one_edit("a", "b") and not spelling.one_edit("abcd", "abdc") and spelling.one_edit("xabcd", "abcd")
