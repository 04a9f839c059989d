"""Cross-tokenizer alignment, near-equal windows and spelling variants against plain Python."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtext.llm import crosstokens, spelling, windows
from loomtext.llm.bpe import vocabulary_path
from loomtext.llm.packing import encoder

TEXTS = [
    "The quick brown fox, don't you know?", "", None, " ", "  two  spaces \n\tand tabs ", "naïve café ☃ 東京 <|endoftext|> x", "a▁b stays out", "A B C", "ends with space ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 9, "same text twice", "same text twice", "1234567890 " * 30, "<s>x</s><unk> </w> ſ\x00\x01", "é ﬁ ½",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", 1, 2, 3) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, unit string, codes string, s int, word int, gram int").repartition(3)


def aligned_plainly(texts):
    pair = crosstokens.tokenizers(vocabulary_path(), vocabulary_path(crosstokens.PIECES))
    rows, count = [], Counter()
    for t in texts:
        a, b = (pair.encode_a([" " + t])[0], pair.encode_b([" " + t])[0]) if t else ([], [])
        ea, eb = (list(itertools.accumulate(len(v[i]) for i in ids)) for v, ids in ((pair.bytes_a, a), (pair.bytes_b, b)))
        if not t or not b"".join(pair.bytes_a[i] for i in a) == (" " + t).encode() == b"".join(pair.bytes_b[i] for i in b):
            rows.append(None)
            continue
        groups, at = [], 0
        for cut in sorted(set(ea) & set(eb)):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends) if at < e <= cut) for ids, ends in ((a, ea), (b, eb))))
            at = cut
        linked = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max([0, *ea][i], [0, *eb][j]) < min(ea[i], eb[j])]
        count.update(set(linked))
        rows.append((len(a), len(b), len(groups), linked, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [r and (*r[:3], len(r[3]), sum(count[x] == best[x[0]] for x in r[3]), sum(count[x] for x in r[3]), r[4]) for r in rows]


@pytest.mark.parametrize("slab", [1, 200, crosstokens.SLAB_BYTES])
def test_alignment_equals_plain_python(docs, slab):
    got = {r[0]: tuple(r)[1:] for r in crosstokens.digests(crosstokens.align(docs, slab_bytes=slab)).collect()}
    want = {i: r or (0,) * 6 + ("",) for i, r in enumerate(aligned_plainly(TEXTS))}
    assert got == want


def test_alignment_of_nothing(spark, docs):
    assert crosstokens.digests(crosstokens.align(docs.where("false"))).collect() == []
    ids = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_groups"] for r in crosstokens.digests(crosstokens.align(ids)).collect()) == [0, 2]


def test_alignment_of_equal_ids_and_settings(spark, docs):
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    rows = spark.createDataFrame([(7, "one two"), (7, "one three")], "doc_id long, text string")
    assert len(crosstokens.digests(crosstokens.align(rows)).collect()) == 2
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(" \n\tab.,'éß東☃1 "), max_size=40))
def test_units_are_independent(text):
    """What the tokenizers give for a whole text is what they give for its units."""
    if not text:
        return
    pair = crosstokens.tokenizers(vocabulary_path(), vocabulary_path(crosstokens.PIECES))
    cp, at = np.array([ord(c) for c in " " + text], np.uint32), np.array([0, len(text) + 1])
    units = [(" " + text)[a:b] for a, b in zip(*crosstokens.unit_cuts(cp, at))]
    for encode in (pair.encode_a, pair.encode_b):
        whole = encode([" " + text])[0]
        assert whole == [i for ids in encode(units) for i in ids]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60))
def test_windows_hold_every_id_once(sizes):
    total, got = sum(sizes), windows.divided(sizes, 64)
    seen = sorted((i, start, n) for w in got for i, start, n in w)
    assert all(sum(n for *_, n in w) <= 64 for w in got)
    for i, size in enumerate(sizes):
        spans = [(s, n) for k, s, n in seen if k == i]
        assert [s for s, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1] and sum(n for _, n in spans) == size and all(n > 0 for _, n in spans)
    assert len(got) <= max(-(-total // 64), int(total / (64 * (1 - windows.WASTE))))


def test_differencing_is_near_equal():
    sizes = [int(x) for x in np.random.default_rng(5).integers(10, 900, 400)]
    sums = [sum(sizes[i] for i in w) for w in windows.differencing(sizes, 64)]
    assert len(sums) == 64 and sum(sums) == sum(sizes) and max(sums) - min(sums) < sum(sums) / 64 / 100
    assert max(sum([8, 7, 6, 5, 4][i] for i in w) for w in windows.differencing([8, 7, 6, 5, 4], 2)) == 16  # the classic example


def test_window_count_rises():
    # three items of 40 fit no two windows of 64 but three
    assert len(windows.divided([40, 40, 40], 64, waste=0.5)) == 3
    assert len(windows.divided([40, 40, 40], 64, waste=0.0)) == 2


def test_packed_windows(spark, docs):
    texts = [*TEXTS, "long text " * 3000, "word " * 2047]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int").repartition(2)
    got = [r.asDict() for r in windows.pack(rows, keep_ids=True).collect()]
    for i, ids in enumerate(encoder(vocabulary_path())([t or "" for t in texts])):
        ids = [*ids.tolist(), windows.END_ID]
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert [x for r in own for x in r["ids"]] == ids and [r["start"] for r in own] == [0, *itertools.accumulate(r["length"] for r in own)][:-1]
        assert all(r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)
    by_window = defaultdict(list)
    for r in got:
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_window.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1] and sum(n for _, n in spans) <= 2048
    assert windows.pack(rows.where("false")).collect() == []


def variants_plainly(rows, modulus):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run if h % modulus else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if x != w and spelling.one_edit(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def test_variants_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL_WORDS", 3)
    rng = np.random.default_rng(3)
    base = ["letters", "lettersx", "kitten", "kittens", "mitten", "aaaaaaa", "aaaaaaaa", "écoleés", "ÀÉcolex", "straße", "strasse", "abcabcabc", "abcabcab", "x" * 300, "x" * 299]
    words = base + [w[:k] + w[k + 1 :] for w in base[:8] for k in range(len(w))] + ["colour" + c for c in "abcdefgh"]
    rows = [(i, " ".join(rng.choice(words, 40) if i % 3 else rng.choice(base[:5], 90)) + ", KITTEN-Kitten 5") for i in range(120)]
    rows += [(None, "kitten kitten"), (1, None), (2, ""), (3, "kitten"), (3, "kitten")]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = sorted(tuple(r) for r in spelling.group(docs, modulus=7).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == variants_plainly(rows, 7) and any(r[1] and r[2] != r[1] for r in got)
    assert spelling.group(docs.where("false")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=6, max_size=9), min_size=2, max_size=30, unique=True))
def test_cells_find_all(words):
    got = {frozenset(p) for p in spelling.near_in_cell(words, [0] * len(words), 0, 0)}
    assert got == {frozenset(p) for p in itertools.combinations(range(len(words)), 2) if spelling.one_edit(*(words[i] for i in p))}
