"""Chunks under a vocabulary's own tokens: every chunk is counted again, and every cut is the furthest that fits."""

import pytest

from loomtext.operators import chunking
from loomtext.plans.chunked import vocabulary

PATH = vocabulary()
TEXTS = [
    "\n".join(f"line {i} of a text, naïve café {i * 7919} ☃" for i in range(400)),
    "\n\n".join("word " * (n % 97 + 1) for n in range(120)),
    "## a\nx\n" * 300 + "no break at all " * 900,
    "東京都" * 3000 + "\n" + "short",
]


def parts_of(noted):
    out = [noted[0][: noted[0].rindex("\n--- split 1/")]] if len(noted) > 1 else list(noted)
    return out + [c.split("\n", 1)[1] for c in noted[1:]]


@pytest.mark.parametrize("db", ["qa", "law", "paper"])
@pytest.mark.parametrize("text", TEXTS)
def test_chunks_keep_the_budget(text, db):
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100, vocabulary=PATH)
    noted = chunking.split_text("7", db, "", text, limits)
    # the last text is one line, which no boundary divides, and a small one that joins it
    assert "".join(parts_of(noted)) == text and (len(noted) > 1) == (text != TEXTS[3])
    levels = chunking.boundaries(text, db)
    cuts = {0, len(text), *(b for level in levels for b in level)}
    at = 0
    for chunk in noted:
        body = parts_of(noted)[noted.index(chunk)]
        # above the limit only if it holds a unit that no boundary divides, with what is small beside it
        inner = sorted(c for c in cuts if at <= c <= at + len(body))
        widest = max(chunking.count_tokens(text[a:b], PATH) for a, b in zip(inner, inner[1:]))
        assert chunking.count_tokens(chunk, PATH) <= limits.most or widest + 2 * limits.small + chunking.NOTE > limits.target - chunking.NOTE
        at += len(body)


@pytest.mark.parametrize("budget", [1, 7, 60, 700, 10**6])
def test_gallop_finds_the_furthest_boundary(budget):
    text = TEXTS[0]
    own, size = chunking.boundaries(text, "qa")[1], chunking.TokenSizes(text, PATH)
    for lo in (0, 5, 390):
        a = own[lo - 1] if lo else 0
        k = size.fit(a, own, lo, len(own), budget)
        assert k == lo or size(a, own[k - 1]) <= budget
        assert k == len(own) or size(a, own[k]) > budget


def test_bytes_stay_the_default():
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100)
    assert limits.token_method == "bytes_div_3" and chunking.count_tokens("abcdef") == 2
    assert chunking.Limits(vocabulary=PATH).token_method == "byte_bpe_50k"
    assert all(len(c.encode()) // 3 <= 600 for c in chunking.split_text("7", "qa", "", TEXTS[0], limits))


def test_split_measures_whole_documents(spark):
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100, vocabulary=PATH)
    rows = spark.createDataFrame([("qa", str(i), t) for i, t in enumerate([*TEXTS, "", None, "tiny"])], "db string, stem string, text string")
    got = chunking.split(rows, limits).withColumn("n", chunking.measured("text", PATH)).collect()
    by = {}
    for r in got:
        by.setdefault(r["base_id"], []).append(r)
    assert all(r["token_method"] == "byte_bpe_50k" and r["n"] == chunking.count_tokens(r["text"] or "", PATH) for r in got)
    for i, t in enumerate(TEXTS):
        own = [r["text"] for r in sorted(by[str(i)], key=lambda r: r["chunk_n"])]
        assert own == chunking.split_text(str(i), "qa", "", t, limits) and len(own) == by[str(i)][0]["chunk_total"]


def test_even_cut_equals_a_scan():
    text = "\n".join(f"line {i} café {i * 7919}" for i in range(120))
    own, size, n = chunking.boundaries(text, "qa")[1], chunking.TokenSizes(text, PATH), len(text)
    for first, second in ((900, 900), (400, 1200), (1200, 300), (100, 100)):
        fits = [(abs(size(0, b) - size(b, n)), b) for b in own if size(0, b) <= first and size(b, n) <= second]
        assert size.even(own, n, first, second) == min(fits, default=(0, 0))[1]


def test_short_texts_stay_whole(spark):
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100, vocabulary=PATH)
    by = {}
    for r in chunking.split(spark.createDataFrame([("qa", str(i), t) for i, t in enumerate([*TEXTS[:4], "", None, "tiny"])], "db string, stem string, text string"), limits).collect():
        by.setdefault(r["base_id"], []).append(r)
    assert all(len(by[str(i)]) == 1 for i in (4, 5, 6))


ODD = ["", "a", "\n\n\n\nx \n\n  y\t\n 's'sx're 'll\n'\n", "it's we're\n\n\n'tis 'r 're\n", "12 34\n5   6\u0085\n\n", "héé́ 東京!!\n!?'s x", "a <|endoftext|> b\n" * 9]


def test_sizes_by_pieces_equal_the_library():
    import random

    r = random.Random(5)
    texts = [*ODD, *TEXTS[:2], *("".join(r.choice(["\n", " ", "'", "s", "re", "'ll", "!", "7", "é", "word", "\n\n", "\t", "東"]) for _ in range(r.randrange(60))) for _ in range(150))]
    for text, size in zip(texts, chunking.known_sizes(texts, PATH), strict=True):
        if "<|endoftext|>" in text:
            assert size is None
            continue
        plain = chunking.TokenSizes(text, PATH)
        assert size.ends.tolist() == plain.ends.tolist()
        for _ in range(60):
            a, b = sorted((r.randrange(len(text) + 1), r.randrange(len(text) + 1)))
            assert size(a, b) == plain(a, b), (text, a, b)
            head = r.choice(["", "law: x\n\n", "---\n", "a '", "x "])
            assert size(0, b, head) == chunking.count_tokens(head + text[:b], PATH), (text, b, head)


@pytest.mark.parametrize("db", ["qa", "law", "paper"])
def test_chunks_by_pieces_equal_those_without(db):
    limits = chunking.Limits(most=600, target=560, small=20, least_budget=100, vocabulary=PATH)
    for head in ("", "law: L1\narticle: 1\n\n", "x " * 450 + "\n\n"):
        for text, known in zip(TEXTS, chunking.known_sizes(TEXTS, PATH), strict=True):
            assert isinstance(known, chunking.PieceSizes)
            assert chunking.split_text("7", db, head, text, limits, known) == chunking.split_text("7", db, head, text, limits)
