"""Pages with awkward markup, repeatable fits and vectors of any size."""

import time

import numpy as np
import pytest

from loomtext.llm import neardup, toxicity
from loomtext.llm.pagetext import blocks

LONG = "a long main text " * 30


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<p>a</p><p hidden="">x</p><p hidden="hidden">y</p><p hidden>z</p>', ["a"]),
        ('<p data-v2="hidden">text</p>', ["text"]),
        ("<p title=don't>Hello brave world's end</p>", ["Hello brave world's end"]),
        ("<article><p>energy <math>E=m</math> end</p></article>", ["energy E=m end"]),
        ("<body><form><p>a page in one form</p><p>two</p></form></body>", ["a page in one form", "two"]),
        (f"<div><p>{LONG}</p></div><article><p>card</p></article>", [LONG.strip(), "card"]),
        ("<p>press the <button>Go</button> key, <label>Name</label> it</p><button>Gone</button><p>z</p>", ["press the Go key, Name it", "z"]),
        ('<a title="x>y">z</a> <p>a < b', ["z", "a < b"]),
        ("<ul><li>one<li>two</ul><script>if (a < b) x</script><!-- c -->tail", ["one", "two", "tail"]),
        ("", []),
    ],
)
def test_main_text(page, want):
    assert [t for t, _ in blocks(page)] == want


@pytest.mark.parametrize("unit", ['<a b="', "<a b='", "<div>x</span>", '<div class="ad">x', "<b><p></p>", "<script>", "<!--", "</", "<a =="])
def test_time_grows_with_the_page(unit):
    began = time.perf_counter()
    blocks(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - began < 10


def test_fit_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(words, 40)) + (" vile scum" if i % 4 == 0 else " kind sir")
        rows += [(i, text), (1000 + i, text + f" edit{i}"), (i, text + " twin")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 1000 % 4 == 0)) for i, _ in rows], "doc_id long, toxic int").distinct()
    texts = [sorted((r["text"], r["y"]) for r in toxicity._apart(toxicity.sample(docs.repartition(n), labels, "toxic", 500)).collect()) for n in (1, 3, 7)]
    assert texts[0] == texts[1] == texts[2] and 0 < len(texts[0]) <= 500


def test_wide_vectors_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CELL_BYTES", 8 * 768 * 20)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 768))
    v = [base[i % 12] + rng.normal(size=768) * (0.01 if i % 3 else 2.0) for i in range(150)] + [base[0]] * 40
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    u = np.array([x / np.linalg.norm(x) for x in v])
    near = (u @ u.T >= 0.9) & ~np.eye(len(v), dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in neardup.join(rows).collect()}
    assert got == dict(enumerate(near.sum(1).tolist()))
