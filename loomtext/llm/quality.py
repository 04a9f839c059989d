"""Quality by a generalised additive model with pairwise interactions.

Each feature of a text falls into a bin; the score is the sum of one table entry per feature and one per
chosen pair of features, through a logistic curve. The tables are learned by boosting shallow trees in
cycles: one tree of two cuts on one feature after another, a small step each, so that features share the
explanation; then pairs with the largest gain get trees with one cut on either feature.

Fitting takes features of a bounded sample of labelled documents (`SAMPLE` rows, the smallest hashes of ids).
Labels, language, source and id are no inputs of a score.

Defined results: a null or empty text has all features 0 and a score like any other; texts are whole; each
row gives a row, repeated rows repeat; an empty table gives an empty one; without labels of both kinds every
document gets the share of label 1, or 0.5; null labels and documents with contrary labels are left out; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm import wordscan
from loomtext.llm.runtime import scored
from loomtext.llm.toxicity import SAMPLE, sample

FEATURES = ("log_words", "word_length", "distinct_words", "repeated_next", "distinct_lines", "letters", "capitals", "digits", "symbols", "bars", "capital_words", "words_a_line", "distinct_bigrams")
BINS, PAIR_BINS, PAIRS, CYCLES, PAIR_CYCLES, STEP = 48, 8, 6, 150, 60, 0.15


@cache
def _capitals() -> np.ndarray:
    return np.array([chr(c).isupper() for c in range(0x3000)], bool)


def _distinct(owner: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each owner has."""
    both = wordscan.mix(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(both, return_index=True)
    return np.bincount(owner[first], minlength=n)


def features(texts: Sequence[str]) -> np.ndarray:
    """A row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in wordscan.slabs(texts):
        cp, at = wordscan.points(texts[a:b])
        out[a:b] = _slab(cp, at, b - a)
    return out


def _slab(cp: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    kind = wordscan.classes()[cp]
    size = np.maximum(np.diff(at), 1)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(mask))[at])

    space = kind == wordscan.SPACE
    word = np.append(~space, False)
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    head = at[:-1][at[:-1] < len(cp)]
    begins[head] = word[head]
    s = np.flatnonzero(begins)
    stop = ~word
    stop[at] = True
    stops = np.flatnonzero(stop)
    e = stops[np.searchsorted(stops, s, "right")] if len(s) else s
    owner = np.searchsorted(at, s, "right") - 1
    words = np.bincount(owner, minlength=n)
    some = np.maximum(words, 1)
    h = wordscan.hashes(cp, s, e)
    pair = owner[1:] == owner[:-1] if len(s) else np.zeros(0, bool)
    same = pair & (h[1:] == h[:-1]) if len(s) else pair
    bigrams = wordscan.mix(h[:-1] * np.uint64(31) + h[1:])[pair] if len(s) else h
    upper = np.zeros(len(cp), bool)
    low = cp < 0x3000
    upper[low] = _capitals()[cp[low]]
    solid = np.maximum(per_text(~space), 1)
    breaks = np.append(cp == 10, False)
    line = breaks.copy()
    line[1:] = line[:-1]
    line[0] = False
    line[at] = True
    ls = np.flatnonzero(line[: len(cp)])
    line_stop = breaks.copy()
    line_stop[at] = True
    line_stops = np.flatnonzero(line_stop)
    le = line_stops[np.searchsorted(line_stops, ls, "left")] if len(ls) else ls
    # a text without a break at its end: the stop found at its own start belongs to the text before
    own = np.isin(ls, at) & ~np.append(cp == 10, False)[ls]
    le = np.where(own, line_stops[np.minimum(np.searchsorted(line_stops, ls, "right"), len(line_stops) - 1)], le) if len(ls) else le
    line_owner = np.searchsorted(at, ls, "right") - 1
    lines = np.bincount(line_owner, minlength=n)
    return np.stack([
        np.log1p(words),
        per_text(~space) / some,
        _distinct(owner, h, n) / some,
        np.bincount(owner[1:][same], minlength=n) / some if len(s) else np.zeros(n),
        _distinct(line_owner, wordscan.hashes(cp, ls, le), n) / np.maximum(lines, 1),
        per_text(kind == wordscan.LETTER) / solid,
        per_text(upper) / solid,
        per_text(kind == wordscan.NUMBER) / solid,
        per_text(kind == wordscan.OTHER) / solid,
        per_text(cp == 0x7C) / some,
        np.bincount(owner[upper[s]], minlength=n) / some,
        words / np.maximum(lines, 1),
        _distinct(owner[1:][pair], bigrams, n) / np.maximum(words - 1, 1) if len(s) else np.zeros(n),
    ], axis=1)


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += table[np.searchsorted(edges, x[:, j], "right")]
        for i, j, table in self.pairs:
            z += table[np.searchsorted(self.pair_edges[i], x[:, i], "right"), np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-z))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins of about equal counts; half of the distinct values in between where values repeat."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values by bin of a tree with two cuts: the best cut, then the best cut of either side."""
    n = len(g)

    def cut(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, -1
        G, H = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        gain = _gain(G[:-1], H[:-1]) + _gain(G[-1] - G[:-1], H[-1] - H[:-1]) - _gain(G[-1], H[-1])
        k = int(gain.argmax())
        return float(gain[k]), a + k + 1

    _, k = cut(0, n)
    parts = [0, n] if k < 0 else [0, k, n]
    if k > 0:
        inner = max(cut(0, k), cut(k, n))
        if inner[1] > 0 and inner[0] > 0:
            parts = sorted({*parts, inner[1]})
    out = np.zeros(n)
    for a, b in zip(parts, parts[1:]):
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut on either feature of a pair: gain and leaf values."""
    G, H = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    best, out = 0.0, np.zeros_like(g)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            corners = [(G[i, j], H[i, j]), (G[i, -1] - G[i, j], H[i, -1] - H[i, j]), (G[-1, j] - G[i, j], H[-1, j] - H[i, j]), (G[-1, -1] - G[i, -1] - G[-1, j] + G[i, j], H[-1, -1] - H[i, -1] - H[-1, j] + H[i, j])]
            gain = sum(a * a / (b + 1.0) for a, b in corners)
            if gain > best:
                best, v = float(gain), [-a / (b + 1.0) for a, b in corners]
                out = np.zeros_like(g)
                out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return best, out


def learn(x: np.ndarray, y: np.ndarray) -> Model:
    """The model for features x (rows of FEATURES) and labels y (0 or 1)."""
    share = y.mean() if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        p = float(np.clip(share, 0.01, 0.99))
        return Model(float(np.log(p / (1 - p))))
    z = np.full(len(y), np.log(share / (1 - share)))
    m = Model(float(z[0]), [_edges(x[:, j], BINS) for j in range(x.shape[1])])
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(m.edges)]
    for _ in range(CYCLES):
        for b, table in zip(bins, m.tables, strict=True):
            p = 1 / (1 + np.exp(-z))
            leaf = STEP * _tree(np.bincount(b, p - y, len(table)), np.bincount(b, p * (1 - p), len(table)))
            table += leaf
            z += leaf[b]
    m.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(m.pair_edges)]

    def grids(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        wide = len(m.pair_edges[j]) + 1
        cell, n = coarse[i] * wide + coarse[j], (len(m.pair_edges[i]) + 1) * wide
        return np.bincount(cell, p - y, n).reshape(-1, wide), np.bincount(cell, p * (1 - p), n).reshape(-1, wide), cell

    p = 1 / (1 + np.exp(-z))
    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda ij: -_quadrants(*grids(*ij, p)[:2])[0])
    m.pairs = [(i, j, np.zeros((len(m.pair_edges[i]) + 1, len(m.pair_edges[j]) + 1))) for i, j in ranked[:PAIRS]]
    for _ in range(PAIR_CYCLES):
        for i, j, table in m.pairs:
            g, h, cell = grids(i, j, 1 / (1 + np.exp(-z)))
            leaf = STEP * _quadrants(g, h)[1]
            table += leaf
            z += leaf.reshape(-1)[cell]
    return m


def _feature_rows(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    src = docs.select(*names, F.coalesce("text", F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wordscan.small(batches, lambda b: b.column("_text")):
            x = features(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(c) for c in x.T)], [*names, *FEATURES])

    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in names), *(T.StructField(c, T.DoubleType()) for c in FEATURES)]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> Model:
    """Learn from labels (doc_id, label): features of `bound` documents at most come to the driver."""
    got = _feature_rows(sample(docs, labels, label, bound), ["doc_id", "y"]).orderBy("doc_id").toArrow()
    x = np.stack([got[f].to_numpy() for f in FEATURES], axis=1)
    return learn(x, got["y"].to_numpy().astype(float))


def _scores(docs: DataFrame, model: Model, names: Sequence[str] | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = scored(docs, names, lambda: lambda texts: shared.value.score(features(texts)))
    return rows.withColumnRenamed("x", "score").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, the columns to keep, score and predicted: one pass without a shuffle."""
    return _scores(docs, model, ["doc_id", *keep])


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """row (a struct of all columns), score and predicted."""
    return _scores(docs, model, None)
