"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c are sqrt(2 - 2c) apart. All vectors are rotated alike and split into BLOCKS blocks of
coordinates; if the whole squared distance is within the budget, some block's is within its share of the budget, in
proportion to its coordinates. So each block is range-joined under its share: a grid over the block's first GRID
coordinates deals the points (cells as wide as the block's radius; a point visits half of the adjacent cells), a
task compares the block's coordinates of a cell's points, and what is within the share is verified by the exact
cosine of the original vectors.

A pair counts only in the first block that finds it, which a task can tell from the two vectors alone; so tasks
count links without listing pairs, and hand on one tree of links per connected part. Equal vectors are one class,
counted by number. Cells above CELL_ROWS points are dealt as pairs of parts.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths never link; equal vectors link; repeated rows and ids are rows of their own; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.runtime import components, stash, width
from loomtext.llm.vectors import matrix, packed, rotation, usable

COSINE = 0.9
BLOCKS, GRID, CELL_ROWS = 4, 2, 65536
CELL_BYTES = 48 << 20  # of the vectors of one part of a cell, as doubles
TILE, DENSE = 512, 16  # rows and columns of a tile; one in so many pairs near makes it dense
_SEED = 77


def _name(v: Column) -> Column:
    """What tells distinct vectors apart: SHA-256, so no two of them are taken for one."""
    return F.unhex(F.sha2(v, 256))


def _edges_of(dim: int) -> list[tuple[int, int]]:
    cut = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int).tolist()
    return list(zip(cut, cut[1:]))


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _cells(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """A row for each block and cell that a class visits; home tells its own cell from adjacent ones."""
    names = ["dim", "block", "cell", "home", "class", "n", "v"]
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == d))
            u = _units(matrix(part.column("v").to_pylist(), d)) @ rotation(d, _SEED)
            for b, (lo, hi) in enumerate(_edges_of(d)):
                g = min(GRID, hi - lo)
                radius = np.sqrt((2 - 2 * cosine) * (hi - lo) / d) * (1 + 1e-6) + 1e-9
                at = np.floor(u[:, lo : lo + g] / radius).astype(np.int64)
                steps = [s for s in np.ndindex(*(3,) * g) if s >= (1,) * g]
                for s in steps:
                    cell = at + np.array(s) - 1
                    code = np.zeros(len(cell), np.int64)
                    for c in cell.T:
                        code = code * 2_000_003 + c + 1_000_000
                    n = len(cell)
                    yield pa.RecordBatch.from_arrays([pa.array([d] * n, pa.int32()), pa.array([b] * n, pa.int32()), pa.array(code), pa.array([s == (1,) * g] * n), part.column("class"), part.column("n"), part.column("v")], names)


class _Forest:
    """Connected parts of a task's points, and the links that made them."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, i: int, js: np.ndarray) -> None:
        own = self.label[js]
        if (own == self.label[i]).all():
            return
        for v, first in zip(*np.unique(own, return_index=True), strict=True):
            if v != self.label[i]:
                self.links.append((i, int(js[first])))
                self.label[self.label == v] = self.label[i]


def _near(w: np.ndarray, left: np.ndarray, right: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Tiles of (left rows, right rows) with the pairs whose squared distance in a block may be within its share.

    One matrix product gives the distances: (w, |w|^2, 1) times (-2 w, 1, |w|^2). True stands for a dense tile; its pairs are left
    to the caller.
    """
    ww = (w * w).sum(1, keepdims=True)
    one = np.ones_like(ww)
    x, y = np.hstack([w, ww, one])[left], np.ascontiguousarray(np.hstack([-2 * w, one, ww])[right].T)
    for s in range(0, len(left), TILE):
        for r in range(0, len(right), TILE):
            gap = x[s : s + TILE] @ y[:, r : r + TILE]
            some = np.flatnonzero(gap.min(1) <= share + 1e-5)  # most rows have nothing near in a tile
            if not len(some):
                continue
            i, j = np.nonzero(gap[some] <= share + 1e-5)
            rows, columns = left[s : s + TILE], right[r : r + TILE]
            if len(i) * DENSE > gap.size:
                yield rows, columns, True
            else:
                yield rows[some[i]], columns[j], False


def _compare(block: int, dim: int, lo: int, hi: int, cls: np.ndarray, n: np.ndarray, home: np.ndarray, side: np.ndarray, v: np.ndarray, cosine: float) -> tuple[list, list]:
    """Links of each class by number, and tree links."""
    u = _units(v) @ rotation(dim, _SEED)
    parts = _edges_of(dim)
    shares = [(2 - 2 * cosine) * (b - a) / dim * (1 + 1e-6) + 1e-12 for a, b in parts]
    a, b = parts[block]
    found, forest = np.zeros(len(cls), np.int64), _Forest(len(cls))
    norms = np.sqrt((v * v).sum(1))

    def count(x: np.ndarray, y: np.ndarray) -> None:
        np.add.at(found, x, n[y])
        np.add.at(found, y, n[x])
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        head = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else []
        for h, e in zip(head, [*head[1:], len(x)]):
            forest.join(int(x[h]), y[h:e])

    def sparse(x: np.ndarray, y: np.ndarray) -> None:
        for p in range(0, len(x), 1 << 15):
            i, j = x[p : p + (1 << 15)], y[p : p + (1 << 15)]
            mine = ((u[i, a:b] - u[j, a:b]) ** 2).sum(1) <= shares[block]
            i, j = i[mine], j[mine]
            gap = (u[i] - u[j]) ** 2
            mine = (v[i] * v[j]).sum(1) / (norms[i] * norms[j]) >= cosine
            for (c, d), share in zip(parts[:block], shares, strict=False):
                mine &= gap[:, c:d].sum(1) > share
            count(i[mine], j[mine])

    def dense(rows: np.ndarray, columns: np.ndarray) -> None:
        """The same for all pairs of two sets, by matrix products; pairs near a border are looked at one by one."""
        mine = np.ones((len(rows), len(columns)), bool)
        doubt = np.zeros_like(mine)

        def held(value: np.ndarray, bound: float, sign: int) -> None:
            nonlocal mine, doubt
            doubt |= np.abs(value - bound) < 1e-9
            mine &= sign * value <= sign * bound

        for k, (c, d) in enumerate(parts[: block + 1]):
            x, y = u[rows, c:d], u[columns, c:d]
            held((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), shares[k], 1 if k == block else -1)
        held((v[rows] / norms[rows, None]) @ (v[columns] / norms[columns, None]).T, cosine, -1)
        i, j = np.nonzero(mine & ~doubt)
        i, j = rows[i], columns[j]
        keep = _once(i, j, home, lo == hi)
        count(i[keep], j[keep])
        i, j = np.nonzero(doubt)
        i, j = rows[i], columns[j]
        keep = _once(i, j, home, lo == hi)
        sparse(i[keep], j[keep])

    w = u[:, a:b].astype(np.float32)
    # a pair counts where one of the two is at home; with both sides in one part each pair comes once
    own, other = np.flatnonzero((side == lo) & home), np.flatnonzero(side == hi)
    for x, y, full in _near(w, own, other, shares[block]):
        if full:
            dense(x, y)
        else:
            keep = _once(x, y, home, lo == hi)
            sparse(x[keep], y[keep])
    if lo != hi:
        for x, y, full in _near(w, np.flatnonzero((side == lo) & ~home), np.flatnonzero((side == hi) & home), shares[block]):
            dense(x, y) if full else sparse(x, y)
    some = np.flatnonzero(found)
    return [(int(cls[k]), int(found[k])) for k in some], [(int(cls[p]), int(cls[q])) for p, q in forest.links]


def _once(i: np.ndarray, j: np.ndarray, home: np.ndarray, same_part: bool) -> np.ndarray:
    """Of pairs with i at home: each once. In one part a pair of two at home comes twice."""
    return (i < j) | ~home[j] if same_part else np.ones(len(i), bool)


def join(rows: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row."""
    spark = rows.sparkSession
    base = stash(packed(rows, id_col, vec_col).withColumn("same", _name(F.col("v"))), "vectors")
    classes = base.groupBy("same").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"), F.first("v").alias("v"), F.first("dim").alias("dim"))
    classes = stash(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    visits = classes.select("class", "n", "v", "dim").mapInArrow(lambda it: _cells(it, cosine), "dim int, block int, cell long, home boolean, class long, n long, v binary")
    sizes = visits.groupBy("dim", "block", "cell").agg(F.count("*").alias("rows"), F.count_if("home").alias("homes")).where("homes > 0 AND rows > 1")
    # coordinates of unit vectors lie between -1 and 1, so a block has at most (2 / radius + 2) ** GRID cells at any number of vectors
    dealt = visits.join(F.broadcast(stash(sizes, "cells")), ["dim", "block", "cell"]).withColumn("parts", F.ceil(F.col("rows") / F.greatest(F.lit(1), F.least(F.lit(CELL_ROWS), F.floor(F.lit(CELL_BYTES) / (8 * F.col("dim")))))).cast("int"))
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["dim", "block", "cell", "lo", "hi"]
    dealt = dealt.select("dim", "block", "cell", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "class", "n", "home", "side", "v")
    dealt = dealt.repartition(width(spark) * 2, *keys).sortWithinPartitions(*keys, "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            links, tree = _compare(key[1], key[0], key[3], key[4], *(t[c].to_numpy() for c in ("class", "n", "home", "side")), matrix(t["v"].to_pylist(), key[0]), cosine)
            values = [(c, None, n) for c, n in links] + [(a, b, 0) for a, b in tree]
            columns = list(zip(*values, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])

        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            head = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), len(marks)]
            for a, b in zip(head, head[1:]):
                if a == b:
                    continue
                now = tuple(marks[a].tolist())
                if key is not None and now != key:
                    yield out()
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield out()

    got = stash(dealt.mapInArrow(run, "a long, b long, n long"), "links")
    parts = components(got.where("b IS NOT NULL"), "a", "b")
    links = got.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    named = classes.select("class", "same", "first", "n").join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(least, "component").join(links, "class", "left").select("same", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = base.select("vec_id", "same").join(known, "same").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable(vec_col)).select(F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
