"""Approximate nearest neighbours on shifted space-filling curves.

Rows of equal vectors form one class, named by its least row. Each of ORDERINGS orderings rotates the distinct
vectors, keeps AXES coordinates, shifts them, and sorts the classes by their place on a Hilbert curve,
range-partitioned in Spark. A query's candidates in one ordering are the classes within a window around its place;
the windows of all orderings are merged and ranked, and a class found stands for its k + 1 rows of
least ids (one of them may be the query). All queries of a class share one search.

What travels with the orderings is a code of a class, a byte for each coordinate. In a window the query's own vector meets
the codes; the SURVIVORS nearest by code, over all orderings, are fetched whole and ranked by exact distance.

A window holds WINDOW * n ** (2 / 3) of n classes, and a few more, to either side: the work of a query grows slower than
the table. An ordering is cut into ranges of SPAN windows, SPAN_MOST classes at most. A query goes to its own range, once
an ordering; a run of classes goes, as codes, to each range that holds places a window away: one or two in most cases. A task
keeps the queries of one range with their best so far, meets the runs one by one, and only the best of a range are shuffled.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors
of different lengths are never compared; a query does not find its own row but finds rows with the same id or
vector; ties go to smaller ids; fewer candidates than asked give fewer rows; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.runtime import stash, width
from loomtext.llm.vectors import matrix, packed, rotation

ORDERINGS, AXES, BITS = 18, 6, 8
WINDOW, SURVIVORS, BLOCK = 0.75, 64, 1024
SPAN, SPAN_MOST = 4, 1 << 18
_CODE_SPAN = 12  # deviations that the 256 values of a coordinate's code cover


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of rows of integer coordinates below 2 ** bits (columns * bits at most 62)."""
    x = [c.copy() for c in cells.astype(np.int64).T]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> b) & 1, flip ^ ((1 << b) - 1), flip)
    x = [c ^ flip for c in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | ((c >> b) & 1)
    return key


def _projected(v: np.ndarray, m: int) -> np.ndarray:
    return v @ rotation(v.shape[1], 1000 + m)[:, :AXES]


def _coordinates(v: np.ndarray) -> np.ndarray:
    """The projected coordinates of all orderings, then the rotated ones that codes are made of."""
    return np.concatenate([*(_projected(v, m) for m in range(ORDERINGS)), v @ rotation(v.shape[1], 999)], axis=1)


def _spreads(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean and deviation of each of these coordinates over all rows, by vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims).tolist():
                v = matrix(batch.column(0).filter(pa.array(dims == d)).to_pylist(), d)
                y = _coordinates(v)
                k = y.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array([d] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([len(v)] * k, pa.int64()), pa.array(y.sum(0)), pa.array((y * y).sum(0))], ["dim", "axis", "n", "s", "q"])

    got = rows.select("v", "dim").mapInArrow(run, "dim int, axis int, n long, s double, q double").groupBy("dim", "axis").agg(F.sum("n"), F.sum("s"), F.sum("q")).collect()
    out: dict[int, list] = {}
    for d, a, n, s, q in sorted(map(tuple, got)):
        out.setdefault(d, []).append((s / n, max(q / n - (s / n) ** 2, 1e-300) ** 0.5))
    return {d: np.array(x) for d, x in out.items()}


def window(n: int, share: float, least: int) -> int:
    """Classes to either side of a query's place that it looks at."""
    return int(share * n ** (2 / 3)) + least


def span(window: int) -> int:
    """Places of an ordering that form one range; a task holds the queries among them."""
    return -(-min(SPAN * window, SPAN_MOST) // BLOCK) * BLOCK


def search(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", share: float = WINDOW, least: int | None = None, survivors: int = SURVIVORS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row for which is_query (an expression on vec_id) holds.

    A window has share * n ** (2 / 3) + least of n classes to either side (least: 4 k, if not given).
    """
    spark, survivors, least = rows.sparkSession, max(survivors, 4 * k), 4 * k if least is None else least
    every = stash(packed(rows, id_col, vec_col).withColumn("query", F.coalesce(is_query, F.lit(False))), "vectors")
    # vectors that are equal bit by bit; the hash only shortens the key
    digest = F.unhex(F.sha2("v", 256))
    base = stash(every.groupBy(digest.alias("digest")).agg(F.min("vec_id").alias("vec_id"), F.min("row").alias("row"), F.max("query").alias("query"), F.first("v").alias("v"), F.first("dim").alias("dim")), "classes")
    spreads = spark.sparkContext.broadcast(_spreads(base))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                v, k = matrix(part.column("v").to_pylist(), d), min(AXES, d)
                mean, dev = spreads.value[d].T
                z = (_coordinates(v) - mean) / dev
                codes = np.clip(np.floor(z[:, ORDERINGS * k :] * (256 / _CODE_SPAN)) + 128, 0, 255).astype(np.uint8)
                codes = pa.array([c.tobytes() for c in codes], pa.binary())
                for m in range(ORDERINGS):
                    shift = np.random.default_rng(m).uniform(-0.15, 0.15, k)
                    at = np.clip(z[:, m * k : (m + 1) * k] / 6 + 0.5 + shift, 0, 1 - 1e-9)
                    key = hilbert((at * (1 << BITS)).astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), d * ORDERINGS + m)), pa.array(key), part.column("row"), part.column("query"), codes], ["lane", "key", "row", "query", "code"])

    placed = base.select("row", "query", "v", "dim").mapInArrow(order, "lane long, key long, row long, query boolean, code binary")
    placed = placed.repartitionByRange(width(spark), "lane", "key", "row").sortWithinPartitions("lane", "key", "row")
    runs = pa.schema([("lane", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("rows", pa.binary()), ("asks", pa.binary()), ("codes", pa.binary())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of consecutive classes of a lane, each a row, with their places among the lane's classes in this partition."""
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            lanes, rows = batch.column("lane").to_numpy(), batch.column("row").to_numpy()
            asks, codes = batch.column("query").to_numpy(zero_copy_only=False).astype(np.uint8), batch.column("code").to_pylist()
            out = []
            for lane in np.unique(lanes).tolist():
                a, b = np.searchsorted(lanes, [lane, lane + 1]).tolist()
                for s in range(a, b, BLOCK):
                    e = min(s + BLOCK, b)
                    out.append((lane, part, seen.get(lane, 0), e - s, rows[s:e].tobytes(), asks[s:e].tobytes(), b"".join(codes[s:e])))
                    seen[lane] = seen.get(lane, 0) + e - s
            yield _batch(out, runs)

    placed = stash(placed.mapInArrow(number, "lane long, part int, at long, n long, rows binary, asks binary, codes binary"), "curve")
    # one row for each partition and lane
    counts = sorted(map(tuple, placed.groupBy("lane", "part").agg(F.sum("n")).collect()))
    starts: dict[tuple[int, int], int] = {}
    totals: dict[int, int] = {}
    for lane, part, n in counts:
        starts[lane, part] = totals.get(lane, 0)
        totals[lane] = starts[lane, part] + n
    shared = spark.sparkContext.broadcast((starts, {lane: window(n, share, least) for lane, n in totals.items()}, totals))
    pieces = pa.schema([("lane", pa.int64()), ("range", pa.int64()), ("asks", pa.bool_()), ("asking", pa.int64()), ("pos", pa.int64()), ("rows", pa.binary()), ("codes", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each run once for every range whose windows touch it, and each query once for its own range."""
        starts, windows, totals = shared.value
        for batch in batches:
            for lane, part, at, n, rows, asks, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, w = starts[lane, part] + at, windows[lane]
                size = span(w)
                out = [(lane, r, False, None, first, rows, codes) for r in range(max(first - w, 0) // size, min(first + n - 1 + w, totals[lane] - 1) // size + 1)]
                for i in np.flatnonzero(np.frombuffer(asks, np.uint8)).tolist():
                    own = rows[8 * i : 8 * i + 8]
                    out.append((lane, (first + i) // size, True, int.from_bytes(own, "little"), first + i, own, None))
                yield _batch(out, pieces)

    dealt = placed.mapInArrow(deal, "lane long, range long, asks boolean, asking long, pos long, rows binary, codes binary")
    # a query travels as its own vector
    query = base.where("query").select(F.col("row").alias("asking"), "v")
    asking = dealt.where("asks").drop("codes").join(query, "asking").select("lane", "range", "asks", "pos", "rows", F.col("v").alias("codes"))
    dealt = dealt.where("NOT asks").drop("asking").unionByName(asking).repartition(width(spark) * 2, "lane", "range").sortWithinPartitions("lane", "range", F.desc("asks"), "pos")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value[1]
        key, asked, best = None, [], None
        for batch in batches:
            for lane, r, asks, pos, rows, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lane, r) != key:
                    if best:
                        yield best.found()
                    key, asked, best = (lane, r), [], None
                if asks:
                    asked.append((pos, rows, codes))
                elif asked or best:
                    if best is None:
                        best, asked = _Nearest(asked, lane // ORDERINGS, windows[lane], survivors, spreads.value), []
                    best.meet(pos, rows, codes)
        if best:
            yield best.found()

    near = dealt.mapInArrow(rank, "query_row long, row long, gap float")
    # the nearest by code over all orderings, then their vectors
    near = near.groupBy("query_row", "row").agg(F.min("gap").alias("gap"))
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("query_row").orderBy("gap", "row"))).where(F.col("n") <= survivors).select("query_row", "row")
    whole = near.join(base.select(F.col("row").alias("query_row"), F.col("v").alias("q")), "query_row").join(base.select("row", "vec_id", "v", "dim"), "row")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, score = batch.column("dim").to_numpy(), np.zeros(len(batch))
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                q, v = (matrix(batch.column(c).take(pa.array(own)).to_pylist(), d) for c in ("q", "v"))
                score[own] = np.sqrt(((v - q) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("query_row"), batch.column("row"), batch.column("vec_id"), pa.array(score)], ["query_row", "row", "vec_id", "score"])

    found = whole.select("query_row", "row", "vec_id", "dim", "q", "v").mapInArrow(exact, "query_row long, row long, vec_id long, score double")
    best = Window.partitionBy("query_row").orderBy("score", F.coalesce("vec_id", F.lit((1 << 63) - 1)), "row")
    classes = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_row", "row", "score")
    own = base.where("query").select(F.col("row").alias("query_row"), "row", F.lit(0.0).alias("score"))

    # back from classes to rows: k + 1 of each class are enough, and k + 1 for each class that asks
    members = stash(every.select(digest.alias("digest"), "vec_id", "row", "query").join(base.select("digest", F.col("row").alias("class")), "digest").drop("digest"), "members")
    last = F.coalesce("vec_id", F.lit((1 << 63) - 1))
    few = members.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy(last, "row"))).where(F.col("n") <= k + 1).select("class", "vec_id", F.col("row").alias("member"))
    near = classes.unionByName(own).withColumnRenamed("row", "class").join(few, "class")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("query_row").orderBy("score", last, "member"))).where(F.col("n") <= k + 1).drop("n", "class")
    asked = members.where("query").select(F.col("class").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("row").alias("asking"))
    found = asked.join(near, "query_row").where("member <> asking")
    ranks = F.row_number().over(Window.partitionBy("asking").orderBy("score", last, "member"))
    return found.withColumn("rank", ranks).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class _Nearest:
    """The queries of a range, in the order of their places, and the classes of their windows that are nearest by code so far, `most` at most."""

    def __init__(self, asked: list, dim: int, window: int, most: int, spreads: dict[int, np.ndarray]) -> None:
        self.dim, self.window, self.most = dim, window, most
        mean, dev = spreads[dim][-dim:].T
        # in units of the widest coordinate, so that no square is out of range
        self.unit, self.dev = dev.max(), dev / dev.max()
        self.at = np.array([p for p, _, _ in asked])
        self.own = np.frombuffer(b"".join(r for _, r, _ in asked), np.int64)
        self.q = (matrix([v for _, _, v in asked], dim) @ rotation(dim, 999) - mean) / self.unit
        self.gaps = np.full((len(asked), most), np.inf, np.float32)
        self.rows = np.zeros((len(asked), most), np.int64)

    def meet(self, pos: int, rows: bytes, codes: bytes) -> None:
        """The classes of a run, at pos and the places behind it, for the queries whose windows touch it."""
        rows = np.frombuffer(rows, np.int64)
        a, b = np.searchsorted(self.at, [pos - self.window, pos + len(rows) + self.window]).tolist()
        x = (np.frombuffer(codes, np.uint8).reshape(-1, self.dim) - 127.5) * (_CODE_SPAN / 256) * self.dev
        places = pos + np.arange(len(rows))
        for s in range(a, b, 256):
            part = slice(s, min(s + 256, b))
            q = self.q[part]
            gaps = (q * q).sum(1)[:, None] + (x * x).sum(1) - 2 * (q @ x.T)
            gaps[(np.abs(places - self.at[part, None]) > self.window) | (rows == self.own[part, None])] = np.inf
            gaps = np.concatenate([self.gaps[part], gaps], axis=1)
            seen = np.concatenate([self.rows[part], np.broadcast_to(rows, (len(q), len(rows)))], axis=1)
            keep = np.argpartition(gaps, self.most - 1, axis=1)[:, : self.most]
            self.gaps[part], self.rows[part] = np.take_along_axis(gaps, keep, 1), np.take_along_axis(seen, keep, 1)

    def found(self) -> pa.RecordBatch:
        i, j = np.nonzero(np.isfinite(self.gaps))
        return pa.RecordBatch.from_arrays([pa.array(self.own[i]), pa.array(self.rows[i, j]), pa.array(self.gaps[i, j])], ["query_row", "row", "gap"])
