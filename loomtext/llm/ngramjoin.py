"""N-gram Jaccard join by count vectors.

A text is the set of its distinct word n-grams (shingles). Shingles hash into GROUPS groups; how many a text
has in each group is its count vector, a point. For two texts the sum of the smaller coordinates bounds their
overlap from above, and so does, for a node of an R-tree over points, the sum with the node's largest
coordinates. What passes the bound is verified on the sets. A coordinate is a byte; a full one bounds nothing.

An R-tree over all points can't be dealt over executors without sending each point to most parts, because a
size-proportional ball covers most of the low coordinates. So points are first dealt by shingles: two linked
texts share one of the first n - ceil(t n) + 1 shingles in any common order (here: shingles that are frequent in
the corpus last, then by hash). Texts that share such a shingle are a bucket.

1. Texts with equal sets become one class. Only classes go on.
2. Each bucket links every class to the bucket's least class; bound and verification sort the true links out.
3. Buckets that still hold more than one component are searched by R-trees, across components only: first for
   each class's best partner, BEST_ROUNDS times, then in full. Large buckets are dealt as pairs of blocks.
After step 3 every true link either lies inside a component or was verified, so components are exact, and no
group of copies is expanded into pairs.

Shingles are held as 64-bit hashes and classes by the 64-bit sum of them; equal hashes of different shingles
are the only source of error.

Defined results: a null text or one without words has the empty set and links with nothing; a text with fewer
words than n is one shingle; texts are whole; repeated rows repeat in the result; an empty table gives an empty
one; other columns are not read. A document's component is the smallest id reachable; null ids get null unless
a document with an id is reachable.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm import wordscan
from loomtext.llm.runtime import bit_map, components, marked, release, stash, width

GROUPS = 256
FULL = 255  # a coordinate that says no more than "so many or more"
FREQUENT = 400_000  # shingles known as frequent, at most: they only set the order
BLOCK_ROWS = 4096
PAIRS = 1 << 17  # candidates that a task holds at once; the same pair may go out again
BEST_ROUNDS = 1
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: Sequence[str], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in wordscan.slabs(texts):
        raw, at = wordscan.octets(texts[a:b])
        raw = _LOWER[raw]
        s, e = wordscan.blank_cuts(raw, at)
        h = wordscan.hashes(raw, s, e)
        k = max(0, len(h) - n + 1)
        full = np.zeros(k, np.uint64)
        for j in range(n):
            full += h[j : j + k] * _ODD[j % len(_ODD)] + np.uint64(j // len(_ODD))
        full = wordscan.mix(full)
        cut = np.searchsorted(s, at).tolist()
        for i, j in zip(cut, cut[1:]):
            if j - i >= n:
                yield np.unique(full[i : j - n + 1])
            elif j > i:
                short = np.uint64(j - i)
                for w in h[i:j]:
                    short = wordscan.mix(np.array([short]) * _ODD[0] + w)[0]
                yield np.array([short], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def class_key(x: np.ndarray) -> int:
    return int(wordscan.mix(x ^ _ODD[3]).sum(dtype=np.uint64).astype(np.int64))


def counts(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((x >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS), FULL).astype(np.uint8)


def least_overlap(n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """The overlap that sets of sizes n and m need to link."""
    return -(-num * (n + m) // (num + den))


def prefix(x: np.ndarray, frequent: np.ndarray, num: int, den: int) -> np.ndarray:
    """The shingles of which two linked sets share one; the frequent ones come last."""
    take = len(x) - -(-num * len(x) // den) + 1
    if len(frequent) and len(x):
        common = frequent[np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)] == x
        x = np.concatenate([x[~common], x[common]])
    return x[:take]


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), _row_key(F.col(id_col).cast("long"), text).alias("row_key"))


def _row_key(doc_id, text):
    """The same for rows with the same id and text."""
    return F.xxhash64(doc_id, text)


def _frequent(src: DataFrame, n: int) -> np.ndarray:
    """Shingles of many documents, counted over all documents; FREQUENT at most come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            keys, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = c >= 3
            return pa.RecordBatch.from_arrays([pa.array(keys[many].view(np.int64)), pa.array(c[many])], ["key", "n"])

        for batch in wordscan.small(batches, lambda b: b.column(0)):
            for x in shingle_sets(batch.column(0).to_pylist(), n):
                held.append(x)
                size += len(x)
                if size > 3_000_000:
                    yield out()
                    held, size = [], 0
        yield out()

    top = src.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(FREQUENT)
    return np.sort(np.array(top.select("key").toArrow()["key"].to_numpy(), np.int64).view(np.uint64))


def _sets(src: DataFrame, n: int, keep: np.ndarray) -> DataFrame:
    """class, set (little-endian uint64) of the documents whose id is in the bit map `keep`."""
    shared = src.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            batch = batch.filter(pa.array(marked(bits, batch.column("code").to_numpy())))
            sets = list(shingle_sets(batch.column(1).to_pylist(), n))
            yield pa.RecordBatch.from_arrays([pa.array([class_key(x) for x in sets], pa.int64()), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())], ["class", "set"])

    return src.withColumn("code", F.xxhash64("doc_id")).mapInArrow(run, "class long, set binary")


def _verified(src: DataFrame, edges: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The edges (a, b) whose sets link, and the table of sets that this reads. A class's set meets those of its partners in runs of some hundred partners, whose order lets
    a task hold one set of a at a time."""
    spark = src.sparkSession
    ends = edges.select(F.col("a").alias("class")).unionByName(edges.select(F.col("b").alias("class"))).distinct()
    needed = classes.join(ends, "class").select("class", "doc_id")
    sets = _sets(src, n, bit_map(needed, F.xxhash64("doc_id"))).join(ends, "class").dropDuplicates(["class"])
    sets = stash(sets, "sets")
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("deg") / 512))))
    members = salted.join(sets.withColumnRenamed("class", "b"), "b").select("a", "salt", F.col("b"), "set")
    heads = salted.select("a", "salt").distinct().join(sets.withColumnRenamed("class", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "set")
    rows = heads.unionByName(members).repartition(width(spark) * 2, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for batch in batches:
            a_, b_ = [], []
            for a, b, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                x = np.frombuffer(body.as_buffer(), "<u8")
                if b is None:
                    head = x.copy()
                    continue
                at = np.searchsorted(head, x)
                both = int((head[np.minimum(at, len(head) - 1)] == x).sum())
                if den * both >= num * (len(x) + len(head) - both):
                    a_.append(a)
                    b_.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_, pa.int64()), pa.array(b_, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long"), sets


class RTree:
    """Points packed into leaves of 16 and nodes of 16 leaves, sorted by size and first coordinates; nodes hold the largest
    coordinates and the range of sizes below them."""

    FAN = 16

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        level = points[self.order].astype(np.int64)
        low = high = sizes[self.order].astype(np.int64)
        self.levels = [(level, low, high)]
        while len(level) > self.FAN:
            at = np.arange(0, len(level), self.FAN)
            level, low, high = np.maximum.reduceat(level, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((level, low, high))

    def search(self, point: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """The points that may link with this one."""
        live = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            level, low, high = self.levels[depth]
            live = live[(den * high[live] >= num * size) & (num * low[live] <= den * size)]
            if depth < len(self.levels) - 1 or len(self.levels) == 1 or len(live):
                bound = np.minimum(level[live], point).sum(1)
                # a saturated coordinate bounds nothing
                bound = np.where((level[live] == FULL).any(1) | (point == FULL).any(), 1 << 40, bound)
                live = live[bound >= least_overlap(low[live], size, num, den)]
            if depth:
                below = len(self.levels[depth - 1][0])
                live = (live[:, None] * self.FAN + np.arange(self.FAN)).reshape(-1)
                live = live[live < below]
        return self.order[live]


def _overlapping(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which of x may link with which of y by the bound."""
    bound = np.stack([np.minimum(x, v).sum(1, dtype=np.int64) for v in y], axis=1)
    bound[(x == FULL).any(1)] = bound[:, (y == FULL).any(1)] = 1 << 40
    return bound >= least_overlap(n[:, None], m[None, :], num, den)


def _across(rows: DataFrame, num: int, den: int, best: bool) -> DataFrame:
    """Pairs of classes of one bucket part in different components that pass the bound. rows: bucket, lo, hi, block, minor, class, component, n, vec.

    Each such pair has a member outside the component of the bucket's head (minor); only those search, so a large component
    in a bucket costs no pairs of its own. With `best` each of them gives only its most similar partner by the bound.
    """

    def searched(own: np.ndarray, others: np.ndarray, once: bool, minor: np.ndarray, cls: np.ndarray, comp: np.ndarray, n: np.ndarray, vec: np.ndarray) -> Iterator[tuple[int, int]]:
        if not len(own) or not len(others):
            return
        small = len(others) <= 32  # a tree of one node
        near = _overlapping(vec[own], n[own], vec[others], n[others], num, den) if small else None
        tree = None if small else RTree(vec[others], n[others])
        for k, i in enumerate(own.tolist()):
            found = others[np.flatnonzero(near[k]) if small else tree.search(vec[i].astype(np.int64), int(n[i]), num, den)]
            found = found[comp[found] != comp[i]]
            if best and len(found) > 1:
                shared = np.minimum(vec[found], vec[i]).sum(1, dtype=np.int64)
                found = found[[np.argmax(shared / (n[found] + n[i] - shared))]]
            elif once and not best:
                found = found[~minor[found] | (cls[found] > cls[i])]
            for j in found.tolist():
                yield (int(cls[i]), int(cls[j])) if cls[i] < cls[j] else (int(cls[j]), int(cls[i]))

    def pairs(block: np.ndarray, lo: int, hi: int, minor: np.ndarray, *rest: np.ndarray) -> Iterator[tuple[int, int]]:
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        yield from searched(left[minor[left]], right, lo == hi, minor, *rest)
        if lo != hi:
            yield from searched(right[minor[right]], left if best else left[~minor[left]], False, minor, *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def out(t: pa.Table, cut: int) -> Iterator[pa.RecordBatch]:
            keys = np.stack([t[c].to_numpy() for c in ("bucket", "lo", "hi")], axis=1)[:cut]
            block, minor, cls, comp, n = (t[c].to_numpy()[:cut] for c in ("block", "minor", "class", "component", "n"))
            vec = np.frombuffer(b"".join(t["vec"].slice(0, cut).to_pylist()), np.uint8).reshape(-1, GROUPS)
            head = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), cut] if cut else []
            some: set[tuple[int, int]] = set()
            for a, b in zip(head, head[1:]):
                for pair in pairs(block[a:b], keys[a, 1], keys[a, 2], minor[a:b], cls[a:b], comp[a:b], n[a:b], vec[a:b]):
                    some.add(pair)
                    if len(some) == PAIRS:
                        yield listed(some)
                        some.clear()
            yield listed(some)

        def listed(some: set[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*some, strict=True) if some else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            keys = np.stack([held[c].to_numpy() for c in ("bucket", "lo", "hi")], axis=1)
            last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield from out(held, last)
                held = held.slice(last)
        if held is not None and len(held):
            yield from out(held, len(held))

    return rows.mapInArrow(run, "a long, b long")


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id, component_id for each document: linked where den * overlap >= num * union.

    Also row_key, equal for rows of equal id and text, and component_class, a component's name by classes (null for empty sets).
    """
    spark = docs.sparkSession
    src = _source(docs, id_col, text_col)
    frequent = spark.sparkContext.broadcast(_frequent(src, n))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            sets = list(shingle_sets(batch.column(1).to_pylist(), n))
            values = [pa.array([class_key(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([counts(x).tobytes() for x in sets], pa.binary()), pa.array([prefix(x, frequent.value, num, den).astype("<u8").tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *values], ["doc_id", "row_key", "class", "n", "vec", "prefix"])

    rows = stash(src.mapInArrow(describe, "doc_id long, row_key long, class long, n long, vec binary, prefix binary"), "sets")
    classes = _classes(rows)
    buckets = _buckets(classes, frequent)
    wide, rows, classes = (rows, classes), stash(rows.drop("vec", "prefix"), "rows"), stash(classes.drop("prefix"), "points")
    release(*wide)

    points = classes.select("class", "n", "vec")
    stars = buckets.where("class <> head").select(F.col("head").alias("a"), F.col("class").alias("b")).distinct()
    first = _links(src, _bounded(stars, points, num, den), classes, n, num, den)
    parts = components(first, "a", "b")

    # most of what still links does so with its best partner elsewhere; those are tried first, so that few pairs are left for the full search
    links, full = first, False
    for round_ in range(BEST_ROUNDS + 1):
        full = round_ == BEST_ROUNDS
        pairs = stash(_across(_open(buckets, parts, points), num, den, not full).distinct(), "pairs")
        if pairs.isEmpty():
            break
        more = _links(src, pairs, classes, n, num, den)
        release(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            parts = components(links, "a", "b")

    member = rows.select("doc_id", "row_key", "class", "n").join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "class")))
    # written, so that the join below may split a component that many documents share
    names = classes.select("class", "doc_id").join(parts.withColumnRenamed("node", "class"), "class", "left").groupBy(F.coalesce("component", "class").alias("component")).agg(F.min("doc_id").alias("component_id"))
    names = stash(names, "names")
    return member.join(names, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), F.col("class").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"), "row_key", F.col("component").alias("component_class"))


def _classes(rows: DataFrame) -> DataFrame:
    """class, doc_id (the least), n, vec, prefix: one row for each set. Only rows whose class may have others are shuffled."""
    some = rows.where("n > 0")
    many = stash(some.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")).where("rows > 1").select("class", "doc_id"), "copies")
    shared = rows.sparkSession.sparkContext.broadcast(bit_map(many, F.col("class")))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marked(shared.value, batch.column("code").to_numpy()))], [*batch.schema.names[:-1], "doubtful"])

    names = ["class", "doc_id", "n", "vec", "prefix"]
    flagged = some.select(*names, F.col("class").alias("code")).mapInArrow(flag, "class long, doc_id long, n long, vec binary, prefix binary, doubtful boolean")
    doubtful = flagged.where("doubtful").groupBy("class").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in names[2:]))
    classes = stash(flagged.where("NOT doubtful").select(*names).unionByName(doubtful), "classes")
    release(many)
    return classes


def _buckets(classes: DataFrame, frequent) -> DataFrame:
    """bucket, class, head, size: the members of shingles that more than one class has in its prefix, and the least of them.

    The members of a shingle that is not among the frequent ones pass through one task, in order and never held together, which
    needs one shuffle of the keys alone. Frequent ones are counted first and joined, and the join may split them.
    """

    def keyed(common: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = frequent.value
            for batch in batches:
                bodies = batch.column(1).to_pylist()
                each = np.array([len(x) // 8 for x in bodies], np.int64)
                keys, owner = np.frombuffer(b"".join(bodies), "<u8"), np.repeat(batch.column(0).to_numpy(), each)
                often = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)
                keep = often == common
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(owner[keep])], ["bucket", "class"])

        return run

    src = classes.select("class", "prefix")
    rare = src.mapInArrow(keyed(False), "bucket long, class long").repartition(2 * width(classes.sparkSession), "bucket").sortWithinPartitions("bucket", "class").mapInArrow(_runs, "bucket long, class long, head long")
    keys = stash(src.mapInArrow(keyed(True), "bucket long, class long"), "keys")
    counted = keys.groupBy("bucket").agg(F.min("class").alias("head"), F.count("*").alias("size")).where("size > 1")
    both = rare.unionByName(keys.join(counted, "bucket").select("bucket", "class", "head"))
    both = stash(both, "members")
    release(keys)
    # buckets of the same classes are one: members are compared by number, least class and sum of hashes
    signs = both.groupBy("bucket", "head").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("class")).alias("sign"))
    one = signs.groupBy("head", "size", "sign").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    buckets = stash(both.join(one, "bucket"), "buckets")
    release(both)
    return buckets


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of keys that come more than once, with the first of them; the rows are in order.

    Only the last row is kept from batch to batch, with its head and whether it has gone out, so a key may have any number of members.
    """
    kept = None
    for batch in batches:
        key, cls = (c.to_numpy() for c in batch.columns)
        if not len(key):
            continue
        if kept:
            key, cls = np.append(kept[0], key), np.append(kept[1], cls)
        same = key[1:] == key[:-1]
        more = np.append(False, same) | np.append(same, False)
        head = cls[np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(key)), 0))]
        gone = False
        if kept:
            head[key == kept[0]], gone = kept[2], kept[3]
        kept = key[-1], cls[-1], head[-1], bool(more[-1])
        more[0] &= not gone
        yield pa.RecordBatch.from_arrays([pa.array(c[more]) for c in (key, cls, head)], ["bucket", "class", "head"])


def _open(buckets: DataFrame, parts: DataFrame, points: DataFrame) -> DataFrame:
    """The members of buckets with more than one component, dealt as pairs of blocks where a bucket is large."""
    placed = buckets.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    placed = stash(placed, "placed")
    of_head = F.min(F.when(F.col("class") == F.col("head"), F.col("component")))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), of_head.alias("main")).where("c0 <> c1").select("bucket", "main")
    # written, so that the join below may split a bucket that many classes share
    mixed = stash(mixed, "mixed")
    rows = placed.join(mixed, "bucket").withColumn("minor", F.col("component") != F.col("main")).withColumn("blocks", F.ceil(F.col("size") / BLOCK_ROWS).cast("int"))
    rows = rows.join(points.select("class", "n", "vec"), "class")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = rows.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "minor", "class", "component", "n", "vec")
    return dealt.repartition(width(buckets.sparkSession) * 2, "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")


def _bounded(edges: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """Edges that pass the bound on sizes and count vectors."""
    a = points.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("vec").alias("vec_a"))
    b = points.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("vec").alias("vec_b"))
    both = edges.join(b, "b").join(a, "a").where((den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS).astype(np.int64) for c in ("vec_a", "vec_b"))
            need = least_overlap(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), num, den)
            good = (np.minimum(x, y).sum(1) >= need) | (x == FULL).any(1) | (y == FULL).any(1)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "n_a", "n_b", "vec_a", "vec_b").mapInArrow(run, "a long, b long")


def _links(src: DataFrame, edges: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The edges whose sets link, written; what it takes to find them goes at once."""
    edges = stash(edges, "edges")
    edges_of = edges.join(edges.groupBy("a").agg(F.count("*").alias("deg")), "a")
    links, sets = _verified(src, edges_of, classes, n, num, den)
    links = stash(links, "links")
    release(edges, sets)
    return links


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents without near copies: of each component one row with the smallest id stays, with all its columns.

    Documents without words are copies of nothing and stay. Only rows that may have to go are shuffled.
    """
    spark = docs.sparkSession
    found = stash(join(docs, n, num, den).where("component_class IS NOT NULL").select("doc_id", "row_key", "component_class"), "found")
    best = found.groupBy("component_class").agg(F.min(F.struct("doc_id", "row_key")).alias("w")).select(F.col("w.row_key").alias("row_key"))
    keys = found.groupBy("row_key").agg(F.count("*").alias("n"))
    losers = stash(keys.join(best, "row_key", "left_anti").select("row_key"), "losers")
    doubt = losers.unionByName(keys.where("n > 1").select("row_key"))
    bits = spark.sparkContext.broadcast(bit_map(doubt, F.col("row_key")))
    whole = F.struct(*(docs[c] for c in docs.columns))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(whole.alias("row"), _row_key(F.col("doc_id").cast("long"), text).alias("row_key"), text.rlike(r"[^\x20\x09-\x0D]").alias("words"))
    rows = rows.withColumn("code", F.col("row_key"))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doubtful = marked(bits.value, batch.column("code").to_numpy())
            doubtful &= np.array(batch.column("words").to_pylist(), bool)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("row_key"), pa.array(doubtful)], ["row", "row_key", "doubtful"])

    flagged = rows.mapInArrow(flag, T.StructType([rows.schema["row"], rows.schema["row_key"], T.StructField("doubtful", T.BooleanType())]))
    sure = flagged.where("NOT doubtful").select("row.*")
    rest = flagged.where("doubtful").join(losers, "row_key", "left_anti").dropDuplicates(["row_key"]).select("row.*")
    return sure.unionByName(rest)
