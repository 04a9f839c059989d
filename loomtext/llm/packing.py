"""Best-fit packing of token sequences by large-item matching.

Packing only depends on how many pieces have each length, and lengths are 1 to `capacity`. So Spark counts
lengths, the driver packs the counts (never documents: the histogram has `capacity` rows at any size of
corpus), and each piece finds its place by its length and its rank among the pieces of that length.

The packing: pieces above a third of the capacity share a sequence with one other such piece at most; the
largest takes the largest that still fits. The smaller ones, largest first, each go to the fullest sequence
with room; where none has room, new ones open.

Defined results: a null or empty text is a document of its end id alone; repeated rows are packed each;
texts are whole, only documents above the capacity are cut; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.bpe import vocabulary_path
from loomtext.llm.runtime import stash

CAPACITY = 2048
END_ID = 0
_SHIFT = 44


@cache
def encoder(path: str):
    """Texts to ids as the tokenizers library gives them; each distinct piece is encoded once, by that library."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    special = [x.content for x in t.get_added_tokens_decoder().values()]
    coder = wordscan.PieceCoder(lambda words: [x.ids for x in t.encode_batch_fast(words, add_special_tokens=False)])

    def run(texts: Sequence[str]) -> Iterator[np.ndarray]:
        for a, b in wordscan.slabs(texts):
            part = texts[a:b]
            odd = {i for i, x in enumerate(part) if any(s in x for s in special)}
            cp, at = wordscan.points([x if i not in odd else "" for i, x in enumerate(part)])
            s, e = wordscan.byte_level_cuts(cp, at)
            flat, n = coder(cp, s, e)
            stop = np.append(0, np.cumsum(n))[np.searchsorted(s, at)].tolist()
            for i in range(len(part)):
                yield np.array(t.encode(part[i], add_special_tokens=False).ids, np.uint32) if i in odd else flat[stop[i] : stop[i + 1]]

    return run


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs of (length, first rank, how many, first sequence, offset), and the number of sequences.

    Rank `first + i` of a run goes to sequence `first sequence + i`. Each step uses up a length or a group of
    equally full sequences, so there are at most some runs for each pair of lengths, however many pieces there are.
    """
    left, rank, runs, bins = dict(counts), dict.fromkeys(counts, 0), [], 0
    room: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, rank[length], n, first, offset))
        rank[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int) -> None:
        if gap:
            if not room.get(gap):
                bisect.insort(gaps, gap)
                room[gap] = []
            room[gap].append((first, n))

    large = sorted(x for x in counts if 3 * x > capacity)
    for x in reversed(large):
        while left[x]:
            k = bisect.bisect_right(large, min(x, capacity - x)) - 1
            while k >= 0 and (left[large[k]] < (2 if large[k] == x else 1)):
                k -= 1
            if k < 0:
                n = left[x]
                put(x, n, bins, 0)
                leave(capacity - x, bins, n)
            else:
                y = large[k]
                n = left[x] // 2 if y == x else min(left[x], left[y])
                put(x, n, bins, 0)
                put(y, n, bins, x)
                leave(capacity - x - y, bins, n)
            bins += n
    for x in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        while left[x]:
            k = bisect.bisect_left(gaps, x)
            if k == len(gaps):
                n = -(-left[x] // (capacity // x))
                leave(capacity, bins, n)
                bins += n
                continue
            gap = gaps[k]
            first, n = room[gap].pop()
            if not room[gap]:
                del gaps[k], room[gap]
            used = min(n, left[x])
            put(x, used, first, capacity - gap)
            leave(gap - x, first, used)
            leave(gap, first + used, n - used) if used < n else None
    return runs, bins


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, the split that read it and its rank there among pieces of its length.

    A document above the capacity is cut so that its first piece is the short one. With keep_ids, the ids too.
    """
    path = path or vocabulary_path()
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "split", "rank", *["ids"] * keep_ids]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int32())] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, split = encoder(path), np.zeros(capacity + 1, np.int64).tolist(), TaskContext.get().partitionId()
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            source, rows = [], []
            for i, ids in enumerate(encode(batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part, n = ids[a:b], b - a
                    source.append(i)
                    rows.append((p, a, n, zlib.crc32(part.tobytes()), split, seen[n], *[part.astype(np.int32)] * keep_ids))
                    seen[n] += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, split int, rank long" + ", ids array<int>" * keep_ids)


def pack(docs: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with keep_ids=True)."""
    spark = docs.sparkSession
    rows = stash(pieces(docs, capacity, **options), "pieces")
    per_split = rows.groupBy("length", "split").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_split.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `capacity` rows at most
    runs, _ = plan(counts, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(((table[:, 0] << _SHIFT) + table[:, 1], table))
    running = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_split.select("length", "split", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("base"))
    names = [c for c in rows.columns if c not in ("split", "rank")]
    ranked = rows.join(bases, ["length", "split"]).select(*names, (F.col("base") + F.col("rank")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, t = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            i = np.searchsorted(keys, (length << _SHIFT) + rank, "right") - 1
            own = t[i] if len(t) else np.zeros((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(own[:, 3] + rank - own[:, 1]), pa.array(own[:, 4])], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in names)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")
