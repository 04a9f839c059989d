"""Near-equal packing of token sequences by multiway differencing, after Karmarkar and Karp.

Documents come in the order in which they are read. A document above the capacity gives whole windows; what is left of
it, and every shorter document, is an item. Items gather until they fill `group` windows but for a small slack; such a
group is divided into windows by differencing: a partial partition is a list of window sums, at first one item and
empty windows; the two partitions with the largest spread merge, the fullest windows of one with the emptiest of the
other, so their imbalances oppose each other; the last one left is near equal.

Where a window exceeds the capacity, the count of the group's windows rises by one and the group is divided anew, as
long as no more than `waste` of its room stays empty. Beyond that (groups whose items don't pair, such as items just
above half the capacity) the surplus of the windows above the capacity is cut off and laid where there is room.

A group is closed by its tokens, so a task holds one group (some 130,000 ids) whatever its partition holds; nothing is
shuffled and nothing goes to the driver. The last group of a partition has fewer windows. Windows are numbered within
their partition, so results repeat when a task runs again on the same rows.

Defined results: a null or empty text is a document of its end id alone; repeated rows are packed each; texts are whole,
of any length; an empty table gives an empty one; other columns are not read, so their names never clash.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.bpe import vocabulary_path
from loomtext.llm.packing import CAPACITY, encoder

END_ID = 1
GROUP = 64
SLACK = 1 / 512  # of a group's room, left empty so that differencing seldom needs one more window
WASTE = 1 / 32
_WINDOW_BITS = 33


def differencing(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """The items (by number) of each window. Empty windows are left out."""
    if windows == 1:
        return [list(range(len(sizes)))] if sizes else []
    # a partition: its windows from the fullest to the emptiest, those without items left out
    heap = [(-n, i, [(n, [i])]) for i, n in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:
            # the fullest window of one meets the emptiest of the other; windows without items meet first
            k, m = len(a) - over, len(b) - over
            merged = a[:k] + b[:m] + [(x + y, p + q) for (x, p), (y, q) in zip(a[k:], reversed(b[m:]), strict=True)]
        else:
            merged = a + b
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, min(i, j), merged))
    return [items for _, items in heap[0][2]] if heap else []


def divided(sizes: Sequence[int], capacity: int, waste: float = WASTE) -> list[list[tuple[int, int, int]]]:
    """The spans (item, first id, ids) of each window."""
    total, whole = sum(sizes), lambda ws: [[(i, 0, sizes[i]) for i in w] for w in ws]
    least = -(-total // capacity)
    most = max(least, int(total / (capacity * (1 - waste))))
    first = None
    for count in range(least, most + 1):
        got = differencing(sizes, count)
        if all(sum(sizes[i] for i in w) <= capacity for w in got):
            return whole(got)
        first = first or got
    return _cut(whole(first), least, capacity)


def _cut(windows: list[list[tuple[int, int, int]]], count: int, capacity: int) -> list[list[tuple[int, int, int]]]:
    """The same spans with the surplus of windows above the capacity in others: spans are cut from the end of the longest one."""
    windows += [[] for _ in range(count - len(windows))]
    room = [[capacity - sum(n for *_, n in w), k] for k, w in enumerate(windows)]
    short = sorted(x for x in room if x[0] > 0)
    for gap, k in room:
        while gap < 0:
            at = max(range(len(windows[k])), key=lambda i: windows[k][i][2])
            item, start, n = windows[k][at]
            free = short[-1]
            moved = min(-gap, free[0], n - 1)
            windows[k][at] = (item, start, n - moved)
            windows[free[1]].append((item, start + n - moved, moved))
            gap += moved
            free[0] -= moved
            if not free[0]:
                short.pop()
    return [w for w in windows if w]


def pack(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids with keep_ids) of each piece."""
    path = path or vocabulary_path()
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * keep_ids]
    kinds = [*[pa.int64()] * 6, *[pa.list_(pa.int32())] * keep_ids]
    full = int(capacity * group * (1 - SLACK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, window = encoder(path), TaskContext.get().partitionId() << _WINDOW_BITS
        held: list[tuple[object, int, np.ndarray, int]] = []  # id, where the item starts, its ids, how many its document has
        size = 0
        out: list[tuple] = []

        def put(item: tuple, start: int, n: int, offset: int) -> None:
            doc_id, first, ids, total = item
            part = ids[start : start + n]
            out.append((doc_id, first + start, n, zlib.crc32(part.tobytes()), total, window, offset, *[part.astype(np.int32)] * keep_ids))

        def close() -> None:
            nonlocal window, size
            for spans in divided([len(x[2]) for x in held], capacity):
                at = 0
                for i, start, n in sorted(spans):
                    put(held[i], start, n, at)
                    at += n
                window += 1
            held.clear()
            size = 0

        def drain(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [kind, *kinds], strict=True)], names)

        kind = None
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            kind = batch.column(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                cut = len(ids) - len(ids) % capacity if len(ids) >= capacity else 0
                for a in range(0, cut, capacity):
                    put((doc_id, 0, ids, len(ids)), a, capacity, 0)
                    window += 1
                rest = len(ids) - cut
                if rest:
                    if held and size + rest > full:
                        close()
                    held.append((doc_id, cut, ids[cut:].copy(), len(ids)))
                    size += rest
            if out:
                yield drain(kind)
        if held:
            close()
            yield drain(kind)

    fields = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids
    return src.mapInArrow(run, fields)
