"""Sequential packing of ordered records into bins under a token cap.

The fold over records looks sequential, but what a run of records does to a bin depends only on how full the bin is
when the run begins. So the ordered records are range-partitioned and written; each partition tabulates, for every
fill that it may be entered with, the fill it leaves and the bins it opens (fills meet after the first new bin, so
few differ for long, and a table is a few spans); a group that lies in two partitions is the last of one and the first of
the next, so the driver chains the tables of first and last groups alone, one partition after the other; and a second
pass numbers the bins. No task holds a group, whatever its share of the rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.text import shard_name
from loomtext.scratch import stash, width

CAP = 9_500


@dataclass
class _Span:
    """Entries from `start` to the next span's: they open as many bins, and leave the same fill or (grown) their own fill and so much more."""

    start: int
    value: int
    opened: int = 0
    grown: bool = False


def _step(spans: list[_Span], entries: int, tokens: int, cap: int, head: int) -> list[_Span]:
    """What one more record makes of all entries. Entry 0: no record yet; entry i: a bin with the fill head + i - 1."""
    out: list[_Span] = []

    def put(s: _Span) -> None:
        if not out or (out[-1].value, out[-1].opened, out[-1].grown) != (s.value, s.opened, s.grown):
            out.append(s)

    for s, end in zip(spans, [*(x.start for x in spans[1:]), entries], strict=True):
        if s.grown:
            fits = min(max(cap - tokens - head - s.value + 2, s.start), end)
            if fits > s.start:
                put(_Span(s.start, s.value + tokens, 0, True))
            if fits < end:
                put(_Span(fits, head + tokens, 1))
        elif s.value < 0 or s.value + tokens > cap:
            put(_Span(s.start, head + tokens, s.opened + (s.value >= 0)))
        else:
            put(_Span(s.start, s.value + tokens, s.opened))
    return out


def pack(rows: DataFrame, group: Sequence[str], order: Sequence[str], tokens: Column, cap: int = CAP, header_tokens: int = 0) -> DataFrame:
    """The rows with their `shard` number (from 0 in each group). A record above the cap has a bin of its own.

    Null tokens count 0. Ties in the order are dealt in the order of all other columns, so results repeat.
    """
    spark = rows.sparkSession
    group = list(group)
    others = [c for c in rows.columns if c not in {*group, *order}]
    src = rows.withColumn("_tok", F.coalesce(tokens, F.lit(0)).cast("long")).withColumn("_group", F.to_json(F.struct(*group)) if group else F.lit(""))
    keys = ["_group", *order, *(c for c in others if rows.schema[c].dataType.typeName() not in ("map", "variant"))]
    ordered = src.repartitionByRange(width(spark), *keys).sortWithinPartitions(*keys)
    ordered = stash(ordered.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "records")
    deal = lambda c: c.repartition(width(spark), "_part").sortWithinPartitions("_part", "_at")
    last_fill = max(cap, header_tokens)
    entries_of = last_fill - header_tokens + 2  # no record yet, and every fill from the header's size on

    def by_part(batches: Iterator[pa.RecordBatch], each) -> Iterator[pa.RecordBatch]:
        """Calls `each` with runs of rows of one part and group; parts are read whole and in order after the sort."""
        for batch in batches:
            g, p = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            cut = [0, *(i for i in range(1, len(g)) if g[i] != g[i - 1] or p[i] != p[i - 1]), len(g)]
            for a, b in zip(cut, cut[1:]):
                if a < b:
                    yield from each(int(p[a]), g[a], batch.slice(a, b - a))

    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tables of each part's first and last group; the groups between them lie in no other part."""
        now: list = []

        def done(last: bool) -> pa.RecordBatch:
            part, g, spans, first = now
            lists = [pa.array([[int(getattr(s, c)) for s in spans]], pa.list_(pa.int64())) for c in ("start", "value", "opened", "grown")]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([g]), pa.array([first]), pa.array([last]), *lists], ["part", "g", "first", "last", "start", "value", "opened", "grown"])

        def each(part, g, batch):
            nonlocal now
            if not now or now[:2] != [part, g]:
                other = not now or now[0] != part
                if now and (other or now[3]):
                    yield done(other)
                now = [part, g, [_Span(0, -1), _Span(1, 0, grown=True)], other]
            for t in batch.column(3).to_pylist():
                now[2] = _step(now[2], entries_of, t, cap, header_tokens)

        yield from by_part(batches, each)
        if now:
            yield done(True)

    tables = deal(ordered.select("_group", "_part", "_at", "_tok")).mapInArrow(tabulate, "part int, g string, first boolean, last boolean, start array<long>, value array<long>, opened array<long>, grown array<long>")
    # two rows of a few spans for each part at most, however many groups there are; a part's first group may go on from the part before
    entries: dict[int, tuple[str, int, int]] = {}
    left, fill, count = None, -1, 0
    for r in tables.orderBy("part", F.desc("first")).toLocalIterator():
        if not r["first"] or r["g"] != left:
            fill, count = -1, 0
        elif r["g"] == left:
            entries[r["part"]] = (left, fill, count)
        if r["last"]:
            # a bin above the cap: the first record opens a new one, as if none had been there
            over = fill > last_fill
            k = bisect.bisect_right(r["start"], 0 if fill < 0 or over else fill - header_tokens + 1) - 1
            left, fill, count = r["g"], r["value"][k] + (fill if r["grown"][k] else 0), count + r["opened"][k] + over
    shared = spark.sparkContext.broadcast(entries)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = []

        def each(part, g, batch):
            nonlocal now
            if now[:2] != [part, g]:
                before = shared.value.get(part)
                now = [part, g, *(before[1:] if before and before[0] == g else (-1, 0))]
            fill, shard, out = now[2], now[3], []
            for t in batch.column(3).to_pylist():
                if fill >= 0 and fill + t > cap:
                    fill, shard = header_tokens, shard + 1
                elif fill < 0:
                    fill = header_tokens
                fill += t
                out.append(shard)
            now[2:] = [fill, shard]
            yield pa.RecordBatch.from_arrays([batch.column(4), pa.array(out, pa.int64())], ["_row", "shard"])

        yield from by_part(batches, each)

    whole = deal(ordered.select("_group", "_part", "_at", "_tok", F.struct(*rows.columns).alias("_row")))
    numbered = whole.mapInArrow(number, T.StructType([whole.schema["_row"], T.StructField("shard", T.LongType())]))
    return numbered.select("_row.*", "shard")


def with_names(packed: DataFrame, group: Sequence[str], prefix: str = "shard") -> DataFrame:
    """The packed rows with the file name of their shard."""
    keys = [*group, "_all"]
    rows = packed.withColumn("_all", F.lit(0))
    total = rows.groupBy(*keys).agg((F.max("shard") + 1).alias("_n"))
    return rows.join(total if group else F.broadcast(total), keys).withColumn("file", shard_name(prefix, F.col("shard"), F.col("_n"))).drop("_n", "_all")


def _ranged(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows dealt by ranges of group and order, with the number of their range: a group may lie in many."""
    rows = rows.withColumn("_group", F.to_json(F.struct(*group)))
    ranged = rows.repartitionByRange(width(rows.sparkSession), "_group", *order)
    return stash(ranged.withColumn("_part", F.spark_partition_id()), "ranges"), ["_group", "_part"]


def _running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column) -> DataFrame:
    """The rows with `_sum`, the running sum of a number over a group: within a range, and of the ranges before it."""
    rows = rows.withColumn("_value", value.cast("long"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    bases = rows.groupBy(*keys).agg(F.sum("_value").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = F.sum("_value").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_within", within).join(bases, list(keys)).withColumn("_sum", F.col("_base") + F.col("_within")).drop("_base", "_within", "_value")


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "ord") -> DataFrame:
    """The rows with their place in the order of their group, from 1. No task holds a group. Ties are dealt in any order."""
    ranged, keys = _ranged(rows, group, order)
    return _running(ranged, keys, order, F.lit(1)).select(*rows.columns, F.col("_sum").alias(name))


def merge_small(chunks: DataFrame, group: Sequence[str], order: str, tokens: str, least: int = 200) -> DataFrame:
    """Chunks below `least` tokens join the chunk before; the first never joins forward. Gives the number of the merged chunk."""
    ranged, keys = _ranged(chunks, group, [order])
    # the first chunk opens one whatever its size
    first = ranged.groupBy("_group").agg((F.min_by(F.coalesce(F.col(tokens) >= least, F.lit(False)), order)).alias("_first"))
    got = _running(ranged, keys, [order], F.coalesce(F.col(tokens) >= least, F.lit(False)).cast("long")).join(first, "_group")
    return got.select(*chunks.columns, (F.col("_sum") - F.col("_first").cast("long")).alias("merged"))
