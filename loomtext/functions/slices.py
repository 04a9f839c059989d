"""Arrow batches in slices: a function that makes Python objects of texts holds those of a slice, not of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


def cuts(columns: tuple[pa.Array, ...], size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have about `size` bytes together; a longer row is a run of its own."""
    rows = len(columns[0])
    total = np.zeros(rows + 1, np.int64)
    for c in columns:
        if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
            total[1:] += np.cumsum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < rows:
        stop = max(at + 1, int(np.searchsorted(total, total[at] + size, "right")) - 1)
        yield at, stop
        at = stop


def by_slices(function: Callable[..., list], kind: pa.DataType, spark_kind: str, *columns: Column, size: int = SLICE_BYTES) -> Column:
    """function(list, ...) -> list, over slices of the columns: what it makes of a slice leaves the worker before the next is read.

    Nondeterministic to the planner, so that it never runs twice for a row.
    """

    def made(arrays: tuple[pa.Array, ...]) -> Iterator[pa.Array]:
        if not len(arrays[0]):
            yield pa.array([], kind)
        for a, b in cuts(arrays, size):
            yield pa.array(function(*(c.slice(a, b - a).to_pylist() for c in arrays)), kind)

    if len(columns) == 1:

        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for c in batches:
                yield from made((c,))

        return F.arrow_udf(one, spark_kind).asNondeterministic()(*columns)

    def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for arrays in batches:
            yield from made(arrays)

    return F.arrow_udf(many, spark_kind).asNondeterministic()(*columns)
