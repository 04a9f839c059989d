"""Reading vectors: which take part, and as arrays."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(c: str) -> Column:
    """Not null, not empty, without null or non-finite components, and not all zero."""
    v = F.col(c).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def packed(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, row (a number of its own) and v (the components, little-endian: floats of a table of floats, else doubles) of usable rows.

    Stash it before using row.
    """
    single = rows.schema[vec_col].dataType.simpleString() == "array<float>"
    vector = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")
    src = rows.where(usable(vec_col)).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"), F.monotonically_increasing_id().alias("row"))

    def run(batches):
        for batch in batches:
            v = batch.column(1)
            flat, ends = v.flatten().to_numpy(zero_copy_only=False).astype("<f4" if single else "<f8"), v.offsets.to_numpy()
            ends = (ends - ends[0]).tolist()
            body = pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), body, pa.array(np.diff(ends), pa.int32())], ["vec_id", "row", "v", "dim"])

    return src.mapInArrow(run, "vec_id long, row long, v binary, dim int")


def matrix(bodies, dim: int) -> np.ndarray:
    """The vectors as doubles."""
    raw = b"".join(bodies)
    return np.frombuffer(raw, "<f4" if len(raw) == 4 * dim * len(bodies) else "<f8").reshape(-1, dim).astype(np.float64)


@cache
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))
