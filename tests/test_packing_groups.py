"""Sequential packing against a plain loop: one group, a few, and as many that no table may have a row for each."""

import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import packing


def plainly(rows, cap, head):
    out, state = {}, {}
    for g, o, t in sorted(rows):
        fill, shard = state.get(g, (-1, 0))
        if fill >= 0 and fill + t > cap:
            fill, shard = head, shard + 1
        elif fill < 0:
            fill = head
        state[g] = fill + t, shard
        out[g, o] = shard
    return out


@pytest.mark.parametrize(("groups", "n"), [(1, 3_000), (3, 3_000), (100_000, 150_000)])
def test_pack_equals_loop(spark, groups, n):
    rnd = random.Random(1)
    rows = [(f"g{rnd.randrange(groups):06d}", i, rnd.choice([0, 3, 50, 120, 700])) for i in range(n)]
    packed = packing.pack(spark.createDataFrame(rows, "g string, o int, t int"), ["g"], ["o"], F.col("t"), 500, 10)
    assert {(r["g"], r["o"]): r["shard"] for r in packed.collect()} == plainly(rows, 500, 10)
