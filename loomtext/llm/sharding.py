"""Sharding by a hierarchical weighted hash tree.

A row descends from the root to a region, then to a rack, then to a shard. At each node every child draws
-ln(u) / weight, u being a hash of the row's id and the child's name, and the least draw wins; a child's
chance is its share of the weight. Where a weight changes, only the draws of that child and of the nodes
above it change, so rows move only into or out of those subtrees. `grow` hangs a new shard into a region of
its own: no other draw changes, so rows move only into the new shard.

Defined results: a null text has no bytes; a null id draws like one more id; rows with the same id share a
shard and get slots of their own; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.runtime import stash

ROW_BYTES = 8


@dataclass(frozen=True)
class Tree:
    """Weights of shards: region -> rack -> shard -> weight."""

    regions: Mapping[str, Mapping[str, Mapping[int, float]]] = field(default_factory=dict)

    @staticmethod
    def of(shards: int = 24, regions: int = 2, racks: int = 3) -> Tree:
        """Equal weights; shard s is in region s mod regions, and there in rack (s div regions) mod racks."""
        out: dict[str, dict[str, dict[int, float]]] = {}
        for s in range(shards):
            r, k = s % regions, s // regions % racks
            out.setdefault(f"r{r}", {}).setdefault(f"r{r}k{k}", {})[s] = 1.0
        return Tree(out)

    @property
    def count(self) -> int:
        return sum(len(k) for r in self.regions.values() for k in r.values())

    def grow(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own."""
        n = self.count
        return Tree({**self.regions, f"g{n}": {f"g{n}k": {n: weight}}})

    def reweigh(self, shard: int, weight: float) -> Tree:
        return Tree({r: {k: {s: weight if s == shard else w for s, w in ss.items()} for k, ss in ks.items()} for r, ks in self.regions.items()})


def _child(name: str, weight: float, inner: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), inner.alias("inner"))


def _winner(key: Column, children: Column) -> Column:
    """What the child with the least draw holds; equal draws go to the smaller name."""
    unit = lambda c: (F.shiftrightunsigned(F.xxhash64(key, c["name"]), 12).cast("double") + 0.5) / F.lit(float(1 << 52))
    draws = F.transform(children, lambda c: F.struct((-F.log(unit(c)) / c["weight"]).alias("draw"), c["name"].alias("name"), c["inner"].alias("inner")))
    return F.array_min(draws)["inner"]


def place(key: Column, tree: Tree) -> Column:
    """The shard of a row with this key: three draws, one at each level."""
    regions = []
    for r, racks in tree.regions.items():
        inner = [_child(k, sum(ss.values()), F.array(*(_child(f"{k}s{s}", w, F.lit(s)) for s, w in ss.items()))) for k, ss in racks.items()]
        regions.append(_child(r, sum(w for ss in racks.values() for w in ss.values()), F.array(*inner)))
    return _winner(key, _winner(key, _winner(key, F.array(*regions)))).cast("int")


def shard(docs: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null without `grown`).

    Only ids, sizes and checksums are shuffled. Slots are counted within a shard and input split, and a
    running sum over the splits' counts makes them gapless, so no task holds a whole shard.
    """
    key, raw = F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        place(key, tree).alias("shard"),
        (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.spark_partition_id().alias("split"),
    )
    rows = stash(rows, "shards")
    running = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard", "split").agg(F.count("*").alias("n")).select("shard", "split", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "split").orderBy("doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("within", within).join(bases, ["shard", "split"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("base") + F.col("within")).cast("long").alias("slot"), "grown_shard"
    )
