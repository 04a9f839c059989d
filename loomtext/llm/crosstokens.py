"""Cross-tokenizer alignment, relationally: where the tokens of two vocabularies end together, and which overlap.

No token of either vocabulary reaches over the border between something other than white space and a space after it, so
texts fall into units there (" alpha", " beta,") whose tokens don't depend on their neighbours, and every such border
is a cut of both. Each distinct unit of the corpus is aligned once:

* posexplode its ids, look up the byte length of each (both vocabularies are small, fixed tables), and sum these over
  a window: where each token ends;
* equi-join both sides on unit and end. Ends that only one side has come along as outer rows;
* running counts of the common ends number the groups;
* two tokens overlap exactly where one stretch between neighbouring ends (of either side) lies in both, and no two
  stretches lie in the same two tokens. So a link is a row of the join, with the first token of each side that ends
  there or later: the range join needs no pairs of a group to be tried.

Documents hold their units as numbers of a slab: `SLAB_BYTES` of texts, or one longer text. A slab's units and
documents meet in one task. In how many documents an id pair is linked is counted in each slab and summed over
slabs; the counts go back as one row for each slab and pair, so no unit and no pair is a hot key anywhere.

Defined results: null and empty texts, and texts whose tokens' bytes are not a space and the text, have no tokens;
texts are whole, of any length; a row gives a row, so repeated rows repeat and count as documents each; an empty table
gives an empty one; only the id and the text are read, so no other column's name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.bpe import byte_letters, vocabulary_path
from loomtext.llm.runtime import release, stash

PIECES = "piece_bpe_32k.model"
SLAB_BYTES = 16 << 20
_SLAB_BITS = 31
_B_BITS = 24
_A_ENDS, _B_ENDS = 1, 2


class Pair(NamedTuple):
    """The two tokenizers: functions from units to ids, and the bytes of each id."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]


@cache
def tokenizers(path_a: str, path_b: str) -> Pair:
    """A: a byte-level vocabulary whose special strings are plain text. B: pieces; it puts a space before the text itself."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    letters = byte_letters()
    special = a.get_added_tokens_decoder()
    bytes_a = [special[i].content.encode() if i in special else bytes(letters[c] for c in a.id_to_token(i) or "") for i in range(a.get_vocab_size())]
    b = SentencePieceProcessor(model_file=path_b)
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    crossing = [x for x in bytes_b if b" " in x.lstrip(b" ")]
    if crossing:
        raise ValueError(f"pieces reach over a space, so units would not be independent: {crossing[:3]}")
    encode_a = lambda units: [x.ids for x in a.encode_batch_fast(units, add_special_tokens=False)]
    space = [b.piece_to_id("▁")]  # the library gives an empty text no piece, but a last space has one
    encode_b = lambda units: [space if u == " " else ids for u, ids in zip(units, b.encode([u[1:] for u in units], num_threads=1), strict=True)]
    return Pair(encode_a, encode_b, bytes_a, bytes_b)


def unit_cuts(cp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units (start, end): each text is cut before every space that follows something other than white space."""
    first = np.zeros(len(cp) + 1, bool)
    first[at] = True
    cut = first[: len(cp)].copy()
    if len(cp):
        white = wordscan.classes()[cp] == wordscan.SPACE
        cut[1:] |= (cp[1:] == 0x20) & ~white[:-1]
    s = np.flatnonzero(cut)
    return s, np.append(s[1:], len(cp))


def cut(docs: DataFrame, slab_bytes: int = SLAB_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of two kinds, for each slab s. Units: u and the text. Documents: doc_id and the units in order."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["doc_id", "s", "u", "unit", "seq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, size, number = TaskContext.get().partitionId() << _SLAB_BITS, 0, {}

        def units() -> pa.RecordBatch:
            n = len(number)
            return pa.RecordBatch.from_arrays([pa.nulls(n, kind), pa.array(np.full(n, slab)), pa.array(range(n), pa.int32()), pa.array(number, pa.string()), pa.nulls(n, pa.list_(pa.int32()))], names)

        for batch in wordscan.small(batches, lambda b: b.column(1)):
            kind = batch.column(0).type
            texts = batch.column(1).to_pylist()
            n = sum(map(len, texts))
            if size and size + n > slab_bytes:
                yield units()
                slab, size, number = slab + 1, 0, {}
            size += n
            cp, at = wordscan.points([" " + t if t else "" for t in texts])
            s, e = unit_cuts(cp, at)
            letters, get = cp.tobytes().decode("utf-32-le"), number.setdefault
            seq = np.fromiter((get(letters[i:j], len(number)) for i, j in zip(s.tolist(), e.tolist())), np.int32, len(s))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(s, at), pa.int32()), pa.array(seq))
            n = len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, slab)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), lists], names)
        if number:
            yield units()

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, s long, u int, unit string, seq array<int>")


def encoded(units: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """unit and its ids a and b; null ids where the bytes of the tokens are not the unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, lists = tokenizers(path_a, path_b), pa.list_(pa.int32())
        for batch in wordscan.small(batches, lambda b: b.column(0), 1 << 18):
            texts = batch.column(0).to_pylist()
            a, b = p.encode_a(texts), p.encode_b(texts)
            for i, t in enumerate(texts):
                if not b"".join([p.bytes_a[x] for x in a[i]]) == t.encode() == b"".join([p.bytes_b[x] for x in b[i]]):
                    a[i] = b[i] = None
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, lists), pa.array(b, lists)], ["unit", "a", "b"])

    return units.mapInArrow(run, "unit string, a array<int>, b array<int>")


def _lengths(spark: SparkSession, bytes_of: list[bytes]) -> DataFrame:
    """The byte length of each id: as many rows as the vocabulary has entries."""
    return spark.createDataFrame(pa.table({"id": pa.array(range(len(bytes_of)), pa.int32()), "n": pa.array(map(len, bytes_of), pa.int32())}))


def ends(units: DataFrame, side: str, lengths: DataFrame) -> DataFrame:
    """v, the id of each token of that side, and the byte offset where it ends."""
    tokens = units.repartition("v").select("v", F.posexplode(side).alias("pos", "id")).join(F.broadcast(lengths), "id")
    so_far = Window.partitionBy("v").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return tokens.select("v", F.col("id").alias(side), F.sum("n").over(so_far).cast("int").alias("end"))


def links(units: DataFrame, lengths_a: DataFrame, lengths_b: DataFrame) -> DataFrame:
    """A row for each linked pair of tokens of a unit v: where their common stretch ends, ids a and b, which of them end
    there, and g, the number of the group (from the unit's end, from 1)."""
    both = ends(units, "a", lengths_a).join(ends(units, "b", lengths_b), ["v", "end"], "full")
    from_end = Window.partitionBy("v").orderBy(F.col("end").desc()).rowsBetween(Window.unboundedPreceding, 0)
    a_ends, b_ends = F.col("a").isNotNull(), F.col("b").isNotNull()
    covering = lambda c: F.last(c, ignorenulls=True).over(from_end).alias(c)
    return both.select("v", "end", covering("a"), covering("b"), a_ends.alias("a_ends"), b_ends.alias("b_ends"), F.sum((a_ends & b_ends).cast("int")).over(from_end).alias("g"))


def _code(a: Column, b: Column, a_ends: Column, b_ends: Column) -> Column:
    """A link as one number: the pair, and which tokens end with it."""
    pair = F.shiftleft(a.cast("long"), _B_BITS).bitwiseOR(b.cast("long"))
    return F.shiftleft(pair, 2).bitwiseOR(a_ends.cast("long") * _A_ENDS + b_ends.cast("long") * _B_ENDS)


def aligned(units: DataFrame, lengths_a: DataFrame, lengths_b: DataFrame) -> DataFrame:
    """v and the codes of its links in order."""
    row = F.struct("end", _code(F.col("a"), F.col("b"), F.col("a_ends"), F.col("b_ends")).alias("code"))
    return links(units, lengths_a, lengths_b).groupBy("v").agg(F.sort_array(F.collect_list(row))["code"].alias("codes"))


class Alignment(NamedTuple):
    """units: s, u, unit (its text), codes (null: no tokens fit it). documents: s, doc_id, seq (units in order)."""

    units: DataFrame
    documents: DataFrame


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, slab_bytes: int = SLAB_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    path_a, path_b = path_a or vocabulary_path(), path_b or vocabulary_path(PIECES)
    pair = tokenizers(path_a, path_b)
    lengths = [_lengths(docs.sparkSession, x) for x in (pair.bytes_a, pair.bytes_b)]
    rows = stash(cut(docs, slab_bytes, id_col, text_col), "slabs")
    held = rows.where("u IS NOT NULL").select("s", "u", "unit")
    distinct = stash(encoded(held.select("unit").distinct(), path_a, path_b).withColumn("v", F.monotonically_increasing_id()), "units")
    with _dealt_once(docs.sparkSession):
        coded = stash(distinct.select("v", "unit").join(aligned(distinct, *lengths), "v", "left").select("unit", "codes"), "aligned")
    release(distinct)
    units = stash(held.join(coded, "unit"), "links")
    release(coded)
    return Alignment(units, rows.where("u IS NULL").select(F.col("s").alias("s"), "doc_id", "seq"))


@contextmanager
def _dealt_once(spark: SparkSession) -> Iterator[None]:
    """Tokens dealt by their unit stay where they are for the join on unit and end: units are many, so the join needs no second exchange."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class _Slab:
    """A slab's units and documents as arrays: the links of all units, and for each document where its units are in them."""

    def __init__(self, units: pa.Table, documents: pa.Table) -> None:
        codes = _one(units, "codes")
        u = units.column("u").to_numpy()
        place = np.zeros(int(u.max()) + 1 if len(u) else 1, np.int64)
        place[u] = np.arange(len(u))
        n = pc.fill_null(pc.list_value_length(codes), 0).to_numpy().astype(np.int64)
        self.cuts = np.append(0, np.cumsum(n))
        self.codes = codes.flatten().to_numpy()
        seq = _one(documents, "seq")
        self.seq = place[seq.flatten().to_numpy()]
        owner_cuts = np.append(0, np.cumsum(pc.list_value_length(seq).to_numpy().astype(np.int64)))
        odd = n == 0  # a unit without tokens leaves its documents without any
        if odd.any():
            owner = np.repeat(np.arange(len(seq)), np.diff(owner_cuts))
            bad = np.zeros(len(seq), bool)
            bad[owner[odd[self.seq]]] = True
            keep = ~bad[owner]
            self.seq = self.seq[keep]
            owner_cuts = np.append(0, np.cumsum(np.bincount(owner[keep], minlength=len(seq))))
        self.doc_cuts = owner_cuts


def _one(table: pa.Table, name: str) -> pa.Array:
    got = table.column(name).combine_chunks()
    return got.chunk(0) if isinstance(got, pa.ChunkedArray) else got


def _in_slab(units: pa.Table, documents: pa.Table) -> pa.Table:
    """s, pair, and how many of the slab's documents hold it linked."""
    x = _Slab(units, documents)
    pairs, number = np.unique(x.codes >> 2, return_inverse=True)
    total = np.zeros(len(pairs), np.int64)
    docs = len(x.doc_cuts) - 1
    owner = np.repeat(np.arange(docs), np.diff(x.doc_cuts))
    once = np.unique(owner * (len(x.cuts) - 1) + x.seq)  # a unit of a document once
    owner, unit = np.divmod(once, max(1, len(x.cuts) - 1))
    n = np.diff(x.cuts)[unit]
    size = np.cumsum(n)
    at = 0
    while at < len(unit):
        # whole documents, of about a million links at a time
        stop = int(np.searchsorted(size, (size[at - 1] if at else 0) + (1 << 20), "right"))
        stop = int(np.searchsorted(owner, owner[max(stop - 1, at)], "right"))
        links_at = wordscan.spread(x.cuts[unit[at:stop]], n[at:stop])
        seen = np.unique(np.repeat(owner[at:stop], n[at:stop]) * len(pairs) + number[links_at])
        total += np.bincount(seen % len(pairs), minlength=len(pairs))
        at = stop
    some = total > 0
    s = documents.column("s")[0].as_py() if len(documents) else 0
    return pa.table({"s": pa.array(np.full(int(some.sum()), s)), "pair": pa.array(pairs[some]), "n": pa.array(total[some])})


def pair_counts(found: Alignment) -> DataFrame:
    """For each slab s and pair in it: the number of documents of the corpus that hold the pair linked, and whether its A id has no pair with more."""
    in_slab = found.units.select("s", "u", "codes").groupBy("s").cogroup(found.documents.groupBy("s")).applyInArrow(_in_slab, "s long, pair long, n long")
    in_slab = stash(in_slab, "pairs")
    total = in_slab.select("s", "pair", F.shiftright("pair", _B_BITS).alias("a"), F.sum("n").over(Window.partitionBy("pair")).alias("count"))
    most = total.groupBy("a").agg(F.max("count").alias("most"))  # no more rows than the vocabulary has entries
    return total.join(F.broadcast(most), "a").select("s", "pair", "count", (F.col("count") == F.col("most")).alias("best"))


@cache
def _labels(n: int) -> list[str]:
    """Ids in decimal with what may follow them: a comma, a bar, a semicolon; n of each."""
    return [f"{i}{x}" for x in ",|;" for i in range(n)]


def _texts(codes: np.ndarray, cuts: np.ndarray) -> list[str]:
    """The groups of each unit as text, with a semicolon at the end; about a million links at a time."""
    n = 1 + int(max((codes >> _B_BITS + 2).max(initial=0), (codes >> 2 & ((1 << _B_BITS) - 1)).max(initial=0)))
    names, out, first = _labels(n), [], 0
    while first < len(cuts) - 1:
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + (1 << 20), "right")) - 1)
        part = codes[cuts[first] : cuts[last]]
        pair, a_ends, b_ends = part >> 2, part & _A_ENDS > 0, part & _B_ENDS > 0
        both = a_ends & b_ends
        group = np.cumsum(both) - both
        i, j = np.flatnonzero(a_ends), np.flatnonzero(b_ends)
        label = np.concatenate([(pair[i] >> _B_BITS) + np.where(both[i], n, 0), (pair[j] & ((1 << _B_BITS) - 1)) + np.where(both[j], 2 * n, 0)])
        order = np.argsort(np.concatenate([2 * group[i], 2 * group[j] + 1]), kind="stable")
        words = [names[x] for x in label[order].tolist()]
        at = np.append(0, np.cumsum(a_ends.astype(np.int64) + b_ends))[cuts[first : last + 1] - cuts[first]].tolist()
        out += ["".join(words[x:y]) for x, y in zip(at, at[1:])]
        first = last
    return out


_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def digests(found: Alignment) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    counts = pair_counts(found)
    id_type = found.documents.schema["doc_id"].dataType
    right = found.documents.unionByName(counts, allowMissingColumns=True)
    names = ["doc_id", *_SUMS, "groups_sha256"]

    def run(units: pa.Table, mixed: pa.Table) -> pa.Table:
        told = pc.is_valid(mixed.column("pair"))
        documents, counted = mixed.filter(pc.invert(told)), mixed.filter(told)
        x = _Slab(units, documents)
        order = np.argsort(counted.column("pair").to_numpy())
        at = np.searchsorted(counted.column("pair").to_numpy()[order], x.codes >> 2)
        at = order[np.minimum(at, len(order) - 1)] if len(order) else at * 0
        values = {
            "n_a": x.codes & _A_ENDS > 0, "n_b": x.codes & _B_ENDS > 0, "n_groups": x.codes & 3 == 3, "n_links": np.ones(len(x.codes), np.int64),
            "n_best": counted.column("best").to_numpy(zero_copy_only=False)[at] if len(order) else at, "count_sum": counted.column("count").to_numpy()[at] if len(order) else at,
        }
        sums = []
        for c in _SUMS:
            unit = np.diff(np.append(0, np.cumsum(values[c].astype(np.int64)))[x.cuts])
            sums.append(pa.array(np.diff(np.append(0, np.cumsum(unit[x.seq]))[x.doc_cuts]), pa.int64()))
        text, c = _texts(x.codes, x.cuts), x.doc_cuts.tolist()
        hashed = [hashlib.sha256("".join([text[i] for i in x.seq[p:q].tolist()])[:-1].encode()).hexdigest() if q > p else "" for p, q in zip(c, c[1:])]
        return pa.Table.from_arrays([_one(documents, "doc_id"), *sums, pa.array(hashed, pa.string())], names)

    schema = f"doc_id {id_type.simpleString()}, " + ", ".join(f"{c} long" for c in _SUMS) + ", groups_sha256 string"
    return found.units.select("s", "u", "codes").groupBy("s").cogroup(right.groupBy("s")).applyInArrow(run, schema)
