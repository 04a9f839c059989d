"""Token ids in binary files with a canonical, length-limited Huffman code.

Documents are dealt by ranges of their id, so the files in order hold them in ascending order. Code lengths
come from the counts of ids in the whole corpus (package-merge on the driver; as many counts as the
vocabulary has ids). A file holds some hundred thousand ids:

    bytes  0-7    magic
    8-63          seven little-endian uint64: documents, ids, ids in all files before, ids in a block,
                  longest code, bytes of the packed code lengths, 32-bit words of the stream
    then          ids of documents (int64), their validity (bits), their token counts (uint32),
                  the bit offset of each block (uint64), code lengths (zlib, a byte per id),
                  the stream (big-endian 32-bit words)

A block begins at its bit offset and needs nothing before it; so all blocks of a file are decoded side by
side, each step looking up one code for every block in a table over the next bits.

The container is a Parquet table of such files (name, body), because Spark can write and read it in any
store; `export_files` puts the bodies into plain files.

Defined results: a null or empty text has the end id alone; null document ids come first; documents with the
same id follow each other in an order that their text decides; an empty table gives no files and no rows;
other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.bpe import vocabulary_path
from loomtext.llm.runtime import stash, width

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK = 256
FILE_IDS = 1 << 19
MAGIC = b"LOOMTOK1"
_HEAD = struct.Struct("<7Q")
_PLAIN = 0x300  # below: no combining marks, and lower case keeps the number of characters but for U+0130


@cache
def encoder(path: str):
    """Texts to ids as the tokenizers library gives them.

    Texts of plain Latin characters are cut here and each distinct piece is encoded once by that library;
    other texts, and texts with the strings of special tokens, go to it whole.
    """
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    special = [x.content for x in t.get_added_tokens_decoder().values()]
    lower = np.array([ord(chr(c).lower()[0]) for c in range(_PLAIN)], np.uint32)
    coder = wordscan.PieceCoder(lambda words: [x.ids for x in t.encode_batch_fast(words, add_special_tokens=False)])

    def run(texts: Sequence[str]) -> Iterator[np.ndarray]:
        for a, b in wordscan.slabs(texts):
            part = texts[a:b]
            cp, at = wordscan.points(part)
            strange = np.flatnonzero((cp >= _PLAIN) | (cp == 0x130))
            odd = {*(np.searchsorted(at, strange, "right") - 1).tolist(), *(i for i, x in enumerate(part) if any(s in x for s in special))}
            if odd:
                cp, at = wordscan.points([x if i not in odd else "" for i, x in enumerate(part)])
            cp = lower[cp]
            s, e = wordscan.word_level_cuts(cp, at)
            flat, n = coder(cp, s, e)
            stop = np.append(0, np.cumsum(n))[np.searchsorted(s, at)].tolist()
            for i in range(len(part)):
                yield np.array(t.encode(part[i], add_special_tokens=False).ids, np.uint32) if i in odd else flat[stop[i] : stop[i + 1]]

    return run


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """The lengths of an optimal prefix code with no code above `limit` bits, by package-merge; 0 for ids that don't occur."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    rounds: list[np.ndarray] = []
    packs = np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, packs])
        rank = np.argsort(merged, kind="stable")
        rounds.append(rank < len(leaves))
        merged = merged[rank]
        packs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(rounds):
        n = int(is_leaf[:take].sum())
        out[order[:n]] += 1
        take = 2 * (take - n)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: shorter first, then smaller ids first."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    used = np.flatnonzero(lengths)
    for i in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def lookup(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """id * 32 + length for each value of the next `longest` bits."""
    longest = int(lengths.max(initial=1))
    out = np.zeros(1 << longest, np.uint32)
    codes = canonical(lengths)
    used = np.flatnonzero(lengths)
    n = lengths[used].astype(np.int64)
    first = codes[used].astype(np.int64) << (longest - n)
    out[wordscan.spread(first, 1 << (longest - n))] = np.repeat((used * 32 + n).astype(np.uint32), 1 << (longest - n))
    return out, longest


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stream as 32-bit words, and the bit offset of each block."""
    if not len(ids):
        return np.zeros(0, ">u4"), np.zeros(0, np.uint64)
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    pos = end - n
    word = pos >> 5
    bits = codes[ids] << (64 - (pos & 31) - n).astype(np.uint64)
    head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    out = np.zeros(int(end[-1] >> 5) + 3, np.uint64)
    out[word[head]] += np.add.reduceat(bits >> np.uint64(32), head)
    out[word[head] + 1] += np.add.reduceat(bits & np.uint64(0xFFFFFFFF), head)
    return out[: int(end[-1] + 31 >> 5)].astype(">u4"), pos[::BLOCK].astype(np.uint64)


def unpack_bits(words: np.ndarray, blocks: np.ndarray, count: int, table: np.ndarray, longest: int, block: int = BLOCK) -> np.ndarray:
    """The ids again; all blocks go forward together."""
    w = np.concatenate([words.astype(np.uint64), np.zeros(2, np.uint64)])
    pair = (w[:-1] << np.uint64(32)) | w[1:]
    at, out = blocks.astype(np.int64), np.zeros((len(blocks), block), np.uint32)
    for k in range(min(block, count)):
        shift = (64 - longest - (at & 31)).astype(np.uint64)
        found = table[((pair[np.minimum(at >> 5, len(pair) - 1)] >> shift) & np.uint64((1 << longest) - 1)).astype(np.int64)]
        out[:, k] = found >> 5
        at += found & 31
    return out.reshape(-1)[:count]


def write_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, before: int, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    words, blocks = pack_bits(ids, codes, lengths)
    packed = zlib.compress(lengths.tobytes(), 6)
    valid = np.packbits(np.array([x is not None for x in doc_ids], bool)).tobytes()
    head = _HEAD.pack(len(doc_ids), len(ids), before, BLOCK, int(lengths.max(initial=1)), len(packed), len(words))
    return b"".join([MAGIC, head, np.array([x or 0 for x in doc_ids], "<i8").tobytes(), valid, counts.astype("<u4").tobytes(), blocks.astype("<u8").tobytes(), packed, words.tobytes()])


_tables: dict[bytes, tuple[np.ndarray, int]] = {}


def read_file(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """Ids of documents, token counts, token ids, ids in all files before."""
    if body[:8] != MAGIC:
        raise ValueError("no token file")
    docs, n, before, block, longest, packed, words = _HEAD.unpack_from(body, 8)
    at = 8 + _HEAD.size

    def part(kind: str, count: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(body, kind, count, at)
        at += x.nbytes
        return x

    doc_ids, valid, counts, blocks = part("<i8", docs), part("u1", -(-docs // 8)), part("<u4", docs), part("<u8", -(-n // block))
    lengths = part("u1", packed).tobytes()
    if lengths not in _tables:
        _tables.clear()
        _tables[lengths] = lookup(np.frombuffer(zlib.decompress(lengths), np.uint8))
    table, longest = _tables[lengths]
    ids = unpack_bits(part(">u4", words), blocks, n, table, longest, block)
    known = np.unpackbits(valid, count=docs).astype(bool).tolist()
    return [x if k else None for x, k in zip(doc_ids.tolist(), known, strict=True)], counts.astype(np.int64), ids, before


def _segments(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """Runs of whole documents in ascending order: part, before (ids of the part before the run), doc_ids, counts, ids."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = ["doc_id", "tie", "row"]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"))
    src = src.repartitionByRange(width(docs.sparkSession), *keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(path), TaskContext.get().partitionId(), 0
        names: list = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate(held)  # never empty: each document ends with an id
            ids = ids.astype("<u2" if int(ids.max()) < 1 << 16 else "<u4")
            values = [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([ids.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(values, ["part", "before", "n", "doc_ids", "counts", "ids"])

        end = np.array([end_id], np.uint32)
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            for name, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                if held and size + len(ids) + 1 > FILE_IDS:
                    yield row()
                    before += size
                    names, counts, held, size = [], [], [], 0
                names.append(name)
                counts.append(len(ids) + 1)
                held += [ids, end]
                size += len(ids) + 1
        if held:
            yield row()

    return src.mapInArrow(run, "part int, before long, n long, doc_ids array<long>, counts array<long>, ids binary")


def _ids(body: bytes, n: int) -> np.ndarray:
    return np.frombuffer(body, "<u2" if len(body) == 2 * n else "<u4").astype(np.int64)


def write(docs: DataFrame, to: str | None = None, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode documents, write the files (to the table `to`, else to the shared folder) and return (name, body) as read from there."""
    spark, path = docs.sparkSession, path or vocabulary_path(VOCABULARY)
    runs = stash(_segments(docs, id_col, text_col, path, end_id), "tokens")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for body, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.bincount(_ids(body, n))
                if len(x) > len(total):
                    x, total = total, x
                total[: len(x)] += x
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    # as many rows as the vocabulary has ids, and as many as there are parts: neither grows with the corpus
    found = runs.select("ids", "n").mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    counts = np.zeros(max(found["id"], default=0) + 1, np.int64)
    counts[found["id"]] = found["n"]
    lengths = code_lengths(counts, int(np.ceil(np.log2(max(2, len(counts))))) + 3)
    sums = sorted((r["part"], r["n"]) for r in runs.groupBy("part").agg(F.sum("n").alias("n")).collect())
    bases = dict(zip((p for p, _ in sums), np.cumsum([0, *(n for _, n in sums)]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((lengths, canonical(lengths), bases))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, codes, bases = shared.value
        for batch in batches:
            for r in batch.to_pylist():
                body = write_file(r["doc_ids"], np.array(r["counts"]), _ids(r["ids"], r["n"]), bases[r["part"]] + r["before"], lengths, codes)
                yield pa.RecordBatch.from_arrays([pa.array([f"tokens-{bases[r['part']] + r['before']:020d}.bin"]), pa.array([body], pa.binary())], ["name", "body"])

    files = runs.mapInArrow(code, "name string, body binary")
    if to is None:
        return stash(files, "tokenfiles")
    files.write.parquet(to)
    return spark.read.parquet(to)


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of each document in the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0).to_pylist():
                doc_ids, counts, ids, before = read_file(body)
                ends = np.cumsum(counts)
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[e - n : e].tobytes()) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(before + ends - counts), pa.array(counts), pa.array(crc, pa.int64()), lists], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return files.select("body").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def export_files(files: DataFrame, folder: str) -> int:
    """Write the bodies as plain files into a folder of the driver's machine, one at a time; returns how many."""
    n = 0
    for n, r in enumerate(files.toLocalIterator(), 1):
        with open(f"{folder}/{r['name']}", "wb") as f:
            f.write(r["body"])
    return n


def entries(spark: SparkSession, table: str) -> DataFrame:
    """What `read` gives for a table that `write` has written."""
    return read(spark.read.parquet(table))
