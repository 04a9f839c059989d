"""Byte-level BPE encoding and decoding: speculate, verify, repair.

Greedy longest match proposes the tokens of each distinct piece of text. A sequence of tokens is what
the merges give exactly if every token is what the merges give for its own bytes and every pair of
neighbours is what they give for the bytes of the two; so one vectorised pass over all pairs of
neighbours accepts most pieces, and only the pieces with a failing pair are merged exactly.

A pair fails if some merge joins a token on the right edge of the left one (its right spine) with one on
the left edge of the right one (its left spine) while both still exist. Equal merges go left to right.

Defined results: a null text is empty; an empty text has no ids; texts are whole, of any length; a row
gives a row, so repeated rows repeat; an empty table gives an empty one; other columns of the input are
not read, so their names never clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm import wordscan

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 stands for itself, the rest follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A vocabulary with its merges, for pieces of text in UTF-8."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * self.size
        for s, i in vocab.items():
            self.bytes_of[i] = raw(s)
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.single = [vocab[c] for c in sorted(letters, key=letters.get)]
        self.prefixes: dict[bytes, int] = {}
        for s, i in vocab.items():
            b = raw(s)
            for n in range(1, len(b)):
                self.prefixes.setdefault(b[:n], -1)
            self.prefixes[b] = i
        self.merges: dict[int, tuple[int, int]] = {}
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        born = np.full(self.size, -1)
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.merges.setdefault(i * self.size + j, (rank, k))
            if born[k] < 0:
                born[k], self.left[k], self.right[k] = rank, i, j
        keys = np.array(sorted(self.merges), np.int64)
        self._keys, self._ranks = keys, np.array([self.merges[k][0] for k in keys.tolist()])
        self.never = never = len(self.merges) + 1
        self.rank_of = {k: r for k, (r, _) in self.merges.items()}
        self.made = {r: k for r, k in self.merges.values()}
        self._right_spine, self._right_end = self._spine(self.right, born, never)
        self._left_spine, self._left_end = self._spine(self.left, born, never)
        self._sound = np.zeros(self.size, bool)
        for i in vocab.values():
            self._sound[i] = self.merge(self.bytes_of[i]) == [i]
        lens = np.array([len(b) for b in self.bytes_of])
        self._flat, self._len = np.frombuffer(b"".join(self.bytes_of), np.uint8), lens
        self._at = np.cumsum(lens) - lens
        self.decimal = [str(i) for i in range(self.size)]
        self.coder = wordscan.PieceCoder(self.encode_pieces)

    def _spine(self, child: np.ndarray, born: np.ndarray, never: int) -> tuple[np.ndarray, np.ndarray]:
        """Each token, its child on that edge, the child's child and so on; and the merge that ends each."""
        now, end, spine, ends = np.arange(self.size), np.full(self.size, never), [], []
        while (now >= 0).any():
            spine.append(now)
            ends.append(end)
            at = np.maximum(now, 0)
            end = np.where(now >= 0, born[at], -1)
            now = np.where(now >= 0, child[at], -1)
        return np.stack(spine), np.stack(ends)

    def _joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge of each pair, or -1."""
        k = a * self.size + b
        i = np.minimum(np.searchsorted(self._keys, k), len(self._keys) - 1)
        return np.where((self._keys[i] == k) & (a >= 0) & (b >= 0), self._ranks[i], -1)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge ever crosses the border of each pair of tokens."""
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        for x, x_end in zip(self._right_spine, self._right_end, strict=True):
            live = live[x[a[live]] >= 0]
            inner = live
            for y, y_end in zip(self._left_spine, self._left_end, strict=True):
                inner = inner[y[b[inner]] >= 0]
                if not len(inner):
                    break
                i, j = a[inner], b[inner]
                m = self._joins(x[i], y[j])
                good[inner[(m >= 0) & (m < x_end[i]) & (m <= y_end[j])]] = False
            live = live[good[live]]
        return good

    def greedy(self, b: bytes) -> list[int]:
        """The longest token at each place."""
        out, i, n, get = [], 0, len(b), self.prefixes.get
        while i < n:
            best, stop, j = -1, i + 1, i + 1
            while j <= n:
                t = get(b[i:j])
                if t is None:
                    break
                if t >= 0:
                    best, stop = t, j
                j += 1
            out.append(best)
            i = stop
        return out

    def merge(self, b: bytes) -> list[int]:
        """Exact merging: the lowest merge first, left to right."""
        return self._merge_long(b) if len(b) > 64 else self._merge_short(b)

    def _merge_short(self, b: bytes) -> list[int]:
        """By a list of the ranks of neighbours."""
        ids, size, get, never, made = [self.single[x] for x in b], self.size, self.rank_of.get, self.never, self.made
        ranks = [get(x * size + y, never) for x, y in zip(ids, ids[1:])]
        while ranks:
            m = min(ranks)
            if m == never:
                break
            i = ranks.index(m)
            ids[i] = k = made[m]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] * size + k, never)
            if i < len(ranks):
                ranks[i] = get(k * size + ids[i + 1], never)
        return ids

    def _merge_long(self, b: bytes) -> list[int]:
        """By a heap over a linked list, for pieces of any length."""
        ids = [self.single[x] for x in b]
        n, size, get = len(ids), self.size, self.merges.get
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get(ids[i] * size + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, c, k = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != c:
                continue
            ids[i], ids[j] = k, -1
            nxt[i] = h = nxt[j]
            if h < n:
                prv[h] = i
                if m := get(k * size + ids[h]):
                    heapq.heappush(heap, (m[0], i, k, ids[h], m[1]))
            if (g := prv[i]) >= 0 and (m := get(ids[g] * size + k)):
                heapq.heappush(heap, (m[0], g, ids[g], k, m[1]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in pieces]
        out = [self.greedy(b) for b in raw]
        n = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(n.sum()))
        owner = np.repeat(np.arange(len(out)), n)
        failing = set(owner[~self._sound[flat]].tolist())
        same = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[same] * self.size + flat[same + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing.update(owner[same[~good[back]]].tolist())
        for i in failing:
            out[i] = self.merge(raw[i])
        return out

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text; strings of special tokens are cut out first and get their own id."""
        for a, b in wordscan.slabs(texts):
            part = texts[a:b]
            odd = {i for i, t in enumerate(part) if any(s in t for s in self.special)}
            plain = [t if i not in odd else "" for i, t in enumerate(part)]
            for i, ids in enumerate(self._plain(plain)):
                yield np.array(self._cut(part[i]), np.uint32) if i in odd else ids

    def _plain(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        cp, at = wordscan.points(texts)
        s, e = wordscan.byte_level_cuts(cp, at)
        flat, n = self.coder(cp, s, e)
        stop = np.append(0, np.cumsum(n))[np.searchsorted(s, at)]
        for a, b in zip(stop.tolist(), stop[1:].tolist()):
            yield flat[a:b]

    def _cut(self, text: str) -> list[int]:
        out: list[int] = []
        while text:
            where, s = min(((i, s) for s in self.special if (i := text.find(s)) >= 0), default=(len(text), ""))
            if where:
                out += next(self._plain([text[:where]])).tolist()
            if s:
                out.append(self.special[s])
            text = text[where + len(s) :]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        i = ids.astype(np.int64)
        return self._flat[wordscan.spread(self._at[i], self._len[i])].tobytes().decode("utf-8", "replace")


@cache
def loaded(path: str) -> ByteBpe:
    return ByteBpe(path)


# name -> (Arrow type, Spark type, value from the vocabulary and the ids)
OUTPUTS = {
    "ids": (pa.list_(pa.int32()), "array<int>", lambda v, x: x.astype(np.int32)),
    "n_tokens": (pa.int64(), "long", lambda v, x: len(x)),
    "ids_sha256": (pa.string(), "string", lambda v, x: hashlib.sha256(",".join(map(v.decimal.__getitem__, x.tolist())).encode()).hexdigest()),
    "ids_crc32": (pa.int64(), "long", lambda v, x: zlib.crc32(x.astype("<u4").tobytes())),
    "decoded": (pa.string(), "string", lambda v, x: v.decode(x)),
    "decoded_sha256": (pa.string(), "string", lambda v, x: hashlib.sha256(v.decode(x).encode()).hexdigest()),
}


def encode_decode(docs: DataFrame, outputs: Iterable[str] = ("ids",), id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: its id and the asked outputs (see OUTPUTS). No shuffle: rows stay where they are read."""
    names, path = list(outputs), path or vocabulary_path()
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(path)
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            got: list[list] = [[] for _ in names]
            for ids in v.encode(batch.column(1).to_pylist()):
                for values, name in zip(got, names, strict=True):
                    values.append(OUTPUTS[name][2](v, ids))
            arrays = [pa.array(values, OUTPUTS[name][0]) for values, name in zip(got, names, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *names])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{x} {OUTPUTS[x][1]}" for x in names))


def decode(ids: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """The text of each row's ids; null ids give the empty text."""
    path = path or vocabulary_path()
    src = ids.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(path)
        for batch in batches:
            texts = [v.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")
