"""Whole-text scans over numpy arrays: cut many texts at once and name every piece by a 64-bit hash.

The words of a text are never looped over one by one in Python. A slab of texts becomes one array of
code points; classes, cuts and hashes come from array operations, and only pieces with a
hash that was not met before are handled as strings.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, NUMBER, SPACE = range(4)
# The Unicode characters with the property White_Space.
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SLAB = 600_000
SLICE_BYTES = 2 << 20
_PLACE, _LENGTH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@cache
def classes() -> np.ndarray:
    """The class of each code point: letter, number, white space or other.

    Code points that Python's Unicode tables don't know are asked of the tokenizers library, whose tables are newer.
    """
    from tokenizers import Regex, pre_tokenizers

    out = np.zeros(0x110000, np.uint8)
    unknown = []
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = NUMBER
        elif kind == "Cn" and c < 0x40000:
            unknown.append(chr(c))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        for piece, _ in pre_tokenizers.Split(Regex(pattern + "+"), "removed", invert=True).pre_tokenize_str("".join(unknown)):
            out[[ord(x) for x in piece]] = kind
    out[list(WHITE)] = SPACE
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each units[start:end]; the ranges are in order and don't overlap.

    A unit is mixed with its place before anything is summed. Sums of units times powers would be faster, but modulo
    2 ** 64 they are equal for simple patterns, such as a Thue-Morse word of 1,024 letters and its mirror image.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    base = np.zeros(len(units) + 1, np.int64)
    base[starts] = starts
    np.maximum.accumulate(base, out=base)
    place = (np.arange(len(units)) - base[:-1]).astype(np.uint64)
    place += np.uint64(1)
    place *= _PLACE
    place += units
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(mix(place), out=total[1:])
    return mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64) * _LENGTH)


def slabs(texts: Sequence[str], size: int = SLAB) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `size` characters; a longer text is a run of its own."""
    at = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t) > size:
            yield at, i
            at, n = i, 0
        n += len(t)
    if at < len(texts):
        yield at, len(texts)


def small(batches: Iterator[pa.RecordBatch], texts: Callable[[pa.RecordBatch], pa.Array], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about `size` bytes (or in rows of their own), so that a task holds few texts as strings."""
    for batch in batches:
        total = np.cumsum(np.append(0, pc.fill_null(pc.binary_length(texts(batch)), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
        at = 0
        while at < len(batch):
            stop = max(at + 1, int(np.searchsorted(total, total[at] + size, "right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop


def points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts, and where each text starts, with the end at last."""
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=at[1:])
    return cp, at


def octets(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same for UTF-8 bytes."""
    raw = [t.encode() for t in texts]
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)), out=at[1:])
    return np.frombuffer(b"".join(raw), np.uint8), at


def _first(cp: np.ndarray, at: np.ndarray) -> np.ndarray:
    first = np.zeros(len(cp) + 1, bool)
    first[at] = True
    return first


def _elisions(cp: np.ndarray, kind: np.ndarray, first: np.ndarray, start: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll at the start of a piece are pieces of their own."""
    n = len(cp)
    quote = np.flatnonzero((cp == 0x27) & start[:n])
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~first[quote + 1]]
    if not len(quote):
        return
    one = np.isin(cp[quote + 1], [ord(c) for c in "stmd"])
    p = quote[one]
    start[p + 1] = False
    start[p + 2] = True
    p = quote[~one]
    p = p[p + 2 < n]
    p = p[~first[p + 2]]
    a, b = cp[p + 1], cp[p + 2]
    p = p[((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))]
    start[p + 1] = False
    start[p + 3] = True


def byte_level_cuts(cp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (start, end) of a byte-level vocabulary: a run of one class with one space before it, white space apart."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind, first = classes()[cp], _first(cp, at)
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
    start[last] = True
    start[last[cp[last] == 0x20] + 1] = False
    _elisions(cp, kind, first, start)
    s = np.flatnonzero(start[:n])
    return s, np.append(s[1:], n)


def word_level_cuts(cp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (start, end) of a vocabulary with word ends: runs of letters, single numbers, runs of others; no white space."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind, first = classes()[cp], _first(cp, at)
    start = first.copy()
    start[1:n] |= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    _elisions(cp, kind, first, start)
    s = np.flatnonzero(start[:n])
    e = np.append(s[1:], n)
    keep = kind[s] != SPACE
    return s[keep], e[keep]


def stretches(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches (start, end) where the mask holds; each ends with its text."""
    n = len(mask)
    word = np.append(mask, False)
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    head = at[:-1][at[:-1] < n]
    begins[head] = word[head]
    s = np.flatnonzero(begins)
    stop = ~word
    stop[at] = True
    stops = np.flatnonzero(stop)
    return s, stops[np.searchsorted(stops, s, "right")]


def blank_cuts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (start, end) of UTF-8 bytes between the bytes 0x20 and 0x09 to 0x0D."""
    return stretches((raw != 0x20) & ((raw < 0x09) | (raw > 0x0D)), at)


def spread(offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of all elements of the ranges offset to offset + length, one range after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(offset - (ends - length), length) + np.arange(total)


_FILL = np.array([0, (1 << 21) - 1, (1 << 42) - 1, (1 << 63) - 1], np.uint64)


def triples(cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each cp[s:e] as words of three letters (code point + 1, so that no letter is 0), one word at least; where its words start and end."""
    letter = np.zeros(len(cp) + 3, np.uint64)
    np.add(cp, 1, out=letter[:-3], casting="unsafe")
    every = letter[:-2] | letter[1:-1] << np.uint64(21)
    every[:-1] |= letter[2:-1] << np.uint64(42)
    n = np.maximum(1, (e - s + 2) // 3)
    end = np.cumsum(n)
    start = end - n
    words = every[np.repeat(s - 3 * start, n) + 3 * np.arange(int(end[-1]))]
    words[end - 1] &= _FILL[e - s - 3 * (n - 1)]
    return words, start, end


class _Buffer:
    """An array that grows at its end."""

    def __init__(self, kind: type = np.uint32, *shape: int) -> None:
        self.data, self.used = np.zeros((1 << 12, *shape), kind), 0

    def add(self, x: np.ndarray) -> int:
        """Where x starts."""
        at, end = self.used, self.used + len(x)
        if end > len(self.data):
            more = np.zeros((max(end, 2 * len(self.data)) - at, *self.data.shape[1:]), self.data.dtype)
            self.data = np.concatenate([self.data[:at], more])
        self.data[at:end] = x
        self.used = end
        return at


class PieceCoder:
    """Ids of pieces; `encode` gets the strings of the pieces that are new.

    Pieces are found by hash and then compared by their letters, so equal hashes of different pieces change nothing:
    such pieces are encoded on their own. About `room` bytes are kept from one slab to the next; what goes is only
    encoded again.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], room: int = 64 << 20) -> None:
        self.encode, self.room = encode, room
        self.forget()

    def forget(self) -> None:
        self.slots = np.full(1 << 12, -1, np.int32)  # numbers of pieces, from the lowest bits of the hash on the next free slot
        self.keys, self.rows = _Buffer(np.uint64), _Buffer(np.int32, 4)  # by number: hash; first word, words, first id, ids
        self.words, self.ids = _Buffer(np.uint64), _Buffer()

    def _bytes(self) -> int:
        return self.slots.nbytes + 24 * self.keys.used + 8 * self.words.used + 4 * self.ids.used

    def _strings(self, cp: np.ndarray, s: np.ndarray, n: np.ndarray) -> list[str]:
        text = cp[spread(s, n)].tobytes().decode("utf-32-le")
        cut = np.append(0, np.cumsum(n)).tolist()
        return [text[a:b] for a, b in zip(cut, cut[1:])]

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.encode(pieces)
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum())), n

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        last = len(self.slots) - 1
        at = (keys & np.uint64(last)).astype(np.int64)
        out = self.slots[at]
        live = np.flatnonzero((out >= 0) & (self.keys.data[out] != keys))
        at = at[live]
        while len(live):
            at = at + 1 & last
            out[live] = n = self.slots[at]
            go = (n >= 0) & (self.keys.data[n] != keys[live])
            live, at = live[go], at[go]
        return out

    def _enter(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct hashes that have no number yet."""
        last = len(self.slots) - 1
        at = (keys & np.uint64(last)).astype(np.int64)
        while len(at):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]
            rest = self.slots[at] != numbers  # of several for one slot the last has it
            at, numbers = at[rest] + 1 & last, numbers[rest]

    def _learn(self, keys: np.ndarray, rows: np.ndarray) -> int:
        """The number of the first of them."""
        self.keys.add(keys)
        at, n = self.rows.add(rows), self.keys.used
        if 2 * n > len(self.slots):
            self.slots = np.full(1 << int(4 * n - 1).bit_length(), -1, np.int32)
            self._enter(self.keys.data[:n], np.arange(n, dtype=np.int32))
        else:
            self._enter(keys, np.arange(at, n, dtype=np.int32))
        return at

    def __call__(self, cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each piece has."""
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self._bytes() > self.room:
            self.forget()
        words, a, b = triples(cp, s, e)
        keys, size = hashes(words, a, b), b - a
        number = self._find(keys)
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            new, where, back = np.unique(keys[fresh], return_index=True, return_inverse=True)
            w = fresh[where]
            ids, n = self._encoded(self._strings(cp, s[w], e[w] - s[w]))
            first = self.words.add(words[spread(a[w], size[w])]) + np.cumsum(size[w]) - size[w]
            rows = np.stack([first, size[w], self.ids.add(ids) + np.cumsum(n) - n, n], 1)
            number[fresh] = self._learn(new, rows) + back.reshape(-1)
        row = self.rows.data[number]
        start, n = row[:, 2].astype(np.int64), row[:, 3].astype(np.int64)
        same = row[:, 1] == size
        k = np.flatnonzero(same)
        differ = np.flatnonzero(words[spread(a[k], size[k])] != self.words.data[spread(row[k, 0], size[k])])
        if len(differ):
            same[k[np.searchsorted(np.cumsum(size[k]), differ, "right")]] = False
        flat = self.ids.data
        if not same.all():
            own = np.flatnonzero(~same)
            ids, m = self._encoded(self._strings(cp, s[own], e[own] - s[own]))
            start[own], n[own] = self.ids.used + np.cumsum(m) - m, m
            flat = np.concatenate([flat[: self.ids.used], ids])
        return flat[spread(start, n)], n
