"""Documents to chunks under a token budget, and back.

A body is cut at the boundaries of three levels, coarse to fine: markers, blank lines or headings, then lines. Each
chunk ends at the furthest boundary that fits; a unit that does not fit is cut at the next finer level. The end of
the text is no boundary, so the last unit is a chunk of its own unless it is small (kept for equal chunk layouts).
By default tokens are UTF-8 bytes div 3 of a span, so prefix sums of bytes make a cut O(log n) and a document O(n log n).
With a vocabulary (`Limits.vocabulary`, a file of the tokenizers library) they are the tokens that it gives. These don't add up
over spans, so a cut gallops: from the boundary that the tokens of the whole text suggest, and never below the one that bytes
alone guarantee, ever larger steps are measured, then halved; each chunk has been measured as it is when it is cut. Of a plain
byte-level vocabulary the tokens within a span add up: distinct pieces are encoded once, and of a span only its two edges.

A document is one row of one task; nothing is collected across documents.
"""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property, lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions.slices import by_slices
from loomtext.functions.text import tokens
from loomtext.operators.headers import DIALECT, split_header

# Limits in tokens.
MAX_TOKENS, TARGET_TOKENS, SMALL, NOTE, LEAST_BUDGET, MARGIN = 9_999, 9_900, 200, 50, 500, 5
MARKED = ("law", "tsutatsu", "hanketsu", "accounting", "guide")
HEADED = ("paper", "treaty")
IS_CHUNK = r"^--- split \d+/\d+ of "
BASE_NOTE = r"\n--- split 1/(\d+) → next: .+\.txt ---\n?$"
CHUNK_NOTE = r"^--- split \d+/\d+ of .+\.txt ---\n"


@dataclass(frozen=True)
class Limits:
    most: int = MAX_TOKENS
    target: int = TARGET_TOKENS
    small: int = SMALL
    least_budget: int = LEAST_BUDGET
    heading: str = r"^##\s"
    vocabulary: str = ""

    @property
    def token_method(self) -> str:
        return self.vocabulary.rsplit("/", 1)[-1].removesuffix(".json") or "bytes_div_3"


def boundaries(body: str, db: str, heading: str = Limits.heading) -> list[list[int]]:
    """Offsets where the body may be cut, coarse to fine; neither its start nor its end."""
    at = lambda pattern, shift=0: [m.start() + shift for m in re.finditer(pattern, body, re.M) if m.start() > 0]
    line_starts = [m.end() for m in re.finditer("\n", body) if m.end() < len(body)]
    if db in MARKED:
        return [at(r"^\[p\d+\]"), at(r"^\[p\d+-i\d+\]"), line_starts]
    if db in HEADED:
        return [at(heading), at(r"\n\n", 1), line_starts]
    return [at(r"\n\n", 1), line_starts, line_starts]


class Sizes:
    """Tokens of any span of a text, from the running sum of its UTF-8 bytes."""

    def __init__(self, text: str) -> None:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        each = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        self.at = np.append(0, np.cumsum(each))

    def __call__(self, a: int, b: int) -> int:
        return int(self.at[b] - self.at[a]) // 3

    def fit(self, a: int, own: list[int], lo: int, hi: int, budget: int) -> int:
        """The number k, lo <= k <= hi, for which own[k - 1] is the last boundary up to which a span from a keeps the budget."""
        furthest = int(np.searchsorted(self.at, self.at[a] + 3 * budget + 2, "right")) - 1
        return max(lo, min(bisect.bisect_right(own, furthest), hi))


    def even(self, own: list[int], end: int, first: int, second: int) -> int:
        """The boundary that divides the text up to `end` most evenly into spans within both budgets, or 0."""
        fits = [(abs(self(0, b) - self(b, end)), b) for b in own if self(0, b) <= first and self(b, end) <= second]
        return min(fits, default=(0, 0))[1]


@cache
def _encoder(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def count_tokens(text: str, vocabulary: str = "") -> int:
    """Tokens of a text: bytes div 3, or what the vocabulary gives."""
    return _library_count(text, vocabulary) if vocabulary else len(text.encode()) // 3


@lru_cache(256)
def _library_count(text: str, vocabulary: str) -> int:
    return len(_encoder(vocabulary).encode_batch_fast([text], add_special_tokens=False)[0].ids)


class TokenSizes(Sizes):
    """Tokens of any span by a vocabulary. A token has a byte at least, so as many bytes as the budget has tokens always fit."""

    def __init__(self, text: str, vocabulary: str) -> None:
        super().__init__(text)
        self.text, self.vocabulary = text, vocabulary
        self.ends = np.array([e for _, e in _encoder(vocabulary).encode(text, add_special_tokens=False).offsets], np.int64)

    def __call__(self, a: int, b: int) -> int:
        return count_tokens(self.text[a:b], self.vocabulary)

    def fit(self, a: int, own: list[int], lo: int, hi: int, budget: int) -> int:
        sure = int(np.searchsorted(self.at, self.at[a] + budget, "right")) - 1
        good, bad = max(lo, min(bisect.bisect_right(own, sure), hi)), hi + 1
        fits = lambda k: self(a, own[k - 1]) <= budget
        # the tokens of the whole text tell about where to look; what is measured there decides
        k = min(bisect.bisect_right(own, self._after(a, budget)), hi)
        step = 1
        if k > good and not fits(k):
            bad = k
            while (k := max(good, bad - step)) > good and not fits(k):
                bad, step = k, 2 * step
            good = k
        else:
            good = max(good, k)
            while good < hi and fits(k := min(good + step, hi)):
                good, step = k, 2 * step
            bad = min(good + step, hi) if good < hi else hi + 1
        while bad - good > 1:
            k = (good + bad) // 2
            good, bad = (k, bad) if fits(k) else (good, k)
        return good

    def _after(self, a: int, budget: int) -> int:
        """Where the token ends that is about the budget's last one from a on."""
        if not len(self.ends):
            return a
        k = int(np.searchsorted(self.ends, a, "right")) + budget - 1
        return int(self.ends[min(max(k, 0), len(self.ends) - 1)])

    def even(self, own: list[int], end: int, first: int, second: int) -> int:
        """By halving: what lies before a boundary grows with it, what lies behind it shrinks."""
        last = self.fit(0, own, 0, len(own), first)
        # a cut changes no more than the tokens of the piece that it divides, so a rest of twice the budget needs no count
        if not last or len(self.ends) - np.searchsorted(self.ends, own[last - 1], "right") > 2 * second + 64 or self(own[last - 1], end) > second:
            return 0
        least = bisect.bisect_left(range(last), True, key=lambda k: self(own[k], end) <= second)
        k = bisect.bisect_left(range(least, last), True, key=lambda k: self(0, own[k]) >= self(own[k], end)) + least
        near = [own[i] for i in (k - 1, k) if least <= i < last]
        return min((abs(self(0, b) - self(b, end)), b) for b in near)[1]


EDGE = 4  # a cut changes no piece that begins so many letters or more from it, white space that it touches apart


@cache
def _pieces(path: str) -> Pieces | None:
    """The pieces of a plain byte-level vocabulary; None for any other."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and model.get("type") == "BPE"
    odd = spec.get("normalizer") or spec.get("post_processor") or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    return Pieces(path, [t["content"] for t in spec.get("added_tokens") or []]) if plain and not odd else None


class Pieces:
    """Where the tokens of texts end, by a vocabulary whose tokens lie in pieces that a pattern cuts: each distinct piece is encoded once."""

    def __init__(self, path: str, added: list[str]) -> None:
        from loomtext.llm import wordscan

        self.path, self.added, self.scan = path, added, wordscan
        encoder = _encoder(path)
        self.coder = wordscan.PieceCoder(lambda pieces: [[e for _, e in encoder.encode(p, add_special_tokens=False).offsets] for p in pieces])

    def sizes(self, texts: list[str]) -> Iterator[PieceSizes | None]:
        """Of each text; None for one that holds an added token, which the pattern doesn't see."""
        for a, b in self.scan.slabs(texts):
            part = texts[a:b]
            cp, at = self.scan.points(part)
            s, e = self.scan.byte_level_cuts(cp, at)
            flat, n = self.coder(cp, s, e)
            before = np.append(0, np.cumsum(n))
            ends = flat.astype(np.int64) + np.repeat(s, n)
            own = np.searchsorted(s, at).tolist()
            for t, lo, hi, zero in zip(part, own, own[1:], at.tolist()):
                known = not any(x in t for x in self.added)
                yield PieceSizes(t, self.path, (s[lo:hi] - zero).tolist(), (before[lo : hi + 1] - before[lo]).tolist(), ends[before[lo] : before[hi]] - zero) if known else None


class PieceSizes(TokenSizes):
    """The same numbers as TokenSizes: the pieces within a span are those of the whole text, only its edges are encoded again."""

    def __init__(self, text: str, vocabulary: str, starts: list[int], before: list[int], ends: np.ndarray) -> None:
        self.text, self.vocabulary, self.starts, self.before, self.ends = text, vocabulary, starts, before, ends

    @cached_property
    def at(self) -> np.ndarray:
        return Sizes(self.text).at

    def __call__(self, a: int, b: int, head: str = "") -> int:
        """Tokens of the span behind `head`."""
        i, j = bisect.bisect_left(self.starts, a + EDGE), bisect.bisect_right(self.starts, b - EDGE) - 1
        while i < j and self.text[self.starts[i] - 1].isspace():
            i += 1
        if i >= j:
            return count_tokens(head + self.text[a:b], self.vocabulary)
        x, y = self.starts[i], self.starts[j]
        return count_tokens(head + self.text[a:x], self.vocabulary) + self.before[j] - self.before[i] + count_tokens(self.text[y:b], self.vocabulary)


def known_sizes(texts: list[str], vocabulary: str) -> Iterator[PieceSizes | None]:
    """Sizes of texts that are cheaper made together; None where each is on its own."""
    pieces = _pieces(vocabulary) if vocabulary else None
    return pieces.sizes(texts) if pieces else repeat(None, len(texts))


def sizes_of(text: str, vocabulary: str = "") -> Sizes:
    return TokenSizes(text, vocabulary) if vocabulary else Sizes(text)


def cut(body: str, budget: int, levels: list[list[int]], size: Sizes | None = None) -> list[str]:
    size = size or Sizes(body)

    def spans(a: int, b: int, depth: int) -> Iterator[tuple[int, int]]:
        while depth < len(levels):
            own = levels[depth]
            lo, hi = bisect.bisect_right(own, a), bisect.bisect_left(own, b)
            if lo < hi:
                break
            depth += 1
        else:
            yield a, b
            return
        at = a
        while lo < hi:
            fit = size.fit(at, own, lo, hi, budget)
            if fit > lo:
                yield at, own[fit - 1]
                at, lo = own[fit - 1], fit
            else:
                yield from spans(at, own[lo], depth + 1)
                at, lo = own[lo], lo + 1
        if size(at, b) > budget:
            yield from spans(at, b, depth + 1)
        else:
            yield at, b

    return [body[a:b] for a, b in spans(0, len(body), 0) if a < b]


def merge_small(chunks: list[str], small: int = SMALL, vocabulary: str = "", size: Sizes | None = None) -> list[str]:
    """`size` measures the text that the chunks make up."""
    out = chunks[:1]
    at = len(chunks[0]) if chunks else 0
    for c in chunks[1:]:
        n, at = size(at, at + len(c)) if size else count_tokens(c, vocabulary), at + len(c)
        if n < small:
            out[-1] += c
        else:
            out.append(c)
    return out


def halves(body: str, first: int, second: int, levels: list[list[int]], size: Sizes | None = None) -> list[str] | None:
    """The most even cut into two parts within the budgets, at the coarsest level that has one."""
    if min(first, second) < 100:
        return None
    size = size or Sizes(body)
    for own in levels:
        b = size.even(own, len(body), first, second)
        if b:
            return [body[:b], body[b:]]
    return None


def split_text(stem: str, db: str, header: str, body: str, limits: Limits = Limits(), known: PieceSizes | None = None) -> list[str]:
    """The noted chunks of a document; one element if it stays whole. `known` are the sizes of the body, if it has been measured."""
    count = lambda s: count_tokens(s, limits.vocabulary)
    under = lambda head: known(0, len(body), head) if known and not any(t in head for t in _pieces(limits.vocabulary).added) else count(head + body)
    whole = header + body
    if under(header) <= limits.most:
        return [whole]
    budget = limits.target - count(header) - NOTE
    if budget < limits.least_budget:
        header = "\n".join(header.split("\n")[:2]) + "\n"
        budget = limits.target - count(header) - NOTE
    if under(header) <= limits.target:
        return [whole]
    levels, size = boundaries(body, db, limits.heading), known or sizes_of(body, limits.vocabulary)
    parts = merge_small(cut(body, budget, levels, size), limits.small, limits.vocabulary, known)
    if len(parts) <= 1:
        return [whole]
    if len(parts) >= 3:
        notes = [f"\n--- split 1/2 → next: {stem}_2.txt ---\n", f"--- split 2/2 of {stem}.txt ---\n"]
        parts = halves(body, limits.most - count(header) - count(notes[0]) - MARGIN, limits.most - count(notes[1]) - MARGIN, levels, size) or parts
    n = len(parts)
    return [f"{header}{parts[0]}\n--- split 1/{n} → next: {stem}_2.txt ---\n", *(f"--- split {i}/{n} of {stem}.txt ---\n{p}" for i, p in enumerate(parts[1:], 2))]


def is_chunk(text: Column | str) -> Column:
    return (F.col(text) if isinstance(text, str) else text).rlike(IS_CHUNK)


def split(docs: DataFrame, limits: Limits = Limits(), stem: str = "stem", db: str = "db", text: str = "text") -> DataFrame:
    """Each document's chunks: its columns with stem and text of the chunk, base_id, chunk_n and chunk_total.

    Chunks are not split again; a null text is empty and stays whole. With a vocabulary in the limits its tokens count, and
    `token_method` names it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    parts = F.when(F.col(db).isin("qa"), split_header(body, "dashes")).when(F.col(db).isin([d for d, k in DIALECT.items() if k == "yaml_or_blank"]), split_header(body, "yaml_or_blank")).otherwise(split_header(body, "blank"))
    # a document that keeps its limit never leaves the JVM; with a vocabulary, one that has no more bytes than the limit has tokens
    large = (F.octet_length(body) if limits.vocabulary else tokens(body)) > limits.most
    over = docs.where(large & ~is_chunk(body)).withColumn("_p", parts)
    whole = docs.where(~large | is_chunk(body)).select(*docs.columns, F.col(stem).alias("base_id"), F.lit(1).alias("chunk_n"), F.lit(1).alias("chunk_total"))

    def chunks(stems: list[str], dbs: list[str], headers: list[str], bodies: list[str]) -> list[list[str]]:
        return [split_text(*x, limits, known) for *x, known in zip(stems, dbs, headers, bodies, known_sizes(bodies, limits.vocabulary), strict=True)]

    given = (F.col(stem), F.coalesce(F.col(db), F.lit("")), F.col("_p.header"), F.col("_p.body"))
    made = over.withColumn("_c", by_slices(chunks, pa.list_(pa.string()), "array<string>", *given))
    rows = made.select(*docs.columns, F.size("_c").alias("chunk_total"), F.posexplode("_c").alias("_n", "_t"))
    name = F.when(F.col("_n") == 0, F.col(stem)).otherwise(F.concat(F.col(stem), F.lit("_"), (F.col("_n") + 1).cast("string")))
    cols = [F.col("_t").alias(text) if c == text else name.alias(stem) if c == stem else F.col(c) for c in docs.columns]
    out = rows.select(*cols, F.col(stem).alias("base_id"), (F.col("_n") + 1).alias("chunk_n"), "chunk_total").unionByName(whole)
    return out.withColumn("token_method", F.lit(limits.token_method)) if limits.vocabulary else out


def measured(text: Column | str, vocabulary: str) -> Column:
    """Tokens of each text by a vocabulary of the tokenizers library; of a null text 0."""

    def run(texts: list[str | None]) -> list[int]:
        whole = [t or "" for t in texts]
        return [len(s.ends) if s else count_tokens(t, vocabulary) for t, s in zip(whole, known_sizes(whole, vocabulary), strict=True)]

    return by_slices(run, pa.int64(), "long", F.col(text) if isinstance(text, str) else text)


def unsplit(chunks: DataFrame, base: str = "base_id", n: str = "chunk_n", text: str = "text") -> DataFrame:
    """base_id, text, missing: chunks joined in order without their notes. The exact inverse of split; missing lists the numbers not found."""
    t = F.col(text)
    total = F.max(F.when(F.col(n) == 1, F.regexp_extract(t, BASE_NOTE, 1))).alias("_total")
    clean = F.when(F.col(n) == 1, F.regexp_replace(t, BASE_NOTE, "")).otherwise(F.regexp_replace(t, CHUNK_NOTE, ""))
    got = chunks.groupBy(base).agg(total, F.sort_array(F.collect_list(F.struct(F.col(n).alias("n"), clean.alias("t")))).alias("_c"))
    want = F.coalesce(F.try_to_number(F.nullif("_total", F.lit("")), F.lit("999999")).cast("int"), F.lit(1))
    numbers = F.when(want >= 2, F.sequence(F.lit(2), F.greatest(want, F.lit(2)))).otherwise(F.array().cast("array<int>"))
    return got.select(F.col(base), F.array_join(F.transform("_c", lambda c: c["t"]), "").alias(text), F.array_except(numbers, F.transform("_c", lambda c: c["n"])).alias("missing"))


def line_chunks(docs: DataFrame, budget: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, ord, chunk: the lines of each document packed in order under a byte budget, by a fold in the JVM.

    The fold writes down only where chunks begin; a line's chunk is the number of beginnings up to it.
    """
    ls = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    start = F.struct(F.lit(0).cast("long").alias("cur"), F.lit(0).cast("long").alias("k"), F.array().cast("array<bigint>").alias("heads"))

    def step(acc: Column, size: Column) -> Column:
        opens = (acc["k"] == 0) | (acc["cur"] + size > budget)
        heads = F.when(opens, F.array_append(acc["heads"], acc["k"])).otherwise(acc["heads"])
        return F.struct(F.when(opens, size).otherwise(acc["cur"] + size).alias("cur"), (acc["k"] + 1).alias("k"), heads.alias("heads"))

    sizes = F.transform(ls, lambda x: (F.octet_length(x) + 1).cast("long"))
    got = docs.select(F.col(doc), F.aggregate(sizes, start, step).alias("f"))
    runs = got.select(doc, F.posexplode("f.heads").alias("chunk", "head"), "f.heads", "f.k")
    end = F.coalesce(F.get("heads", F.col("chunk") + 1), F.col("k"))
    return runs.select(doc, F.explode(F.sequence("head", end - 1)).alias("ord"), F.col("chunk").cast("long").alias("chunk"))


def balanced_line(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, line, diff: the line after which a cut into two is most even in bytes; the earliest of equals."""
    ls = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    sizes = docs.select(F.col(doc), F.posexplode(F.transform(ls, lambda x: (F.octet_length(x) + 1).cast("long"))).alias("k", "b"), F.aggregate(F.transform(ls, lambda x: (F.octet_length(x) + 1).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.size(ls).alias("n"))
    w = Window.partitionBy(doc).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    cuts = sizes.withColumn("left", F.sum("b").over(w)).where(F.col("k") < F.col("n") - 1).withColumn("diff", F.abs(2 * F.col("left") - F.col("total")))
    return cuts.groupBy(doc).agg(F.min(F.struct("diff", "k")).alias("m")).select(doc, (F.col("m.k") + 1).cast("long").alias("line"), F.col("m.diff").alias("diff"))


def process(docs: DataFrame, trimmed: Column, limits: Limits = Limits()) -> DataFrame:
    """Join chunks, trim, split again: one plan from stored chunks (db, stem, base_id, chunk_n, text) to new ones."""
    whole = unsplit(docs).drop("missing").join(docs.where("chunk_n = 1").select("base_id", "db", "stem"), "base_id")
    return split(whole.withColumn("text", trimmed).select("db", "stem", "text"), limits)


def split_stats(docs: DataFrame, limits: Limits = Limits(), stem: str = "stem", db: str = "db", text: str = "text") -> DataFrame:
    """scanned, oversized, split and created by db and in total (null db): documents that are no chunks, those above the limit, those split, the chunks of these."""
    rows = split(docs, limits, stem, db, text)
    base = (F.col("chunk_n") == 1) & ~((F.col("chunk_total") == 1) & is_chunk(F.coalesce(text, F.lit(""))))
    made = F.col("chunk_total") > 1
    return rows.rollup(db).agg(
        F.count_if(base).alias("scanned"),
        F.count_if(base & (made | (tokens(text) > limits.most))).alias("oversized"),
        F.count_if(base & made).alias("split"),
        F.count_if(made).alias("created"),
    )


def process_stats(docs: DataFrame, trimmed: Column, limits: Limits = Limits()) -> DataFrame:
    """What `process` does by db and in total (null db): documents, those that were stored in chunks, tokens before and after trimming, chunks after.

    docs: stored chunks (db, stem, base_id, chunk_n, text); `trimmed` is an expression on the joined text.
    """
    stored = docs.where("chunk_n = 1").select("base_id", "db", "stem", F.col("text").rlike(BASE_NOTE).alias("_noted"))
    whole = unsplit(docs).drop("missing").join(stored, "base_id").withColumn("_after", trimmed)
    before = whole.select("db", F.lit(1).alias("_doc"), F.col("_noted").cast("int").alias("_joined"), tokens("text").alias("_b"), tokens("_after").alias("_a"), F.lit(0).alias("_made"))
    after = split(whole.select("db", "stem", F.col("_after").alias("text")), limits).select("db", F.lit(0).alias("_doc"), F.lit(0).alias("_joined"), F.lit(0).cast("long").alias("_b"), F.lit(0).cast("long").alias("_a"), F.lit(1).alias("_made"))
    sums = {"documents": "_doc", "joined": "_joined", "tokens_before": "_b", "tokens_after": "_a", "chunks_after": "_made"}
    return before.unionByName(after).rollup("db").agg(*(F.sum(c).alias(name) for name, c in sums.items()))


def over_limit(docs: DataFrame, text: str = "text", most: int = MAX_TOKENS) -> DataFrame:
    """Documents above the limit, largest first."""
    return docs.withColumn("tokens", tokens(text)).where(F.col("tokens") > most).orderBy(F.desc("tokens"))


