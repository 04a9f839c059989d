"""Groups of spelling variants: words of a corpus that are one edit apart, by a positional q-gram index with a count filter.

A word of L letters has L - 2 trigrams, and one edit spoils three of them at most and moves the others by at most one
place. So two words one edit apart share max(L, M) - 5 trigrams, at places that differ by one at most.

* Spark counts words and trigrams (there are 90 ** 3 trigrams at most, so their counts are a small table).
* Each word goes to its four rarest trigrams: of two words one edit apart, the rarest trigram that both share is
  among the four rarest of each. Trigrams with many words are split into blocks, and pairs of blocks are dealt.
* In such a cell an inverted index maps (trigram, length, place) to words. Words come from short to long; each
  heap-merges the postings, at lengths L - 1 and L and at places one apart at most, of the four of its trigrams that have
  the shortest (L - 5 of L - 2 come up, so one of any four does), verifies what comes up letter by letter, and enters the index.
* Forms are followed by doubling: each round joins roots to roots until none changes.

Defined results: null and empty texts have no words; a null id is hashed as the empty text; repeated rows count each; an
empty table gives an empty one; only the id and the text are read, so no other column's name can clash.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.runtime import release, stash

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LETTERS = 90  # a to z and U+00C0 to U+00FF
LEAST_LETTERS, LEAST_COUNT = 6, 5
RATIO = 5
MODULUS = 199
SPOILED = 3  # trigrams that one edit spoils at most
PREFIX = SPOILED + 1
CELL_WORDS, CELL_LETTERS = 4_096, 1 << 18


def words(docs: DataFrame, modulus: int | None = MODULUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n, its occurrences. With a modulus, a run whose hash with its document's id the modulus divides loses a letter: planted variants."""
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit(RUN), F.lit(0))).alias("run"))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = src.select("id", F.when(F.col("run").rlike("[A-Z]"), lower).otherwise(F.col("run")).alias("run")).where(F.length("run") >= LEAST_LETTERS)
    word = F.col("run")
    if modulus:
        rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % modulus == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(word)
    return rows.select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all trigrams of the words, one word after the other, and where each word's begin."""
    cp, at = wordscan.points(texts)
    code = np.where(cp < 0xC0, cp - ord("a"), cp - (0xC0 - 26)).astype(np.int64)
    n = np.diff(at) - 2
    i = wordscan.spread(at[:-1], n)
    return (code[i] * LETTERS + code[i + 1]) * LETTERS + code[i + 2], np.append(0, np.cumsum(n))


def trigram_counts(vocabulary: DataFrame) -> np.ndarray:
    """In how many places of the vocabulary each trigram stands: a number for each of 90 ** 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, np.int64)
        for batch in wordscan.small(batches, lambda b: b.column(0)):
            total += np.bincount(_trigrams(batch.column(0).to_pylist())[0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    got = vocabulary.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(LETTERS**3, np.int64)
    out[got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return out


def rarest(vocabulary: DataFrame, counts: np.ndarray) -> DataFrame:
    """gram, word, n: each word under its four rarest trigrams (equally rare ones by number, then by place), each once."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wordscan.small(batches, lambda b: b.column(0)):
            gram, at = _trigrams(batch.column(0).to_pylist())
            word = np.repeat(np.arange(len(batch)), np.diff(at))
            order = np.lexsort((gram, shared.value[gram], word))  # stable, so equal ones stay in the order of their places
            first = order[np.arange(len(order)) - at[word] < PREFIX]
            key = np.unique(word[first] * LETTERS**3 + gram[first])
            rows = batch.take(pa.array(key // LETTERS**3))
            yield pa.RecordBatch.from_arrays([pa.array(key % LETTERS**3), rows.column(0), rows.column(1)], ["gram", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "gram long, word string, n long")


def cells(postings: DataFrame) -> DataFrame:
    """The postings with the cell i, j and the block of each row: every two words of a trigram meet in one cell."""
    sizes = postings.groupBy("gram").agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("letters"))
    blocks = F.greatest(F.ceil(F.col("words") / CELL_WORDS), F.ceil(F.col("letters") / CELL_LETTERS)).cast("int")
    large = sizes.select("gram", blocks.alias("blocks")).where("blocks > 1")  # 90 ** 3 rows at most
    rows = postings.join(F.broadcast(large), "gram", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("gram", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n")


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes one word of the other."""
    if len(a) < len(b):
        a, b = b, a
    half = len(b) // 2
    if len(a) - len(b) > 1 or a == b or (a[:half] != b[:half] and a[len(a) - len(b) + half :] != b[half:]):
        return False  # the edit leaves one half as it was
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[i + 1 :] == b[i + (len(a) == len(b)) :]


def _often(postings: Iterable[list[int]], least: int) -> Iterator[int]:
    """What stands in the sorted lists `least` times or more, by merging them with a heap."""
    last, times = -1, 0
    for k in heapq.merge(*postings):
        if k == last:
            times += 1
        else:
            last, times = k, 1
        if times == least:
            yield k


def near_in_cell(texts: list[str], blocks: list[int], i: int, j: int) -> Iterator[tuple[int, int]]:
    """The pairs of words (by number) of the cell i, j that are one edit apart; in a cell of two blocks only those of both.

    Of the L - 2 trigrams of a word, L - 5 at least are in a word one edit apart that is no longer, so such a word is in the
    postings of one at least of any four of them. Only those of the four with the shortest postings are merged.
    """
    index: dict[tuple[int, int], dict[str, dict[int, list[int]]]] = defaultdict(dict)  # length, block: trigram: place: words
    order = sorted(range(len(texts)), key=lambda k: (len(texts[k]), texts[k]))
    for place, k in enumerate(order):
        w, size = texts[k], len(texts[k])
        own = blocks[k]
        grams = [w[p : p + 3] for p in range(size - 2)]
        near_lengths = [x for x in (index.get((size - 1, i + j - own)), index.get((size, i + j - own))) if x]
        if near_lengths:
            found = []
            for p, g in enumerate(grams):
                n, lists = 0, []
                for of in near_lengths:
                    if at := of.get(g):
                        for q in (p - 1, p, p + 1):
                            if got := at.get(q):
                                lists.append(got)
                                n += len(got)
                found.append((n, p, lists))
            found.sort()
            for at in _often([x for _, _, lists in found[: SPOILED + 1] for x in lists], 1):
                if one_edit(w, texts[order[at]]):
                    yield k, order[at]
        into = index[size, own]
        for p, g in enumerate(grams):
            into.setdefault(g, {}).setdefault(p, []).append(place)


def near(vocabulary: DataFrame) -> DataFrame:
    """word, n, other, other_n: all pairs of words one edit apart, each in both directions."""
    dealt = cells(stash(rarest(vocabulary, trigram_counts(vocabulary)), "postings"))
    key = ["gram", "i", "j"]
    names = ["word", "n", "other", "other_n"]

    def pairs(texts: list[str], n: list[int], blocks: list[int], cell: tuple[int, int, int]) -> pa.RecordBatch:
        rows = [r for a, b in near_in_cell(texts, blocks, *cell[1:]) for r in ((texts[a], n[a], texts[b], n[b]), (texts[b], n[b], texts[a], n[a]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, (pa.string(), pa.int64()) * 2, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            g, i, j = (batch.column(c).to_numpy() for c in range(3))
            columns = [batch.column(c).to_pylist() for c in (4, 5, 3)]
            cuts = np.append(np.flatnonzero((g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1, len(g)).tolist() if len(g) else []
            for a, b in zip([0, *cuts], cuts):
                cell = int(g[a]), int(i[a]), int(j[a])
                if cell != now:
                    if len(held[0]) > 1:
                        yield pairs(*held, now)
                    now, held = cell, ([], [], [])
                for own, values in zip(held, columns, strict=True):
                    own += values[a:b]
        if len(held[0]) > 1:
            yield pairs(*held, now)

    found = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "word string, n long, other string, other_n long")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the form's form and so on to the last. Each round doubles how far a word has been followed."""
    now = stash(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").isEmpty():
        step = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = now.select("word", "root").join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        last, now = now, stash(further, "roots")
        release(last)
    return now.select("word", "root")


def group(docs: DataFrame, modulus: int | None = MODULUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of at least 6 letters and 5 occurrences."""
    vocabulary = stash(words(docs, modulus, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("m"), "other"))
    near_of = near(vocabulary).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("b"))
    kept = F.col("b.m") <= -RATIO * F.col("n")
    known = stash(near_of.select("word", "n_near", F.when(kept, F.col("b.other")).alias("form"), F.when(kept, -F.col("b.m")).alias("form_n")), "near")
    to = roots(known.where("form IS NOT NULL"))
    rows = vocabulary.join(known, "word", "left").join(to, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
