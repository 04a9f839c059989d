"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and the words around a hit.

Learning: from a bounded sample of labelled documents (`SAMPLE` rows, the smallest hashes of ids), Spark
counts in how many toxic and clean documents each word, and each stem of 4 to 6 letters, occurs; near copies
of one toxic text count once (by two signatures over shingles). Words and
stems with a high ratio form the lexicon, all of them: the sample bounds their number. Which misspellings also
occur in clean documents is read from the same counts, and such spellings never count.

Scoring: each distinct word of a slab of texts runs once through two automata, of all words and of all stems (with any
ending): a trie with a Levenshtein automaton of one error, made deterministic as far as words need it. A hit weighs the log ratio of
its entry; misspelled hits weigh less; hits inside quotation marks or after a reporting word weigh less.
The saturated sum goes through a logistic curve fitted on the sample. Labels, language, source and id are no
inputs of a score.

Defined results: a null or empty text has no hits and gets the curve's lowest score; texts are whole; each row
gives a row, repeated rows repeat; an empty table gives an empty one; without labels of both kinds nothing is
toxic; null labels and documents with contrary labels are left out; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.runtime import scored, stash

SAMPLE = 20_000
SEEN = 6  # toxic documents that hold a word of the lexicon, at least
STEM_SEEN = 3  # toxic documents that hold a stem, at least
RATIO = 3.0  # log of how much likelier toxic documents hold it, at least
CLEAN_SHARE = 0.05  # clean documents that hold it for each toxic one, at most
STEM_WORDS = 8  # words that share a stem, at least
FUZZY, QUOTED = 0.6, 0.25  # weight of a misspelled hit and of a quoted one, against a plain one
STATES = 10_000  # of an automaton that are kept, about; what goes is only made again
WINDOW = 80  # characters before and after a hit that are searched for quotation marks
REPORTING = frozenset("said says called calls word words term slur quote quoted wrote nannte sagte dit mot dijo palabra".split())
# Letters that look like the key are often written as it.
LOOKALIKE = str.maketrans("0134578@$", "oieastbas")
_OPEN, _CLOSE = "\"“„«‘‹", "\"”“»’›"


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    harmless: frozenset[str] = frozenset()
    intercept: float = -6.0
    slope: float = 0.0


class Automaton:
    """Lexicon trie and Levenshtein automaton of one error, determinised on demand: a state is a set of (node, errors)."""

    def __init__(self, words: Sequence[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[str] = [""]
        for w in words:
            n = 0
            for c in w:
                if c not in self.next[n]:
                    self.next[n][c] = len(self.next)
                    self.next.append({})
                    self.ends.append("")
                n = self.next[n][c]
            self.ends[n] = w
        self._forget()

    def _forget(self) -> None:
        """Drop the states that words have needed so far."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With what a letter left out gives."""
        out = set(pairs)
        for n, e in pairs:
            if e == 0:
                out.update((m, 1) for m in self.next[n].values())
        return frozenset(p for p in out if p[1] == 0 or (p[0], 0) not in out)

    def _state(self, s: frozenset) -> int:
        if not s:
            return -1
        if s not in self.states:
            self.states[s] = len(self.sets)
            self.sets.append(s)
            self.step.append({})
        return self.states[s]

    def find(self, word: str, prefix: bool = False) -> tuple[str, int] | None:
        """The entry within one error of the word (or of one of its beginnings), and the errors."""
        if len(self.sets) > STATES:
            self._forget()
        q, best = self.start, None
        for c in word:
            if prefix:
                best = min(filter(None, (best, self._end(q))), key=lambda x: (x[1], x[0]), default=None)
            to = self.step[q].get(c)
            if to is None:
                new: set[tuple[int, int]] = set()
                for n, e in self.sets[q]:
                    if (m := self.next[n].get(c)) is not None:
                        new.add((m, e))
                    if e == 0:
                        new.add((n, 1))  # a letter too many
                        new.update((m, 1) for m in self.next[n].values())  # another letter
                to = self.step[q][c] = self._state(self._closed(new))
            if to < 0:
                return best
            q = to
        return min(filter(None, (best, self._end(q))), key=lambda x: (x[1], x[0]), default=None)

    def _end(self, q: int) -> tuple[str, int] | None:
        return min(((self.ends[n], e) for n, e in self.sets[q] if self.ends[n]), key=lambda x: (x[1], x[0]), default=None)


class Fuzzy:
    """All words and stems of a lexicon with one error; what follows a stem does not count."""

    def __init__(self, words: Sequence[str], stems: Sequence[str]) -> None:
        self.words, self.stems = Automaton(sorted(words)), Automaton(sorted(stems))

    def find(self, plain: str) -> str | None:
        found = self.words.find(plain) or self.stems.find(plain, prefix=True)
        return found[0] if found else None


def cuts(cp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of letters, numbers, @ and $."""
    kind = wordscan.classes()[cp]
    return wordscan.stretches((kind == wordscan.LETTER) | (kind == wordscan.NUMBER) | (cp == 0x40) | (cp == 0x24), at)


class Matcher:
    """Words to hits. Codes: 0 none, 1 a reporting word, 2 + i an entry of `hits`: (term, weight, errors)."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.fuzzy = Fuzzy(list(model.words), list(model.stems))
        self.hits: list[tuple[str, float, int]] = []
        self.code_of: dict[tuple[str, int], int] = {}
        self.lengths = sorted({len(s) for s in model.stems})
        self.coder = wordscan.PieceCoder(lambda pieces: [[self.code(p)] for p in pieces])

    def code(self, piece: str) -> int:
        w, m = piece.lower(), self.model
        if w in m.words:
            return self._hit(w, m.words[w], 0)
        for n in self.lengths:
            if w[:n] in m.stems and len(w) >= n:
                return self._hit(w[:n], m.stems[w[:n]], 0)
        if w in REPORTING:
            return 1
        plain = w.translate(LOOKALIKE)
        if plain != w and plain in m.words:
            return self._hit(plain, m.words[plain], 1)
        if w not in m.harmless and (found := self.fuzzy.find(plain)):
            return self._hit(found, m.words[found] if found in m.words else m.stems[found], 1)
        return 0

    def _hit(self, term: str, weight: float, errors: int) -> int:
        if (term, errors) not in self.code_of:
            self.code_of[term, errors] = 2 + len(self.hits)
            self.hits.append((term, weight, errors))
        return self.code_of[term, errors]

    def spans(self, texts: Sequence[str]) -> Iterator[list[tuple[int, int, str, int, bool, float]]]:
        """For each text its hits: start, end, term, errors, quoted, weight."""
        for a, b in wordscan.slabs(texts):
            part = texts[a:b]
            cp, at = wordscan.points(part)
            s, e = cuts(cp, at)
            codes, _ = self.coder(cp, s, e)
            codes = codes.astype(np.int64)
            first = np.searchsorted(s, at[:-1]).tolist()
            out: list[list] = [[] for _ in part]
            for k in np.flatnonzero(codes > 1).tolist():
                i = int(np.searchsorted(at, s[k], "right")) - 1
                term, weight, errors = self.hits[codes[k] - 2]
                lo, hi = int(s[k] - at[i]), int(e[k] - at[i])
                said = bool((codes[max(first[i], k - 3) : k] == 1).any())
                quoted = said or _in_quotes(part[i], lo, hi)
                out[i].append((lo, hi, term, errors, quoted, weight * (FUZZY if errors else 1) * (QUOTED if quoted else 1)))
            yield from out


def _in_quotes(text: str, lo: int, hi: int) -> bool:
    """Whether a quotation opens shortly before and closes shortly after on the same line."""
    before, after = text[max(0, lo - WINDOW) : lo].rpartition("\n")[2], text[hi : hi + WINDOW].partition("\n")[0]
    opened = max((before.rfind(c) for c in _OPEN), default=-1)
    if opened < 0 or not any(c in after for c in _CLOSE):
        return False
    mark = before[opened]
    return mark != '"' or before.count('"') % 2 == 1


def raw_scores(docs: DataFrame, model: Model, names: Sequence[str] | None = ("doc_id",)) -> DataFrame:
    """The columns `names` (null: all, as a struct `row`) and x, the saturated sum of hits."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scorer():
        m = _matcher(shared.value)
        return lambda texts: [1 - math.exp(-sum(h[5] for h in hits) / 3) for hits in m.spans(texts)]

    return scored(docs, names, scorer)


_matchers: dict[int, tuple[Model, Matcher]] = {}


def _matcher(model: Model) -> Matcher:
    if id(model) not in _matchers:
        _matchers.clear()
        _matchers[id(model)] = (model, Matcher(model))
    return _matchers[id(model)][1]


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE) -> DataFrame:
    """doc_id, text, y of `bound` labelled documents at most: those with the smallest hashes of ids. Documents with contrary labels are left out.

    Of rows with the same id the least text counts, so the bound is one of rows.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y"), F.max(F.col(label).cast("int")).alias("other")).where("y = other").drop("other")
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")  # labels of other documents must not use up the bound
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)  # `bound` rows: small enough to broadcast
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def _apart(rows: DataFrame) -> DataFrame:
    """text and y without most near copies: of texts that share the least hash of their word 3-grams one stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wordscan.small(batches, lambda b: b.column(0)):
            signs: list[list[int]] = [[], []]
            for text in batch.column(0).to_pylist():
                cp, at = wordscan.points([text])
                h = wordscan.hashes(cp, *cuts(cp, at))
                g = h[2:] + h[1:-1] * np.uint64(3) + h[:-2] * np.uint64(5) if len(h) > 2 else h
                for salt, out in zip((0, 0xD6E8FEB86659FD93), signs, strict=True):
                    out.append(int(wordscan.mix(g ^ np.uint64(salt)).min(initial=(1 << 64) - 1)) >> 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in signs)], ["text", "y", "a", "b"])

    got = rows.select(F.coalesce("text", F.lit("")).alias("text"), "y").mapInArrow(run, "text string, y int, a long, b long")
    # the least text stays, so what is learned does not depend on partitions
    for sign in ("a", "b"):
        got = got.groupBy(sign, "y").agg(F.min(F.struct("text", "a", "b")).alias("least")).select("y", "least.*")
    return got.select("text", "y")


def _tally(rows: DataFrame) -> DataFrame:
    """kind (w a word, s a stem), term, in how many toxic and clean texts it occurs, and the words of toxic texts that share a stem (STEM_WORDS at most)."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())]

    def counted(owner: np.ndarray, ids: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
        """For each id in how many clean and toxic texts it occurs."""
        both = np.unique(owner * n + ids)
        return np.stack([np.bincount(both % n, weights, n) for weights in (~y[both // n], y[both // n])]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        stems: dict[str, int] = {}
        under: list[tuple[int, ...]] = []  # the stems of each word
        totals = [np.zeros((2, 0), np.int64), np.zeros((2, 0), np.int64)]

        def named(pieces: list[str]) -> list[list[int]]:
            out = []
            for w in map(str.lower, pieces):
                if w not in number:
                    number[w] = len(under)
                    under.append(tuple(stems.setdefault(w[:n], len(stems)) for n in (4, 5, 6) if len(w) >= n))
                out.append([number[w]])
            return out

        def out() -> pa.RecordBatch:
            share: dict[int, list[str]] = {}
            for w, k in number.items():
                for s in under[k] if totals[0][1, k] else ():
                    share.setdefault(s, []).append(w)
            some = [(kind, w, int(of[1, k]), int(of[0, k]), share.get(k, [])[:STEM_WORDS] if kind == "s" else []) for kind, words, of in (("w", number, totals[0]), ("s", stems, totals[1])) for w, k in words.items()]
            columns = list(zip(*some, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "term", "toxic", "clean", "under"])

        coder = wordscan.PieceCoder(named)
        for batch in wordscan.small(batches, lambda b: b.column(0)):
            if len(number) > 100_000:  # the rows are summed later, so a task may hand them on in parts
                yield out()
                number.clear(), stems.clear(), under.clear(), coder.forget()
                totals = [x[:, :0] for x in totals]
            cp, at = wordscan.points(batch.column(0).to_pylist())
            s, e = cuts(cp, at)
            ids = coder(cp, s, e)[0].astype(np.int64)
            owner, y = np.searchsorted(at, s, "right") - 1, batch.column(1).to_numpy() == 1
            own = [(owner, ids)]
            each = np.array([len(x) for x in under], np.int64)
            flat = np.fromiter(chain.from_iterable(under), np.int64, int(each.sum()))
            own.append((np.repeat(owner, each[ids]), flat[wordscan.spread((np.cumsum(each) - each)[ids], each[ids])]))
            for k, ((o, i), n) in enumerate(zip(own, (len(number), len(stems)), strict=True)):
                new = counted(o, i, y, n) if n else totals[k]
                new[:, : totals[k].shape[1]] += totals[k] if n else 0
                totals[k] = new
        yield out()

    got = rows.select(F.coalesce("text", F.lit("")).alias("text"), "y").mapInArrow(run, "kind string, term string, toxic long, clean long, under array<string>")
    return got.groupBy("kind", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.size(F.array_distinct(F.flatten(F.collect_list("under")))).alias("under"))


def _harmless(words: DataFrame, own: Sequence[str], stems: Sequence[str]) -> frozenset[str]:
    """The words (a column term) that the automata take for misspellings, without entries and what begins with a stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fuzzy, entries, begins = Fuzzy(own, stems), frozenset(own), tuple(stems)
        for batch in batches:
            near = [w for w in batch.column(0).to_pylist() if w not in entries and not w.startswith(begins) and fuzzy.find(w.translate(LOOKALIKE)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["term"])

    return frozenset(r["term"] for r in words.select("term").mapInArrow(run, "term string").collect())


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Intercept and slope, by Newton's method with a small penalty on the slope."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a + b * x)))
        g = np.array([(p - y).sum(), ((p - y) * x).sum() + ridge * b])
        w = p * (1 - p) + 1e-9
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + ridge]])
        d = np.linalg.solve(h, g)
        a, b = a - np.clip(d[0], -2, 2), b - np.clip(d[1], -2, 2)
        if abs(d).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE, entries: int | None = None) -> Model:
    """Learn from labels (doc_id, label). What comes to the driver is bounded by the sample alone: class sizes, the terms that pass the tests
    (the `entries` most frequent ones, if that is given), harmless spellings and a number for each document."""
    rows = sample(docs, labels, label, bound)
    # copies must not make a lexicon of the words of one toxic text; each clean document counts
    texts = rows.select(F.coalesce("text", F.lit("")).alias("text"), "y")
    apart = stash(_apart(texts.where("y = 1")).unionByName(texts.where("y <> 1")), "sample")
    size = {r["y"]: r["n"] for r in apart.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), sum(n for y, n in size.items() if y != 1)
    if not toxic or not clean:
        return Model()
    ratio = F.log((F.col("toxic") + 0.5) / toxic) - F.log((F.col("clean") + 0.5) / clean)
    tally = stash(_tally(apart), "terms")
    terms = tally.withColumn("weight", ratio).where((F.col("weight") >= RATIO) & (F.col("clean") <= CLEAN_SHARE * F.col("toxic")))
    word, stem = (F.col("kind") == "w") & (F.length("term") > 2) & (F.col("toxic") >= SEEN), (F.col("kind") == "s") & (F.col("toxic") >= STEM_SEEN) & (F.col("under") >= STEM_WORDS)
    terms = terms.where(word | stem).orderBy(F.desc("toxic"), "term", "kind")
    terms = (terms if entries is None else terms.limit(entries)).collect()
    stems: dict[str, float] = {}
    held = {r["term"]: r for r in terms if r["kind"] == "s"}
    for s, r in sorted(held.items(), key=lambda x: (len(x[0]), x[0])):
        longer = [t for t in held.values() if t["term"].startswith(s) and t["term"] != s and t["toxic"] >= 0.98 * r["toxic"]]
        if not longer and not any(s.startswith(x) for x in stems):
            stems[s] = r["weight"]
    words = {r["term"]: r["weight"] for r in terms if r["kind"] == "w" and not any(r["term"].startswith(s) for s in stems)}
    harmless = _harmless(tally.where("kind = 'w' AND clean > 0"), list(words), list(stems)) if words or stems else frozenset()
    model = Model(words, stems, harmless)
    got = raw_scores(rows, model, ["y"]).select("x", "y").toArrow()
    model.intercept, model.slope = logistic(got["x"].to_numpy(), (got["y"].to_numpy() == 1).astype(float))
    return model


def _curve(rows: DataFrame, model: Model, *names: str) -> DataFrame:
    p = 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * F.col("x"))))
    return rows.select(*names, p.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, the columns to keep, score and predicted."""
    return _curve(raw_scores(docs, model, ["doc_id", *keep]), model, "doc_id", *keep)


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """row (a struct of all columns), score and predicted."""
    return _curve(raw_scores(docs, model, None), model, "row")


def find(docs: DataFrame, model: Model) -> DataFrame:
    """The hits themselves: doc_id, start, end, term, errors, quoted, weight."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _matcher(shared.value)
        for batch in wordscan.small(batches, lambda b: b.column(1)):
            rows = [(i, *h) for i, hits in enumerate(m.spans(batch.column(1).to_pylist())) for h in hits]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, t) for c, t in zip(columns[1:], types, strict=True))], ["doc_id", "start", "end", "term", "errors", "quoted", "weight"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, start int, end int, term string, errors int, quoted boolean, weight double")
