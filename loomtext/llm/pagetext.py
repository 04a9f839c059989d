"""Main text of web pages: repeated passages by suffix arrays over each host's pages, the rest by markup.

Parsing gives the blocks of a page in order. Elements that say what they are (nav, header, footer, aside, form, script, style
and the like, or such a role) are left out, and so is what is hidden. Where a page has an article (or main) element only that
counts. A class or id with a word for boilerplate makes a block suspect, no more: suspect blocks go unless that would take
nearly all of the page's text, as with a wrapper named has-sidebar; then the outermost suspect elements are cleared, one layer
after the other. Suspect remarks of readers go whenever anything else is left.

What remains is firm if it is a paragraph, heading, list item, quotation or the like, or stands in an article or main element,
else loose: bare text of div, span and other elements that markup does not explain.

Repetition decides next: the token streams of all of a host's blocks are searched by suffix arrays for runs that occur on
enough pages: SHARE of the host's distinct page contents, and PAGES at least for loose blocks, FIRM_PAGES for firm ones. A run
has RUN tokens or more in loose blocks, FIRM_RUN in firm ones; a shorter block is a run of its own. Of a loose block covered
runs go; a firm block goes when all of it is covered. Copies and near copies must not delete each other: loose runs stay where
they are NEARLY all of the page, and firm blocks where they are more than half of what is left.

Streams are cut into segments of equal least hash (every common run lies in segments with the same least hash). First only
these hashes are counted, so that the tokens of segments that can't occur on enough pages are never written or moved; a host
may hold a third of all pages, and one suffix array is built for each host and least hash. Hosts are told apart by 64-bit
hashes.

Defined results: null html is empty; a page without text gives the empty string; html of any length, cut off
anywhere; repeated rows repeat; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm import wordscan
from loomtext.llm.runtime import bit_map, marked, stash, width

RUN, FIRM_RUN, PAGES, GRAM = 8, 32, 3, 4
SHARE, FIRM_PAGES = 0.3, 5
NEARLY, HALF = 0.9, 0.5
CLEARED = 0.25  # of a page's text that must be left when suspect blocks go

_RAW = frozenset("script style noscript template textarea title iframe svg canvas object".split())
_DROP = frozenset("nav header footer aside select option dialog menu head audio video map".split())
_FORM = frozenset("form fieldset".split())
_CONTROL = frozenset("label button".split())
_FIRM = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd td th caption figcaption address summary".split())
_BLOCK = _FIRM | frozenset("div section article main body html ul ol dl table thead tbody tfoot tr figure details hr center".split()) | _DROP | _FORM
_VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget footer header masthead share sharing social related recommended newsletter subscribe subscription signup login search pagination pager skip toc tags".split())
_REMARKS = frozenset("comment comments commentlist discussion disqus reply replies respond".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# an attribute, or the end of the tag; a quoted value is read on from its quote
_ATTR = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:(["'])|([^\s>"'][^\s>]*))?)?)""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_ENDS = {x: re.compile(rf"</{x}\s*>", re.I) for x in _RAW}


GONE, REMARK, SUSPECT, PLAIN = range(4)


def _kind(name: str, attrs: list[tuple[str, str]], firm: bool) -> int:
    """What an element's name and attributes say of its text. Labels and buttons within sentences are words of these."""
    if name in _DROP or name in _CONTROL and not firm:
        return GONE
    kind = SUSPECT if name in _FORM else PLAIN
    for key, value in attrs:
        value = value.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value) or key == "role" and value in _ROLES:
            return GONE
        if key in ("class", "id") and name not in ("body", "html", "article", "main"):
            words = _SPLIT.split(value)
            kind = min(kind, REMARK if any(w in _REMARKS for w in words) else SUSPECT if any(w in _WORDS for w in words) else PLAIN)
    return kind


def _cleared(found: list[tuple[str, bool, int, bool]]) -> list[tuple[str, bool]]:
    """The blocks (text, loose, how many suspect elements are around them, remark) without suspect ones.

    Where too little is left, elements count as clear from the outside in, layer by layer.
    """
    plain = sum(len(t) for t, _, _, remark in found if not remark)
    if not plain:  # remarks alone
        return [b[:2] for b in found]
    left, deepest = 0, 0
    for n, size in sorted((n, len(t)) for t, _, n, remark in found if not remark):
        if n > deepest and left >= CLEARED * plain:
            break
        left, deepest = left + size, n
    return [b[:2] for b in found if not b[3] and b[2] <= deepest]


class _Reader:
    """Goes through a page once. What was searched for in vain is not searched for again, so the work grows with the page alone."""

    def __init__(self, page: str) -> None:
        self.page, self.missing = page, set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        k = self.page.find(what, at)
        if k < 0:
            self.missing.add(what)
        return k

    def tags(self) -> Iterator[tuple[int, int, str, bool, list[tuple[str, str]], bool]]:
        """Start and end of each piece of markup; name (empty for comments and such), whether it closes, attributes, whether it closes itself."""
        page, at = self.page, 0
        while (k := self.find("<", at)) >= 0:
            closing = page.startswith("</", k)
            m = _NAME.match(page, k + 1 + closing)
            if m:
                attrs, end = self._attributes(m.end())
                yield k, end, m[0].lower(), closing, attrs, page[end - 2 : end] == "/>"
            elif page.startswith("<!--", k):
                e = self.find("-->", k + 4)
                end = e + 3 if e >= 0 else len(page)
                yield k, end, "", False, [], False
            elif closing or page.startswith(("<!", "<?"), k):
                e = self.find(">", k)
                end = e + 1 if e >= 0 else len(page)
                yield k, end, "", False, [], False
            else:
                at = k + 1
                continue
            at = end
            if m and not closing and m[0].lower() in _RAW and page[end - 2 : end] != "/>":
                name = m[0].lower()
                e = None if name in self.missing else _ENDS[name].search(page, end)
                at = e.start() if e else len(page)
                if e is None:
                    self.missing.add(name)
                yield end, at, "", False, [], False

    def _attributes(self, at: int) -> tuple[list[tuple[str, str]], int]:
        """Names and values up to the end of the tag. A quote that nothing closes ends at the next >; a tag without end takes the rest."""
        page, out = self.page, []
        while m := _ATTR.match(page, at):
            at = m.end()
            if m[1]:
                return out, at
            value = m[4] or ""
            if m[3]:
                e = self.find(m[3], at)
                if e < 0:
                    e = self.find(">", at)
                    return out, e + 1 if e >= 0 else len(page)
                value, at = page[at:e], e + 1
            out.append((m[2].lower(), value))
        return out, len(page)


def blocks(page: str) -> list[tuple[str, bool]]:
    """The text and looseness of each block of the main part of a page, in order."""
    out: list[tuple[str, bool, int, bool, bool]] = []
    # element, left out, inside the article, suspect elements around, in remarks, in a firm element
    top = ("", False, False, 0, False, False)
    stack = [top]
    opened: dict[str, int] = {}
    nearest: list[str] = []  # the block elements of the stack
    parts: list[str] = []
    at, main = 0, False

    def flush() -> None:
        if parts:
            _, gone, inside, suspects, remark, firm = stack[-1]
            text = "" if gone else " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, not firm and not inside, suspects, remark, inside))
            parts.clear()

    def close(name: str) -> None:
        while True:
            last = stack.pop()[0]
            opened[last] -= 1
            if last in _BLOCK:
                nearest.pop()
            if last == name:
                return

    for start, end, name, closing, attrs, itself in _Reader(page).tags():
        if start > at:
            parts.append(page[at:start])
        at = end
        if not name or name in _RAW:
            continue
        if name == "br":
            parts.append(" ")
            continue
        block = name in _BLOCK or name in _CONTROL and not stack[-1][5]
        if block or closing and stack[-1][0] == name in _CONTROL and stack[-1][1]:
            flush()
        if closing:
            if opened.get(name):
                close(name)
        elif name not in _VOID and not itself:
            if name in _BLOCK and nearest and (nearest[-1] == "p" or nearest[-1] == name == "li"):
                close(nearest[-1])
            _, gone, inside, suspects, remark, firm = stack[-1]
            kind = _kind(name, attrs, firm)
            if name in ("article", "main") and not gone and not remark:
                inside, suspects = True, 0  # what wraps an article is no boilerplate
                main = True
            stack.append((name, gone or kind == GONE, inside, suspects + (kind == SUSPECT), remark or kind == REMARK, firm or name in _FIRM))
            opened[name] = opened.get(name, 0) + 1
            if name in _BLOCK:
                nearest.append(name)
    if at < len(page):
        parts.append(page[at:])
    flush()
    if main:
        # an article that is small beside plain text around it is a card, not the page's main part
        size = lambda own: sum(len(t) for t, _, n, remark, inside in out if inside == own and not n and not remark)
        main = size(True) >= CLEARED * size(False)
    return _cleared([b[:4] for b in out if b[4] or not main])


def suffix_array(x: np.ndarray) -> np.ndarray:
    """The order of the suffixes of x, by doubling."""
    n = len(x)
    rank = np.unique(x, return_inverse=True)[1].reshape(-1).astype(np.int64)
    k = 1
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
        k *= 2
        if n == 0 or rank.max() == n - 1 or k >= n:
            return order


def repeated(streams: Sequence[np.ndarray], weights: Sequence[int], run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """For each stream which tokens lie in a run that streams of a summed weight of `pages` or more share."""
    lens = np.array([len(s) for s in streams])
    x = np.concatenate([np.append(s.view(np.int64), -1 - i) for i, s in enumerate(streams)])
    owner = np.repeat(np.arange(len(streams)), lens + 1)
    tail = np.repeat(np.cumsum(lens + 1), lens + 1) - np.arange(len(x)) - 1  # tokens before the stream ends
    order = suffix_array(x)
    a, b = order[:-1], order[1:]
    same = (tail[a] >= run) & (tail[b] >= run)
    for k in range(run):
        live = np.flatnonzero(same)
        same[live] = x[a[live] + k] == x[b[live] + k]
    hit = np.zeros(len(x) + 1, np.int64)
    head = np.flatnonzero(np.append(True, ~same)) if len(order) else np.zeros(0, np.int64)
    for s, e in zip(head, [*head[1:], len(order)]):
        own = np.unique(owner[order[s:e]])
        if tail[order[s]] >= run and sum(weights[i] for i in own) >= pages:
            for p in order[s:e].tolist():
                hit[p] += 1
                hit[p + run] -= 1
    covered = np.cumsum(hit)[: len(x)] > 0
    starts = np.cumsum(lens + 1) - lens - 1
    return [covered[s : s + n] for s, n in zip(starts.tolist(), lens.tolist())]


def _windows_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Segments:
    """The tokens of many blocks as 64-bit hashes, cut into segments whose windows of a run of tokens share their least GRAM-gram.

    A block shorter than a run is one segment, filled up with values of its own.
    """

    def __init__(self, texts: Sequence[str], loose: np.ndarray) -> None:
        cp, at = wordscan.points(texts)
        s, e = wordscan.stretches(wordscan.classes()[cp] != wordscan.SPACE, at)
        self.tokens = wordscan.hashes(cp, s, e)
        self.first = np.searchsorted(s, at)
        found = [self._cut(np.flatnonzero(loose), RUN), self._cut(np.flatnonzero(~loose), FIRM_RUN)]
        self.block, self.key, self.start, self.end = (np.concatenate(c) for c in zip(*found, strict=True))
        self.loose = loose

    def _cut(self, blocks: np.ndarray, run: int) -> tuple[np.ndarray, ...]:
        a, b = self.first[blocks], self.first[blocks + 1]
        whole = (b > a) & (b - a < run)
        own = [np.zeros(0, np.int64)] * 4
        if whole.any():
            x, y = a[whole], b[whole]
            i = wordscan.spread(x, y - x)
            place = (i - np.repeat(x, y - x)).astype(np.uint64)
            mixed = wordscan.mix(wordscan.mix(self.tokens[i]) + (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            names = wordscan.mix(np.add.reduceat(mixed, np.cumsum(y - x) - (y - x)))
            own = [blocks[whole], names.view(np.int64), x, y]
        long = b - a >= run
        if not long.any():
            return (*own[:1], own[1] ^ run, *own[2:])
        blocks, a, b = blocks[long], a[long], b[long]
        grams = np.zeros(len(self.tokens) - GRAM + 1, np.uint64)
        for j in range(GRAM):
            grams = wordscan.mix(grams * np.uint64(0x9E3779B97F4A7C15) + self.tokens[j : j + len(grams)])
        least = _windows_least(grams, run - GRAM + 1)
        n = b - a - run + 1  # windows of each block
        at = wordscan.spread(a, n)
        key, owner = least[at], np.repeat(np.arange(len(a)), n)
        head = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))
        last = np.append(head[1:], len(at)) - 1
        return (np.append(own[0], blocks[owner[head]]), np.append(own[1], key[head].view(np.int64)) ^ run, np.append(own[2], at[head]), np.append(own[3], at[last] + run))

    def stream(self, k: int) -> tuple[int, np.ndarray]:
        """A segment's place in its block, and its tokens."""
        block = self.block[k]
        run = RUN if self.loose[block] else FIRM_RUN
        t = self.tokens[self.start[k] : self.end[k]]
        if len(t) < run:
            t = np.append(t, wordscan.mix(np.uint64(self.key[k].view(np.uint64)) + np.arange(1, run - len(t) + 1, dtype=np.uint64)))
        return int(self.start[k] - self.first[block]), t


def _of_pages(batch: pa.RecordBatch, pages: int = 128) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, Segments]]:
    """Some pages at a time: rows, the page of each block, its number there, and the segments."""
    for at in range(0, len(batch), pages):
        part = batch.slice(at, pages)
        each = [b or [] for b in part.column("blocks").to_pylist()]
        n = np.array([len(b) for b in each], np.int64)
        texts, loose = [x["text"] for b in each for x in b], np.array([x["loose"] for b in each for x in b], bool)
        if texts:
            yield part, np.repeat(np.arange(len(n)), n), wordscan.spread(np.zeros(len(n), np.int64), n), Segments(texts, loose)


def _left(found: list[dict], spans: list[dict]) -> str:
    """The text of a page without its repeated runs."""
    words = [b["text"].split() for b in found]
    gone: list[set[int]] = [set() for _ in found]
    for s in spans:
        if found[s["block"]]["loose"] != s["firm"]:
            gone[s["block"]].update(range(s["from"], min(s["to"], len(words[s["block"]]))))
    total = sum(map(len, words))
    loose = [i for i, b in enumerate(found) if b["loose"]]
    if sum(len(gone[i]) for i in loose) < NEARLY * total:
        for i in loose:
            words[i] = [w for k, w in enumerate(words[i]) if k not in gone[i]]
    total = sum(map(len, words))
    firm = [i for i, b in enumerate(found) if not b["loose"] and len(gone[i]) == len(words[i])]
    if sum(len(words[i]) for i in firm) <= HALF * total:
        for i in firm:
            words[i] = []
    return "\n\n".join(" ".join(w) for w in words if w)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    spark = pages.sparkSession
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.xxhash64(host).alias("host"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kind = src.schema["page_id"].dataType.simpleString()
    item = pa.struct([("text", pa.string()), ("loose", pa.bool_())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in wordscan.small(batches, lambda b: b.column("html")):
            found = [[{"text": t, "loose": x} for t, x in blocks(page)] for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host", "row")), pa.array(found, pa.list_(item))], ["page_id", "url", "host", "row", "blocks"])

    parsed = src.mapInArrow(parse, f"page_id {kind}, url string, host long, row long, blocks array<struct<text: string, loose: boolean>>")
    content = F.xxhash64(F.transform("blocks", lambda b: b["text"]))
    parsed = stash(parsed.withColumn("content", content), "pages")
    sizes = stash(parsed.groupBy("host", "content").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES), "hosts")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, page, _, cut in _of_pages(batch):
                both = np.unique(np.stack([page[cut.block], cut.key], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([part.column("host").take(pa.array(both[:, 0])), pa.array(both[:, 1])], ["host", "key"])

    # pages with the hash, copies included: at least as many as the distinct contents that a run needs
    often = parsed.select("host", "blocks").mapInArrow(keys, "host long, key long").groupBy("host", "key").agg(F.count("*").alias("times")).where(F.col("times") >= PAGES)
    often = stash(often.join(sizes, "host").where(F.col("times") >= SHARE * F.col("n")).select("host", "key"), "keys")
    marks = spark.sparkContext.broadcast(bit_map(often, F.col("host").bitwiseXOR(F.col("key"))))
    piece = pa.schema([("host", pa.int64()), ("key", pa.int64()), ("row", pa.int64()), ("content", pa.int64()), ("block", pa.int32()), ("at", pa.int32()), ("firm", pa.bool_()), ("tokens", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, page, number, cut in _of_pages(batch):
                host, row, content = (part.column(c).to_numpy() for c in ("host", "row", "content"))
                own = page[cut.block]
                out = []
                for k in np.flatnonzero(marked(marks.value, host[own] ^ cut.key)).tolist():
                    at, t = cut.stream(k)
                    p, b = own[k], cut.block[k]
                    out.append((host[p], cut.key[k], row[p], content[p], number[b], at, not cut.loose[b], t.tobytes()))
                yield _batch(out, piece)

    pieces = parsed.select("host", "row", "content", "blocks").mapInArrow(cut, "host long, key long, row long, content long, block int, at int, firm boolean, tokens binary")
    pieces = stash(pieces.join(often, ["host", "key"], "left_semi"), "segments")
    # one stream for each page and least hash, so that a page counts once for a run
    streams = pieces.groupBy("host", "key", "firm", "content").agg(F.sort_array(F.collect_set("tokens")).alias("parts")).groupBy("host", "key", "firm", "parts").agg(F.count("*").alias("pages"))
    groups = streams.join(sizes, "host").select("host", "key", "firm", "parts", "pages", "n").repartition(width(spark), "host", "key").sortWithinPartitions("host", "key", "firm")
    cover = pa.schema([("host", pa.int64()), ("key", pa.int64()), ("tokens", pa.binary()), ("firm", pa.bool_()), ("lo", pa.int32()), ("hi", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def out() -> pa.RecordBatch:
            host, key, firm, size = name
            rows = set()
            joined, breaks = [], 0
            for parts, _ in held:
                s = []
                for t in parts:
                    s += [np.frombuffer(t, np.uint64), wordscan.mix(np.array([breaks], np.uint64))]  # a value that no other stream has
                    breaks += 1
                joined.append(np.concatenate(s))
            run, least = (FIRM_RUN, FIRM_PAGES) if firm else (RUN, PAGES)
            for (parts, _), m in zip(held, repeated(joined, [n for _, n in held], run, max(least, math.ceil(SHARE * size))), strict=True):
                at = 0
                for t in parts:
                    end = at + len(t) // 8
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], m[at:end].astype(np.int8), [0]])))
                    rows.update((host, key, t, firm, int(a), int(b)) for a, b in edge.reshape(-1, 2))
                    at = end + 1
            return _batch(list(rows), cover)

        for batch in batches:
            for h, key, firm, parts, n, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h, key, firm, size) != name and held:
                    yield out()
                    held = []
                name = (h, key, firm, size)
                held.append((parts, n))
        if held:
            yield out()

    covered = groups.mapInArrow(search, "host long, key long, tokens binary, firm boolean, lo int, hi int")
    spans = pieces.join(covered, ["host", "key", "firm", "tokens"]).groupBy("row").agg(F.collect_list(F.struct("block", "firm", (F.col("at") + F.col("lo")).alias("from"), (F.col("at") + F.col("hi")).alias("to"))).alias("spans"))
    # small where little repeats: then the planner may broadcast it, and no text is shuffled
    joined = parsed.join(stash(spans, "spans"), "row", "left")
    done = joined.where("spans IS NULL").select("page_id", "url", F.array_join(F.transform("blocks", lambda b: b["text"]), "\n\n").alias("text"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_left(found, gone or []) for found, gone in zip(batch.column("blocks").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rest = joined.where("spans IS NOT NULL").select("page_id", "url", "blocks", "spans").mapInArrow(finish, f"page_id {kind}, url string, text string")
    return done.unionByName(rest).withColumn("n_chars", F.length("text").cast("long"))
