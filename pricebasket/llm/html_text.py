"""HTML extraction with a suffix array per host.

A page is read as blocks of text with a kind each: ``main`` (inside an article
or main element), ``side`` (inside an element that HTML, its role or its class
name as a menu, header, footer, sidebar, notice, advert, form or reader
comments) and ``open`` (any other).  The words of a page's open and side blocks,
in page order, are its token stream.  Main blocks stay out of the streams: a
passage that several articles quote belongs to each of them.

The streams lie sorted by host, and each task concatenates those it has, in
chunks of bounded size, and sorts their suffixes (by prefix doubling, up to
``RUN`` tokens).  Suffixes that share their first ``RUN`` tokens then are
neighbours; each such interval is handed on as one row with the smallest and
the greatest digest of the pages it comes from.  Where those differ, over all
chunks of the host, the run is repeated across distinct pages.  Its tokens are
covered on every page; longer repeats are chains of such runs.  Pages of equal
rendered text are one page here, so a page isn't boilerplate for having a copy.

The text is the main blocks, and the open blocks without their covered runs;
unique runs stay.  What coverage leaves of a side block goes with its element.

Defined results: NULL or empty html gives an empty text; unclosed elements end
with their parent or the page, an unclosed tag is dropped; repeated rows are
one page and get equal rows back; a NULL url, or one without a host, belongs to
the host ''; NULL page_ids pass through; columns other than the three named take
no part.  A page longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import html
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import table, utf8, written

#: Tokens of the shortest run that counts as repeated; tokens of a chunk, about.
RUN, CHUNK_TOKENS = 8, 500_000
#: An odd multiplier for the rolling hash of a run.
BASE = np.uint64(0x9E3779B97F4A7C15)

# Elements by what HTML says they are.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes"}  # their content is no markup, and no text
UNSEEN = {"head", "template", "noscript", "object", "svg", "math", "canvas", "audio", "video", "datalist"}
HEAD = {"base", "link", "meta", "title", "style", "script", "noscript", "template"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SIDE = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "select", "fieldset", "search"}
MAIN = {"article", "main"}
SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert",
              "menu", "menubar", "toolbar"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "img", "wbr", "picture", "input"}
#: Names that classes and ids give to furniture, alone or with one of the affixes.
SIDE_NAMES = ("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
              "notice notices alert newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb "
              "breadcrumbs footer header masthead comment comments reply replies respond discussion share sharing social "
              "related recommended popup modal overlay pagination pager login search skip toolbar widget").split()
SIDE_CLASS = re.compile(
    r"(?:(?:site|page|main|global|top|bottom|left|right|post|user|reader|article)[-_])?(?:" + "|".join(SIDE_NAMES) + r")"
    r"(?:[-_](?:container|wrapper|box|list|section|area|block|bar|item|body|content|inner|form|links|message|slot|unit|\d+))?",
    re.IGNORECASE)
TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                 r"""|(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|/[^>]*(?:>|\Z))""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
HOST = re.compile(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def _named_kind(tag: str, attributes: str, kind: str) -> str | None:
    """The kind that role, class, id or style give an element inside ``kind``, or None."""
    if "=" not in attributes and "hidden" not in attributes:
        return None
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or HIDDEN.search(found.get("style", "")):
        return "unseen"
    role = found.get("role", "").strip().lower()
    if role == "main":
        return "main"
    if tag in ("html", "body", "main"):
        return None
    names = [n for n in [*found.get("class", "").split(), *found.get("id", "").split()] if SIDE_CLASS.fullmatch(n)]
    if kind == "main" or tag in HEADINGS:  # an article's own header is part of it
        names = [n for n in names if "header" not in n.lower()]
    return "side" if role in SIDE_ROLES or names else None


def _inside(tag: str, attributes: str, kind: str) -> str:
    """The kind of what is inside an element that begins inside ``kind``."""
    if kind == "unseen" or tag in UNSEEN:
        return "unseen"
    named = _named_kind(tag, attributes, kind)
    if named == "unseen" or kind == "side":
        return named if named == "unseen" else "side"
    if tag in SIDE or named == "side" or (tag == "header" and kind != "main"):
        return "side"
    return "main" if tag in MAIN or named == "main" else kind


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(kind, text) of the page's blocks with text, white space as one blank."""
    page = page or ""
    out: list[tuple[str, str]] = []
    text: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements that hold blocks or change the kind, and the kind inside them
    kind, at, size = "open", 0, len(page)

    def flush() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            out.append((kind, " ".join(words)))
        text.clear()

    def top() -> str:
        return stack[-1][1] if stack else "open"

    while at < size:
        start = page.find("<", at)
        start = size if start < 0 else start
        if start > at and kind != "unseen":
            text.append(page[at:start])
        m = TAG.match(page, start)
        if m is None:  # the end, or a < that begins no tag
            if start < size and kind != "unseen":
                text.append("<")
            at = start + 1
            continue
        at = m.end()
        tag, attributes = (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        block = tag not in INLINE and tag not in HEAD and tag != "br"
        if not tag:  # a comment or a declaration
            continue
        if m[1] or m[4]:
            if block or (stack and stack[-1][0] == tag):
                flush()
                last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), len(stack))
                del stack[last:]
                kind = top()
            continue
        if block:
            flush()
            # a block ends an open paragraph or heading; what isn't for the head ends it
            if stack and (stack[-1][0] in HEADINGS or stack[-1][0] in ("p", "head")):
                stack.pop()
                kind = top()
        elif tag == "br":
            text.append(" ")
        if tag in VOID:
            continue
        inside = _inside(tag, attributes, kind)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])|\Z", re.IGNORECASE).search(page, at)
            at = end.start()
        elif inside != kind or (block and tag != "p" and tag not in HEADINGS):
            if inside != kind:
                flush()
            stack.append((tag, inside))
            kind = inside
    flush()
    return out


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(utf8(text))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _row_key() -> tuple[Column, Column]:
    cols = ("page_id", "url", "html")
    return F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(1), *cols).alias("k2")


def streams(pages: DataFrame) -> DataFrame:
    """(k1, k2, host, digest, tokens): the token stream of each distinct row of
    ``pages`` (page_id, url, html) as the words joined by blanks, with the
    digest of all its blocks."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("host", pa.string()), ("digest", pa.int64()), ("tokens", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, digests, tokens = [], [], []
            for url, page in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                found = blocks(page)
                hosts.append(host_of(url))
                digests.append(_signed(_hash("\n".join(t for _, t in found))))
                tokens.append(" ".join(t for kind, t in found if kind != "main"))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array(digests, pa.int64()),
                                              pa.array(tokens, pa.string())], schema=schema)

    rows = pages.select(*_row_key(), "url", "html").mapInArrow(run, "k1 long, k2 long, host string, digest long, tokens string")
    return rows.where("tokens != ''").dropDuplicates(["k1", "k2"])


class Streams:
    """Token streams of pages, concatenated."""

    def __init__(self, hosts: list[str], digests: list[int], tokens: list[str]):
        lists = [t.split(" ") for t in tokens]
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ends = np.cumsum(self.sizes)
        known: dict[str, int] = {}
        self.hashes = np.fromiter((known.get(t) or known.setdefault(t, _hash(t) or 1) for ts in lists for t in ts),
                                  np.uint64, int(self.sizes.sum()))
        of_host = {h: _hash(h) for h in set(hosts)}
        self.page = np.repeat(np.arange(len(lists)), self.sizes)
        self.host = np.array([of_host[h] for h in hosts], np.uint64)
        self.digests = np.array(digests, np.int64)
        self.tokens = self.hashes ^ (self.host[self.page] * BASE)  # equal only within a host

    def starts(self, run: int) -> np.ndarray:
        """Positions with ``run`` tokens left in their page."""
        at = np.arange(len(self.tokens))
        return at[at + run <= self.ends[self.page]] if len(at) else at

    def run_keys(self, run: int) -> np.ndarray:
        """Per position of ``starts`` a hash of its next ``run`` tokens and its host."""
        at = self.starts(run)
        key = np.zeros(len(at), np.uint64)
        for i in range(run):
            key = (key ^ (key >> np.uint64(29))) * BASE + self.tokens[at + i]
        return key.view(np.int64)

    def suffix_ranks(self, run: int) -> np.ndarray:
        """Rank of each position's suffix by its first ``run`` tokens (fewer at the
        page's end), by prefix doubling: suffixes that agree in them share a rank."""
        n = len(self.tokens)
        if not n:
            return np.zeros(0, np.int64)
        rank = np.unique(self.tokens, return_inverse=True)[1].astype(np.int64)
        left = self.ends[self.page] - np.arange(n)
        depth = 1
        while depth < run:
            step = min(depth, run - depth)
            later = np.full(n, -1, np.int64)
            inside = np.flatnonzero(left > step)
            later[inside] = rank[inside + step]
            rank = np.unique((rank + 1) * (n + 2) + later + 1, return_inverse=True)[1].astype(np.int64)
            depth += step
        return rank

    def repeats(self, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, host, least digest, greatest digest) per interval of the suffix
        array whose suffixes share ``run`` tokens."""
        at, rank = self.starts(run), self.suffix_ranks(run)
        if not len(at):
            return (np.zeros(0, np.int64),) * 4
        order = np.argsort(rank[at], kind="stable")  # the suffix array, without the suffixes too short for a run
        sorted_rank = rank[at][order]
        begin = np.flatnonzero(np.diff(sorted_rank, prepend=-1))
        digest = self.digests[self.page[at]][order]
        first = order[begin]
        return (self.run_keys(run)[first], self.host[self.page[at[first]]].view(np.int64),
                np.minimum.reduceat(digest, begin), np.maximum.reduceat(digest, begin))

    def covered(self, run: int, keys: np.ndarray) -> np.ndarray:
        """Per token whether it lies in a run of one of ``keys`` (sorted)."""
        marks = np.zeros(len(self.tokens) + 1, np.int64)
        if len(keys):
            at, own = self.starts(run), self.run_keys(run)
            near = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = at[keys[near] == own]
            np.add.at(marks, hit, 1)
            np.add.at(marks, hit + run, -1)
        return np.cumsum(marks[:-1]) > 0


def _chunks(rows: DataFrame, chunk_tokens: int, run: int) -> DataFrame:
    """A row a chunk of streams, in the order of their hosts: the pages, and the
    intervals of the chunk's suffix array."""
    types = ("chunk string, k1 array<long>, k2 array<long>, hosts array<string>, digests array<long>, tokens array<string>, "
             "keys array<long>, key_hosts array<long>, least array<long>, most array<long>")
    longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
    schema = pa.schema([("chunk", pa.string()), ("k1", longs), ("k2", longs), ("hosts", strings), ("digests", longs),
                        ("tokens", strings), ("keys", longs), ("key_hosts", longs), ("least", longs), ("most", longs)])

    def run_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0

        def row() -> pa.RecordBatch:
            cols = [uuid.uuid4().hex, *held, *Streams(*held[2:]).repeats(run)]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches:
            for page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for col, x in zip(held, page, strict=True):
                    col.append(x)
                size += page[4].count(" ") + 1
                if size >= chunk_tokens:
                    yield row()
                    held, size = [[], [], [], [], []], 0
        if held[0]:
            yield row()

    by_host = rows.repartitionByRange("host", "k1").sortWithinPartitions("host", "k1")
    return by_host.select("k1", "k2", "host", "digest", "tokens").mapInArrow(run_chunks, types)


def covered_tokens(pages: DataFrame, run: int = RUN, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(k1, k2, covered): per page with a covered token one bit for each token of its stream."""
    packed = written(_chunks(written(streams(pages), "html-streams"), chunk_tokens, run), "html-chunks")
    intervals = packed.select("chunk", F.explode(F.arrays_zip("keys", "key_hosts", "least", "most")).alias("i")).select("chunk", "i.*")
    keys = ["keys", "key_hosts"]
    repeated = written(intervals.groupBy(*keys).agg(F.min("least").alias("least"), F.max("most").alias("most"))
                       .where("least != most").select(*keys), "html-repeats")
    own = intervals.select("chunk", *keys).join(repeated, keys).select(F.col("chunk").alias("of_chunk"), "keys")

    def mark(chunk: pa.Table, found: pa.Table) -> pa.Table:
        k1, k2, hosts, digests, tokens = (chunk.column(c)[0].as_py() for c in ("k1", "k2", "hosts", "digests", "tokens"))
        lying = Streams(hosts, digests, tokens)
        hit = lying.covered(run, np.unique(found.column("keys").to_numpy()))
        parts = np.split(hit, lying.ends[:-1])
        rows = [(a, b, np.packbits(p).tobytes()) for a, b, p in zip(k1, k2, parts, strict=True) if p.any()]
        return pa.table({"of_k1": pa.array([r[0] for r in rows], pa.int64()), "of_k2": pa.array([r[1] for r in rows], pa.int64()),
                         "covered": pa.array([r[2] for r in rows], pa.binary())})

    of_chunk = packed.select("chunk", "k1", "k2", "hosts", "digests", "tokens")
    return of_chunk.groupBy("chunk").cogroup(own.groupBy("of_chunk")).applyInArrow(mark, "of_k1 long, of_k2 long, covered binary")


def without_covered(found: list[tuple[str, str]], covered: bytes | None) -> tuple[str, int]:
    """The text of a page's blocks, and how many of its stream's tokens are covered."""
    if covered is None:
        return " ".join(t for kind, t in found if kind != "side"), 0
    hit = np.unpackbits(np.frombuffer(covered, np.uint8)).astype(bool).tolist()
    out, at, n = [], 0, 0
    for kind, t in found:
        if kind == "main":
            out.append(t)
            continue
        words = t.split(" ")
        own = hit[at:at + len(words)]
        at += len(words)
        n += sum(own)
        if kind == "open":
            unique = [w for w, gone in zip(words, own, strict=True) if not gone]
            if unique:
                out.append(" ".join(unique))
    return " ".join(out), n


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN,
            chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(page_id, url, text, n_chars, n_covered), a row per row of ``pages``; ``n_covered``
    counts the page's words, outside its article, that lie in runs its host repeats."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    covered = written(covered_tokens(pages, run, chunk_tokens), "html-covered")
    marks = {"main": "m", "open": "o", "side": "s"}
    kinds = {v: k for k, v in marks.items()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a page's blocks are fewer bytes than its html: they are what is joined
        for b in batches:
            read_blocks = ["\n".join(marks[k] + t for k, t in blocks(p)) for p in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(read_blocks, pa.string())],
                                             names=["k1", "k2", "page_id", "url", "blocks"])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [without_covered([(kinds[x[0]], x[1:]) for x in t.split("\n")] if t else [], c)
                    for t, c in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x[0] for x in done], pa.string()),
                 pa.array([len(x[0]) for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_covered"])

    rows = pages.select(*_row_key(), F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        read, "k1 long, k2 long, page_id long, url string, blocks string")
    both = rows.join(covered, (F.col("k1") == F.col("of_k1")) & (F.col("k2") == F.col("of_k2")), "left")
    return both.select("page_id", "url", "blocks", "covered").mapInArrow(
        render, "page_id long, url string, text string, n_chars long, n_covered long")


def op11_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
