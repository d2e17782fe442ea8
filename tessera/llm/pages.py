"""Main text of web pages: text that a host repeats, and page structure.

A page is cut into blocks of text, each main (in an ``article`` or ``main`` element, less
what is set apart there), set apart (menus, headers, footers, sidebars, notices,
adverts, forms, comments) or other. All blocks that are not main make up the page's
stream of words, and a host's streams are put together: a run of at least ``RUN_WORDS`` words
that is found on two different pages of the host is repeated text; pages without main
blocks whose other blocks are the same, in the same order, are copies of one page here, so
that a text served under several addresses is not taken for boilerplate. Blocks half covered by
such runs are boilerplate and go. An exact check by structure follows: blocks that are set apart
go even where no other page repeats them, and on a page with main blocks those
are its text, whoever else may have the same article. Without main blocks, the other blocks
that the host does not repeat are the text, each of them whole.

Runs are found through the host's suffixes cut to ``RUN_WORDS`` words: two
suffixes have a common prefix of that length exactly if their keys are equal, so
grouping keys puts neighbours of the suffix array together without sorting a
host in one task. Suffixes are reduced to one row a key before they are shuffled.

Handling of odd rows: null or empty html has an empty text; a null url is a host
of its own; equal rows, and copies without main blocks, count as one page when repeats
are looked for, and each gets its own result; an unclosed element ends with its parent; an unclosed
comment, script or style takes the rest of the page; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_column, hashed_words, mix64, slices

RUN_WORDS = 8

#: Element names and class words of HTML pages.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav footer aside form dialog menu button select textarea fieldset iframe object svg canvas noscript template head title".split())
LOOSE = frozenset("p li dt dd tr td th option".split())
CHROME_WORDS = frozenset("""ad ads advert adverts advertisement adsense sponsor sponsored promo banner cookie cookies consent gdpr notice
notices alert popup modal overlay sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs footer comment comments
disqus respond share sharing social related recommended newsletter subscribe subscription signup login search widget
pagination pager toolbar skip""".split())
COMMENT_WORDS = frozenset("comment comments disqus respond".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())

_RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?][^>]*>""")
_CLASS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", re.I)

MAIN, OTHER, APART = 2, 1, 0


def _kind(tag: str, attributes: str, above: str) -> str:
    """What an element holds: main, apart, comments, or what the element above it does."""
    words, roles = set(), set()
    if "=" in attributes:
        for name, a, b, c in _CLASS.findall(attributes):
            found = re.split(r"[^a-z]+", (a or b or c).lower())
            (roles if name.lower() == "role" else words).update(found)
    if above == "comments" or words & COMMENT_WORDS:
        return "comments"
    if tag in ("article", "main") or "main" in roles and tag != "body":
        return "main"
    if above == "apart":
        return "apart"
    if tag in CHROME or tag == "header" and above != "main" or words & CHROME_WORDS or roles & CHROME_ROLES \
            or attributes and _HIDDEN.search(attributes):
        return "apart"
    return above


def blocks(html: str) -> list[tuple[int, str]]:
    """(region, text) of the blocks of a page, in order; region: main, other or apart."""
    html = _RAW.sub(" ", html)
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, str]] = []
    region, pending, at = "other", [], 0

    def flush():
        text = " ".join(unescape("".join(pending)).split())
        if text:
            out.append((MAIN if region == "main" else OTHER if region == "other" else APART, text))
        pending.clear()

    for tag in _TAG.finditer(html):
        if tag.start() > at:
            pending.append(html[at:tag.start()])
        at = tag.end()
        closing, name, attributes = tag.groups()
        if name is None:
            continue
        name = name.lower()
        if name in INLINE and not (attributes and not closing and _kind(name, attributes, region) != region):
            if closing and any(t == name for t, _ in stack):
                pass
            else:
                continue
        flush()
        if name in VOID or name in ("html", "body") or attributes and attributes.endswith("/"):
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        else:
            if name in LOOSE and stack and stack[-1][0] == name:
                stack.pop()
            above = stack[-1][1] if stack else "other"
            stack.append((name, _kind(name, attributes, above)))
        region = stack[-1][1] if stack else "other"
    if at < len(html):
        rest = html[at:]
        cut = re.search(r"<[a-zA-Z/!?]", rest)          # a tag that never ends
        pending.append(rest[:cut.start()] if cut else rest)
    flush()
    return out


def host_of(url: str | None) -> str:
    match = _HOST.match(url or "")
    return match[1].lower() if match else ""


def run_keys(hashes: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key of the run of ``words`` words at each place, the place, and its text; runs stay in a text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.zeros(n, np.uint64)
    for k in range(words):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    inside = np.flatnonzero(text[:n] == text[words - 1:])
    return mix64(key[inside]), inside, text[inside]


def copy_name(found: list[tuple[int, str]]) -> int | None:
    """A name that the copies of a page share: of its other blocks. None for a page with main blocks, or without others."""
    others = [t for r, t in found if r == OTHER]
    if not others or any(r == MAIN for r, _ in found):
        return None
    name = blake2b("\0".join(others).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(name, "little", signed=True)


def _suffixes(batch: pa.RecordBatch):
    """(key, uid, copy, at) of the runs in each page's stream; the key holds the host."""
    uid, urls, pages = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
    streams, copies = [], []
    for h, own in zip(pages, uid.to_pylist(), strict=True):
        found = blocks(h) if h else []
        name = copy_name(found)
        streams.append(" ".join(t for r, t in found if r != MAIN))
        copies.append(own if name is None else name)
    copy = pa.array(copies, pa.int64())
    raw, bounds = binary_column(pa.array(streams, pa.large_string()))
    names = np.array([zlib.crc32(host_of(u).encode()) for u in urls], np.uint64) << np.uint64(20)
    for at, to in slices(bounds):
        hashes, of = hashed_words(raw[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at])
        key, place, page = run_keys(hashes, of, RUN_WORDS)
        key = mix64(key ^ names[page + at])
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), uid.take(pa.array(page + at)), copy.take(pa.array(page + at)),
                                          pa.array((place - of[page]).astype(np.int32))], ["key", "uid", "copy", "at"])


def _parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Main text of pages that have one; else the other blocks, their first word in the page's stream, and their words."""
    mains, texts, firsts = [], [], []
    for html in batch.column(3).to_pylist():
        found = blocks(html) if html else []
        main = [t for r, t in found if r == MAIN]
        # packed for the shuffle: the text of a page is most of what moves
        mains.append(zlib.compress(" ".join(main).encode("utf-8", "surrogatepass"), 1) if main else None)
        some, first, at = [], [], 0
        for region, text in [] if main else found:
            if region == OTHER:
                some.append(text)
                first.append(at)
            at += len(_WORD.findall(text))
        texts.append(some)
        firsts.append(first)
    return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(mains, pa.binary()), pa.array(texts, pa.list_(pa.string())), pa.array(firsts, pa.list_(pa.int32()))],
                                      ["page_id", "url", "uid", "main", "others", "firsts"])


def _finish(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The text of each page, and how many words of its stream the host repeats."""
    out, repeated = [], []
    columns = (batch.column(c).to_pylist() for c in ("main", "others", "firsts", "starts"))
    for main, others, firsts, starts in zip(*columns, strict=True):
        starts = np.array(starts or (), np.int64)
        covered = np.zeros(int(starts.max(initial=-1)) + RUN_WORDS + 1, np.int64)
        for k in range(RUN_WORDS):
            covered[starts + k] = 1
        total = np.concatenate([[0], np.cumsum(covered)])
        repeated.append(int(covered.sum()))
        if main is None:
            kept = []
            for text, at in zip(others, firsts, strict=True):
                n = len(_WORD.findall(text))
                if 2 * (total[min(at + n, len(covered))] - total[min(at, len(covered))]) < max(n, 1):
                    kept.append(text)
            out.append(" ".join(kept))
        else:
            out.append(zlib.decompress(main).decode("utf-8", "surrogatepass"))
    return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(repeated, pa.int64())],
                                      ["page_id", "url", "text", "n_repeated"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_repeated (words outside the main text that other pages of the host have) of every page."""
    kind = pages.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.xxhash64(F.col(id_col), F.col(url_col), F.col(html_col)).alias("uid"), F.col(html_col).alias("html"))
    suffixes = arrow_map(rows.select("uid", "url", "html"), _suffixes, "key long, uid long, copy long, at int")      # parsed again for each use: less disk
    repeated = suffixes.groupBy("key").agg(F.min("copy").alias("a"), F.max("copy").alias("b")).filter("a <> b").select("key")
    covered = suffixes.select("key", "uid", "at").join(repeated, "key", "left_semi").groupBy("uid").agg(F.collect_set("at").alias("starts"))
    parsed = arrow_map(rows, _parsed, f"page_id {kind}, url string, uid long, main binary, others array<string>, firsts array<int>")
    return arrow_map(parsed.join(covered, "uid", "left"), _finish, f"page_id {kind}, url string, text string, n_repeated long")
