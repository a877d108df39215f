"""Main text of pages: block extraction, and a host suffix array over the text outside the articles.

A page is cut into blocks at block-level tags. Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms and reader comments are boilerplate by their markup; blocks inside ``article`` (or ``main``, where a page has no
``article``) are content; the others are body. The token streams of everything outside the content are concatenated by host: every suffix of a stream, cut to ``RUN`` tokens, is a
row, and the rows of all hosts are sorted across tasks by suffix and host (and page, so that no host and no suffix is a single task). Suffixes that equal those of ``PAGES`` distinct
pages of the host or more mark a substring of ``RUN`` tokens or more that repeats; a block of fewer tokens is a suffix of its own, which ends with the block. Body blocks mostly covered
by what repeats go as boilerplate. What is left are the content blocks and the unique body, beside an article too, whatever its length.
Hosts without body blocks aren't sorted, since nothing hangs on their repeats.

Names of classes and ids are read as whole words: all parts of a name must be of the lists below, and one of ``DROP_WORDS``, so that ``site-header`` drops an element
and ``side-effects`` doesn't. Paragraphs and headings inside an article go for the name of an advert only.

Defined cases: null and empty html give empty text; null urls are a host of their own; repeated pages count as distinct pages; null page_ids
are kept; an empty table gives none; a very long page is read in linear time, whole; unclosed tags end with the next block or where an element around them
ends, and cut-off tags and comments end with the page; other columns aren't read.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import BROADCAST_ROWS, lookup, materialize
from tarnspark.llm.words import utf8

RUN, PAGES = 8, 3
#: Fixed word lists of HTML.
BLOCK_TAGS = frozenset((
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "title", "tr", "ul",
))
DROP_TAGS = frozenset(("aside", "button", "dialog", "footer", "form", "header", "menu", "nav", "select", "textarea"))
RAW_TAGS = frozenset(("script", "style", "noscript", "template", "svg", "iframe", "object", "head", "math", "audio", "video", "canvas"))
VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
DROP_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "toolbar"))
TEXT_TAGS = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of names that drop an element, those of adverts an inline one and a paragraph of an article, too.
ADVERT_WORDS = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "sponsor", "sponsors", "sponsored", "promo", "promos", "promotion"))
DROP_WORDS = ADVERT_WORDS | frozenset((
    "banner", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "side", "header", "masthead", "footer", "cookie", "cookies", "consent", "notice",
    "notices", "alert", "alerts", "popup", "modal", "newsletter", "subscribe", "share", "sharing", "social", "related", "recommended", "comment", "comments", "respond", "replies",
    "disqus", "widget", "widgets", "toolbar", "skip",
))
#: Words that may stand beside them in one name.
PLACE_WORDS = frozenset((
    "site", "page", "top", "bottom", "left", "right", "global", "primary", "secondary", "main", "item", "items", "list", "bar", "box", "block", "wrapper", "container", "inner",
    "section", "area", "group", "link", "links", "button", "buttons", "icons", "article", "articles", "post", "posts", "entry", "form", "thread",
))
#: Every alternative ends at the next angle bracket, at a closing mark, or takes the rest of the page, so that a page is read in linear time.
_TAG = re.compile(r"<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)[^<>]*+>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'=/<>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_MAIN = re.compile(r"<(?:article|main)[\s>]", re.I)
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th", "tr", "tbody", "tfoot"), "th": ("td", "th", "tr", "tbody", "tfoot"), "tr": ("tr", "tbody", "tfoot"), "thead": ("tbody", "tfoot"), "tbody": ("tbody", "tfoot")}
OUT, BODY, CONTENT = 0, 1, 2


@functools.lru_cache(4096)
def _names(value: str, words: frozenset[str]) -> bool:
    """Whether a class or id has a name whose parts are all of the lists, one of them of ``words``."""
    for name in value.lower().split():
        parts = [x for x in re.split("[-_]+", name) if x]
        if any(x in words for x in parts) and all(x in DROP_WORDS or x in PLACE_WORDS for x in parts):
            return True
    return False


def _dropped(tag: str, attributes: str, inside: bool) -> bool:
    """inside: the tag stands in an article or main."""
    if tag in DROP_TAGS:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    words = DROP_WORDS if tag in BLOCK_TAGS and not (inside and tag in TEXT_TAGS) else ADVERT_WORDS
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "role" and tag in BLOCK_TAGS and value.strip().lower() in DROP_ROLES or name in ("class", "id") and _names(value, words):
            return True
    return False


def _implied(opened: str, tag: str) -> bool:
    """Whether a start tag ends an open element whose end tag authors may omit."""
    return tag in BLOCK_TAGS if opened == "p" else tag in _ENDS.get(opened, ())


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of each block of a page in page order. Where names of classes and ids leave no article or main, an
    article or main ends the dropped part that it stands in."""
    found = _blocks(page or "", False)
    if page and not any(k == CONTENT for k, _ in found) and _MAIN.search(page):
        again = _blocks(page, True)
        return again if any(k == CONTENT for k, _ in again) else found
    return found


def _blocks(page: str, rescue: bool) -> list[tuple[int, str]]:
    out: list[tuple[int, str]] = []
    held: list[str] = []
    names = {"article": 0, "main": 0}  # how many are open
    stack: list[str] = []  # open block elements, and dropped inline ones
    count: Counter[str] = Counter()  # of the stack
    skip = 0  # the size of the stack with the dropped element on it, if one is open
    by_name = False  # it is dropped for its class, id or role
    marks = [0, 0]  # pieces seen in article and in main
    inline = -1  # the size of held where a dropped inline element began, if one is open
    unended: set[str] = set()  # raw elements that have no end in the rest of the page

    def close() -> None:
        nonlocal inline
        if inline >= 0:
            del held[inline:]
            inline = 0
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            kind = OUT if skip and inline < 0 else CONTENT + 1 if names["article"] else CONTENT if names["main"] else BODY
            out.append((kind, text))
            if kind >= CONTENT:
                marks[kind - CONTENT] += 1

    def pop(size: int) -> None:
        nonlocal skip, inline
        if skip > size:
            if inline >= 0:
                del held[inline:]
                inline = -1
            else:
                close()
        while len(stack) > size:
            tag = stack.pop()
            count[tag] -= 1
            if skip > len(stack):
                skip = 0
            elif not skip and tag in names:
                names[tag] = max(0, names[tag] - 1)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            held.append(page[at:])
            break
        held.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                held.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        closing = bool(m[1] or m[4])
        if tag in RAW_TAGS and not closing and not m[0].endswith("/>"):
            stop = None if tag in unended else re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            if not stop:
                unended.add(tag)
            if tag == "head" and not stop:
                stop = re.compile("<body", re.I).search(page, at)
                at = stop.start() if stop else end
            else:
                at = stop.end() if stop else end
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK_TAGS or tag in DROP_TAGS:
            close()
        if tag in VOID_TAGS:
            continue
        if closing:
            at_tag = len(stack) - 1 if count[tag] else -1
            while at_tag >= 0 and stack[at_tag] != tag:
                # a stray end tag doesn't end an article
                at_tag = -1 if stack[at_tag] in names and tag not in ("article", "main", "body", "html") else at_tag - 1
            if at_tag >= 0:
                pop(at_tag)
            continue
        while tag in BLOCK_TAGS:  # elements that this tag ends
            top = len(stack) - 1
            while top >= 0 and stack[top] not in BLOCK_TAGS:
                top -= 1
            if top < 0 or not _implied(stack[top], tag):
                break
            pop(top)
        if skip and rescue and by_name and tag in names and not names["article"] and not names["main"]:
            close()
            skip = 0
        named = tag not in DROP_TAGS
        if not skip and _dropped(tag, m[3] or "", bool(names["article"] or names["main"])) and not (rescue and named and tag in names and not names["article"] and not names["main"]):
            if tag in BLOCK_TAGS or tag in DROP_TAGS:
                close()
            else:
                inline = len(held)
            stack.append(tag)
            count[tag] += 1
            skip, by_name = len(stack), named
        elif tag in BLOCK_TAGS or tag in DROP_TAGS or skip and tag == stack[skip - 1]:
            stack.append(tag)
            count[tag] += 1
        else:
            continue
        if tag in names and not skip:
            names[tag] += 1
    close()
    # an article makes the rest of the page boilerplate or body; main does so where there is no article
    best = CONTENT + 1 if marks[1] else CONTENT if marks[0] else None
    return [(OUT if k == OUT else (CONTENT if k == best else BODY) if best else BODY, t) for k, t in out]


_BLOCKS = "page long, page_id long, url string, host string, kinds array<tinyint>, texts array<string>"


def _parse(batches):
    from pyspark import TaskContext

    page = TaskContext.get().partitionId() << 33
    for b in batches:
        found = [blocks(x) for x in b.column("html").to_pylist()]
        kinds = pa.array([[k for k, _ in f] for f in found], pa.list_(pa.int8()))
        text = pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))
        pages = pa.array(np.arange(page, page + b.num_rows))
        page += b.num_rows
        yield pa.RecordBatch.from_arrays([pages, b.column("page_id"), b.column("url"), b.column("host"), kinds, text], ["page", "page_id", "url", "host", "kinds", "texts"])


def stream(kinds: list[int], texts: list[str]) -> list[tuple[str, bool]]:
    """The tokens of a page outside its content, each with whether it is of a body block."""
    return [(w, k == BODY) for k, t in zip(kinds, texts, strict=True) if k != CONTENT for w in t.split()]


def short_blocks(kinds: list[int], texts: list[str]) -> list[tuple[int, int, int]]:
    """(start in the stream, tokens, kind) of the blocks of under ``RUN`` tokens outside the content."""
    out, at = [], 0
    for k, t in zip(kinds, texts, strict=True):
        if k != CONTENT:
            n = len(t.split())
            if n < RUN:
                out.append((at, n, k))
            at += n
    return out


#: Suffixes that a task holds at once, and the bytes of one.
_ROWS, _WIDTH = 100_000, 4 * RUN
_SUFFIX = "suffix binary, host long, page long, place int, own boolean"


def _binaries(data: bytes) -> pa.Array:
    n = len(data) // _WIDTH
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * _WIDTH, _WIDTH, dtype=np.int32).tobytes()), pa.py_buffer(data)])


def _suffixes(batches):
    """Every suffix of a page's stream by its first ``RUN`` tokens (four bytes of a hash each, end to end), with a hash of its host; own: whether it starts in a body block or
    reaches one. A shorter block is also a suffix by itself, as a hash filled up with zeros, at the place -1 - its start."""
    held: list[tuple] = []
    size = 0

    def rows() -> pa.RecordBatch:
        data, *columns = zip(*held, strict=True)
        columns = [np.concatenate(c) for c in columns]
        held.clear()
        return pa.RecordBatch.from_arrays([_binaries(b"".join(data)), *map(pa.array, columns)], ["suffix", "host", "page", "place", "own"])

    for b in batches:
        for h, p, kinds, texts in zip(b.column("host").to_pylist(), b.column("page").to_pylist(), b.column("kinds").to_pylist(), b.column("texts").to_pylist(), strict=True):
            tokens = stream(kinds, texts)
            words = [w for w, _ in tokens]
            names = np.frombuffer(b"".join(xxhash.xxh3_64_digest(utf8(w))[:4] for w in words), np.uint32)
            n = max(0, len(words) - RUN + 1)
            reach = np.cumsum([0, *[x for _, x in tokens]])
            short = short_blocks(kinds, texts)
            alone = [xxhash.xxh3_128_digest(utf8(" ".join(words[i : i + k]))).ljust(_WIDTH, b"\0") for i, k, _ in short]
            host = np.uint64(xxhash.xxh3_64_intdigest(utf8(h))).astype(np.int64)
            for at in range(0, n + 1, _ROWS):
                to = min(at + _ROWS, n)
                last = to == n
                data = np.lib.stride_tricks.sliding_window_view(names, RUN)[at:to].tobytes() if n else b""
                place = np.r_[np.arange(at, to), [-1 - i for i, _, _ in short] if last else []].astype(np.int32)
                own = np.r_[reach[at + RUN : to + RUN] > reach[at:to], [k == BODY for _, _, k in short] if last else []].astype(bool)
                held.append((data + b"".join(alone if last else []), np.full(len(place), host), np.full(len(place), p, np.int64), place, own))
                size += len(place)
                if size >= _ROWS:
                    yield rows()
                    size = 0
                if last:
                    break
    if size:
        yield rows()


def _repeats(batches):
    """Of rows sorted by suffix, host and page: (page, place) of suffixes that are on ``PAGES`` pages of their host. The first and the last suffix of a task can
    go on in others: their pages are told (n), and so are their rows as long as these pages are too few. A suffix whose rows fill batches is carried on as its page
    count."""
    now: tuple | None = None  # the suffix and host that the rows so far end with
    pages, last, first = 0, None, True
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    edges: list[tuple] = []

    def end(edge: bool) -> None:
        if edge and now is not None:
            edges.append((*now, None, None, pages))
            edges.extend((*now, int(p), int(i), 0) for ps, is_ in waiting for p, i in zip(ps, is_, strict=True))
        waiting.clear()

    def told(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        page, place = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int32))
        columns = list(zip(*edges, strict=True)) or [()] * 5
        edges.clear()
        none = len(page)
        suffix, host, p, i, n = (pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True))
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.nulls(none, pa.binary()), suffix]), pa.concat_arrays([pa.nulls(none, pa.int64()), host]), pa.concat_arrays([pa.array(page, pa.int64()), p]),
            pa.concat_arrays([pa.array(place, pa.int32()), i]), pa.concat_arrays([pa.nulls(none, pa.int64()), n]),
        ], ["suffix", "host", "page", "place", "n"])

    for b in batches:
        size = b.num_rows
        if not size:
            continue
        raw = b.column("suffix")
        names = np.frombuffer(b"".join(raw.to_pylist()), np.uint64).reshape(size, _WIDTH // 8)
        host, page, place, own = (b.column(c).to_numpy(zero_copy_only=False) for c in ("host", "page", "place", "own"))
        new = np.r_[True, (names[1:] != names[:-1]).any(axis=1) | (host[1:] != host[:-1])]
        starts = np.flatnonzero(new)
        stops = np.r_[starts[1:], size]
        new_page = new | np.r_[True, page[1:] != page[:-1]]
        seen = np.cumsum(new_page)
        count = seen[stops - 1] - seen[starts] + 1  # pages of each group of this batch
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def take(k: int, more: int) -> None:
            """Group k of the batch as the one that is carried on, or as more of it."""
            nonlocal pages, last
            pages += more
            last = page[stops[k] - 1]
            mine = slice(starts[k], stops[k])
            keep = own[mine]
            waiting.append((page[mine][keep], place[mine][keep]))
            if pages >= PAGES:
                found.extend(waiting)
                waiting.clear()

        begin = 0
        key = (raw[0].as_py(), int(host[0]))
        if key == now:
            take(0, int(count[0]) - int(page[0] == last))
            begin = 1
        if begin < len(starts):
            if now is None:  # the first suffix of the task
                now, pages = key, 0
                take(0, int(count[0]))
                begin = 1
            if begin < len(starts):
                end(first)
                first = False
                inner = np.zeros(len(starts), bool)
                inner[begin : len(starts) - 1] = True
                mark = np.repeat(inner & (count >= PAGES), stops - starts) & own
                found.append((page[mark], place[mark]))
                k = len(starts) - 1
                now, pages = (raw[int(starts[k])].as_py(), int(host[starts[k]])), 0
                take(k, int(count[k]))
        yield told(found)
    end(True)
    yield told([])


def repeated(parsed: DataFrame) -> DataFrame:
    """page and places, the starts in its stream of substrings of ``RUN`` tokens found on ``PAGES`` pages of its host or more."""
    hosts = parsed.where(F.array_contains("kinds", F.lit(BODY).cast("tinyint"))).select("host").distinct()
    if hosts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        asked = parsed.join(F.broadcast(hosts), "host", "left_semi")
    else:  # texts are dealt by page: a host's pages are many
        asked = parsed.join(parsed.select("page", "host").join(hosts, "host", "left_semi").select("page"), "page", "left_semi")
    asked = asked.select("host", "page", "kinds", "texts")
    suffixes = asked.mapInArrow(_suffixes, _SUFFIX)
    n = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["suffix", "host", "page"]  # all places of a suffix in a page are in one task
    found = materialize(suffixes.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_repeats, "suffix binary, host long, page long, place int, n long"), "repeats")
    edges = found.where("n > 0").groupBy("suffix", "host").agg(F.sum("n").alias("pages")).where(F.col("pages") >= PAGES)
    late = found.where("n = 0").join(edges, ["host", "suffix"], "left_semi").select("page", "place")
    return found.where("n is null").select("page", "place").unionByName(late).groupBy("page").agg(F.collect_set("place").alias("places"))


def assemble(kinds: list[int], texts: list[str], places: list[int] | None) -> str:
    """The text of a page, given where repeated substrings of its stream start."""
    words = [len(t.split()) if k != CONTENT else 0 for k, t in zip(kinds, texts, strict=True)]
    on, short = np.zeros(sum(words), bool), {-1 - i: n for i, n, _ in short_blocks(kinds, texts)}
    for p in places or ():
        if p < 0:
            on[-1 - p : -1 - p + short[p]] = True
        else:
            on[p : p + RUN] = True
    keep, at = [], 0
    for k, t, n in zip(kinds, texts, words, strict=True):
        again = n and 2 * int(on[at : at + n].sum()) >= n
        at += n
        if k == CONTENT or k == BODY and not again:
            keep.append(t)
    return "\n\n".join(keep)


def _assemble(batches):
    for b in batches:
        rows = zip(b.column("kinds").to_pylist(), b.column("texts").to_pylist(), b.column("places").to_pylist(), strict=True)
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array([assemble(*r) for r in rows], pa.string())], ["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"://([^/?#]*)", 1)), F.lit(""))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    parsed = materialize(slim.mapInArrow(_parse, _BLOCKS), "blocks")
    places = materialize(repeated(parsed), "places")
    return parsed.join(lookup(places), "page", "left").select("page_id", "url", "kinds", "texts", "places").mapInArrow(_assemble, "page_id long, url string, text string")
