"""Main text of web pages: markup read into lines, nearest-URL page differencing, and deletion of shared lines.

A page's lines are its block elements' texts. Within each host, pages are ordered by URL path, and each page is
aligned with its two neighbours there, the one with the longer common path first, by a longest common subsequence of all
their lines, menus and footers included. What a page shares with both of them comes from the site's template and is deleted. Lines are aligned by their text; a line that
is all links, as a menu's are, by its place in the tree instead, so that menus align whose links differ from page to page.

Differencing alone is wrong in two ways. Copies of an article on one host share all of it: so a neighbour that shares over
``COPY`` of the text that markup does not name as anything else is a copy and is not used, and lines inside an ``article`` element are never
deleted. And adverts, footers and comments that differ from page to page are not shared: so of the lines that
differencing leaves, those go whose element's tag, role, class or id says that they are no main text (nav, footer, aside, form,
"ad", "cookie-banner", "comments"; class names count as whole names, not by words inside them). At last, if ``main`` or ``article`` elements hold
at least a third of what is left, the rest outside them goes. A form around the whole page is no form.

Pages are dealt into consecutive ranges of (host, path, id), however many one host has; the last page before and
the first page after each range come along as context, so the result does not depend on where the cuts fall. Cuts are keys
from a sample of ``SAMPLE`` keys a range, at most ``MAX_RANGES`` ranges: beyond 33 million pages ranges grow, and are sorted with spilling
and streamed, three pages at a time.

Edge cases: a null or empty page has an empty text; a null url has an empty host and path; of two equally near neighbours the
one before counts as nearer; repeated rows are neighbours that share everything, so they are not used against each other, and each is
returned; a page cut off inside a tag loses that tag; end tags without a start are skipped; a very long page takes time in proportion to its
length, and its alignment to lines times distinct lines of the neighbour over 64; an empty table gives no rows; extra columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import bisect
import html
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailframe.llm.url_filter import url_host, url_path

#: Pages to a range, sampled keys for each, and ranges at most: what the driver holds is a few keys of each.
RANGE_PAGES, SAMPLE, MAX_RANGES = 512, 4, 1 << 16
_NO_ID = -(1 << 63)
#: Share of a page's unnamed text beyond which a neighbour that has it too is a copy of the page.
COPY = 0.7

# Element names of HTML, by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Never text, and text that is no main text.
DROPPED = frozenset("head script style noscript template svg math iframe object button select textarea canvas audio video map noembed noframes title".split())
NAMED = frozenset("nav footer aside dialog menu".split())
#: An element's start ends an open element of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head", "title"}
# Class names, ids and roles that mark what is not main text.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo promos promoted promotion related recommended replies reply respond share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split()
)
#: Of these, those that count on ``article``, ``main`` and ``section`` too.
MARKED_ARTICLE = frozenset("ad ads advert advertisement comment comments related promo sponsored reply respond".split())
#: Names of two or more parts count if they begin with one of the first and go on with the second, or begin with the third and end with the fourth.
FIRST = frozenset("ad ads advert advertisement breadcrumb comment comments cookie consent newsletter nav navigation promo related recommended share sharing sidebar signup social sponsor sponsored subscribe subscription popup modal".split())
THEN = frozenset("area articles banner bar block body box button buttons container content form icons item items label left link links list menu message modal notice panel popup posts right section signup slot stories thread unit widget wrapper wrap".split())
BEFORE = frozenset("article blog bottom global left main mobile page post primary reader right secondary site sticky top user".split())
LAST = frozenset("ad ads banner breadcrumbs comments footer header menu nav navbar navigation sidebar".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

#: What is known of a line: it lies in an article, in the main element, in something named as no main text, or in a form.
ARTICLE, MAIN, NOT_MAIN, IN_FORM = 1, 2, 4, 8

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|_+")
_NUMBER = re.compile(r"-*[0-9]+$")
_SPACE = re.compile(r"\s+")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _is_marked(name: str, words: frozenset[str]) -> bool:
    name = _NUMBER.sub("", _HUMP.sub("-", name).lower())
    if name in words:
        return True
    first, *rest = name.split("-")
    if not rest:
        return False
    return (first in FIRST and all(x in THEN for x in rest)) or (rest[-1] in LAST and all(x in BEFORE for x in (first, *rest[:-1])))


def _judge(tag: str, own: dict[str, str], in_article: bool) -> tuple[bool, bool]:
    """Whether an element's text is never shown, and whether it is named as no main text."""
    if tag in DROPPED or "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
        return True, False
    if tag in NAMED or (tag == "header" and not in_article):
        return False, True
    if tag in ("html", "body") or not own:
        return False, False
    words = MARKED_ARTICLE if tag in ("article", "main", "section") else MARKED
    names = own.get("class", "").split() + own.get("id", "").split()
    return False, own.get("role", "").lower() in ROLES or any(_is_marked(n, words) for n in names)


def _region(tag: str, own: dict[str, str]) -> int:
    role = own.get("role", "").lower()
    if tag == "article" or role == "article" or own.get("itemprop", "").lower() == "articlebody":
        return ARTICLE
    return MAIN if tag == "main" or role == "main" else 0


def page_lines(page: str | None) -> tuple[list[str], list[int]]:
    """All lines that a page shows, and what is known of each."""
    return page_shapes(page)[:2]


def page_shapes(page: str | None) -> tuple[list[str], list[int], list[str | None]]:
    """The same, and by what a line is aligned instead of its text: the names of the blocks around it, if it is all links."""
    lines: list[str] = []
    shapes: list[str | None] = []
    known: list[tuple[int, int]] = []  # what is known of each line, and the form that it lies in
    stack: list[tuple[str, bool, int, int]] = []  # name, never shown, what is known, form
    opened: Counter[str] = Counter()
    texts: list[str] = []
    linked = unlinked = False  # whether the line so far has text inside links, and outside
    page, at, n_forms, wrappers = page or "", 0, 0, set()
    dropped, flags, form = False, 0, 0

    def flush() -> None:
        nonlocal linked, unlinked
        line = _SPACE.sub(" ", html.unescape("".join(texts))).strip()
        texts.clear()
        if line:
            lines.append(line)
            known.append((flags, form))
            shapes.append("\0" + ">".join(x[0] for x in stack if x[0] in BLOCKS) if linked and not unlinked else None)
        linked = unlinked = False

    def cut(depth: int) -> None:
        nonlocal dropped, flags, form
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]
        _, dropped, flags, form = stack[-1] if stack else ("", False, 0, 0)

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not dropped and (text := page[at : m.start() if m else len(page)]):
            texts.append(text)
            if not text.isspace():
                linked, unlinked = linked or opened["a"] > 0, unlinked or opened["a"] <= 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag: of the innermost open element of that name, if any is open
            if opened[tag] > 0:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                if any(x[0] in BLOCKS for x in stack[depth:]):
                    flush()
                cut(depth)
            continue
        attributes = m[3] or m[6] or ""
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            texts.append(" ")
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        if any(opened[x] > 0 for x in ends):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    cut(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if not dropped and tag not in DROPPED:
                texts.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        own = _attributes(attributes) if "=" in attributes or "hidden" in attributes.lower() else {}
        never, named = _judge(tag, own, bool(flags & ARTICLE))
        region = _region(tag, own)
        if region or tag == "h1":
            wrappers.add(form)
        if tag == "form":
            n_forms += 1
        inner = (tag, dropped or never, flags | region | (NOT_MAIN if named else 0), n_forms if tag == "form" else form)
        stack.append(inner)
        opened[tag] += 1
        _, dropped, flags, form = inner
    flush()
    if not wrappers - {0} and all(f or k & NOT_MAIN for k, f in known):  # nothing outside of forms: the page is in one
        wrappers.update(f for _, f in known)
    return lines, [k | (IN_FORM if f and f not in wrappers else 0) for k, f in known], shapes


def aligned_by(lines: list[str], shapes: list[str | None]) -> list[str]:
    return [line if shape is None else shape for line, shape in zip(lines, shapes)]


# -- alignment --------------------------------------------------------------------------------------------------


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Indices of ``a`` in a longest common subsequence with ``b``.

    Equal ends are cut off first and lines without a partner left out. The rest is aligned by bit-parallel rows,
    of which about the square root are kept and the others made again on the way back.
    """
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < most - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(start), *range(len(a) - tail, len(a))}
    inner_a, inner_b = range(start, len(a) - tail), b[start : len(b) - tail]
    both = {a[i] for i in inner_a} & set(inner_b)
    if not both:
        return found
    at = [i for i in inner_a if a[i] in both]
    right = [x for x in inner_b if x in both]
    masks: dict[str, int] = {}
    for j, x in enumerate(right):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(right)) - 1

    def next_row(row: int, x: str) -> int:
        hit = row & masks[x]
        return (row + hit | row - hit) & full

    step = isqrt(len(at)) + 1
    row, marks = full, []
    for i, k in enumerate(at):
        if i % step == 0:
            marks.append(row)
        row = next_row(row, a[k])
    j = len(right)
    for block in range(len(marks) - 1, -1, -1):
        part = at[block * step : (block + 1) * step]
        rows = [marks[block]]
        for k in part:
            rows.append(next_row(rows[-1], a[k]))
        for i in range(len(part), 0, -1):
            # A zero bit below j is a step of the length; the row above lacks it just if this line makes it.
            while j and rows[i] >> (j - 1) & 1:
                j -= 1
            if not j:
                return found
            if rows[i - 1] >> (j - 1) & 1:
                if right[j - 1] == a[part[i - 1]]:
                    found.add(part[i - 1])
                j -= 1
    return found


def shared_lines(lines: list[str], known: list[int], neighbours: list[list[str]], own: list[str] | None = None) -> set[int]:
    """Places of the lines that a page shares with all of its neighbours that are no copies of it; articles' lines are no such lines.

    ``own`` and the neighbours' lists are what lines are aligned by (``aligned_by``), the lines themselves if it is not given.
    """
    plain = [not k & (NOT_MAIN | IN_FORM) for k in known]
    size = sum(len(x) for x, is_plain in zip(lines, plain) if is_plain)
    found: set[int] | None = None
    for other in neighbours:
        both = common_lines(own or lines, other)
        if sum(len(lines[i]) for i in both if plain[i]) > COPY * size:
            continue
        found = both if found is None else found & both
    return {i for i in found or () if not known[i] & ARTICLE}


def main_text(lines: list[str], known: list[int], neighbours: list[list[str]], own: list[str] | None = None) -> tuple[str, int]:
    """The text that stays, given the lines of the neighbours, nearest first, and how many lines differencing has deleted."""
    shared = shared_lines(lines, known, neighbours, own)
    left = [i for i in range(len(lines)) if i not in shared and not known[i] & (NOT_MAIN | IN_FORM)]
    for region in (MAIN, ARTICLE):
        inner = [i for i in left if known[i] & region]
        if 3 * sum(len(lines[i]) for i in inner) >= sum(len(lines[i]) for i in left):
            left = inner or left
    return "\n".join(lines[i] for i in left), len(shared)


# -- distribution -----------------------------------------------------------------------------------------------

_ROW = "part int, host string, path string, key long, page_id long, url string, context boolean, lines array<string>, known array<int>, shapes array<string>"
_ENDS = "part int, low struct<host: string, path: string, key: long>, high struct<host: string, path: string, key: long>"
_OUT = "page_id long, url string, text string, n_chars long, n_shared long"
_KEY = pa.struct([("host", pa.string()), ("path", pa.string()), ("key", pa.int64())])


def _ends(batches: Iterator[pa.RecordBatch], cuts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The smallest and the largest key of each range among a task's rows."""
    found: dict[int, list[tuple]] = {}
    for batch in batches:
        for own in zip(*(c.to_pylist() for c in batch.columns)):
            ends = found.setdefault(bisect.bisect_right(cuts, own), [own, own])
            ends[0], ends[1] = min(ends[0], own), max(ends[1], own)
    named = lambda k: pa.array([dict(zip(("host", "path", "key"), e[k])) for e in found.values()], _KEY)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), named(0), named(1)], names=["part", "low", "high"])


def _parse(batches: Iterator[pa.RecordBatch], cuts: list[tuple], before: dict[tuple, int], after: dict[tuple, int]) -> Iterator[pa.RecordBatch]:
    """Reads the pages and deals them to ranges; a range's first and last page go to the range beside it too."""
    names = [f.split(" ")[0] for f in _ROW.split(", ")]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string())]
    schema = pa.schema(list(zip(names, kinds)))
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            rows = []
            for host, path, key, page_id, url, page in zip(*(c.to_pylist() for c in batch.slice(start, 500).columns)):
                own = (host, path, key)
                lines, known, shapes = page_shapes(page)
                row = (host, path, key, page_id, url)
                rows.append((bisect.bisect_right(cuts, own), *row, False, lines, known, shapes))
                rows += [(to, *row, True, lines, [], shapes) for to in (before.get(own), after.get(own)) if to is not None]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], schema=schema)


def _shared_path(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted rows, of which three at a time are held."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_shared", pa.int64())])
    rows = (r for batch in batches for start in range(0, batch.num_rows, 500) for r in zip(*(c.to_pylist() for c in batch.slice(start, 500).columns)))
    out, size = [], 0
    for _, group in groupby(rows, key=lambda r: r[:2]):
        before, now = None, next(group)
        while now:
            after = next(group, None)
            _, _, path, _, page_id, url, context, lines, known, shapes = now
            if not context:
                near = sorted((n for n in (before, after) if n), key=lambda n: -_shared_path(path, n[2]))
                text, n_shared = main_text(lines, known, [aligned_by(n[7], n[9]) for n in near], aligned_by(lines, shapes))
                out.append((page_id, url, text, len(text), n_shared))
                size += len(text)
                if len(out) >= 1_000 or size >= 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
            before, now = now, after
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", range_pages: int = RANGE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars and n_shared (lines that differencing has deleted) of every page."""
    url = F.col(url_col)
    keyed = pages.select(
        url_host(url).alias("host"), url_path(url).alias("path"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"), F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.col(html_col).alias("html")
    )
    keys = keyed.select("host", "path", "key")
    total = keys.count()
    ranges = max(1, min(MAX_RANGES, -(-total // range_pages)))
    cuts: list[tuple] = []
    if ranges > 1:
        share = min(1.0, SAMPLE * ranges / total)
        some = keys.where(F.pmod(F.xxhash64(F.lit("cut"), "host", "path", "key"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
        # A hash picks about so many; a limit on top holds even if it should pick far more.
        sampled = sorted(tuple(r) for r in some.limit(2 * SAMPLE * MAX_RANGES).collect())
        cuts = sampled[SAMPLE - 1 :: SAMPLE]
    ends = keys.mapInArrow(lambda b: _ends(b, cuts), _ENDS).groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    ends = sorted((e["part"], tuple(e["low"]), tuple(e["high"])) for e in ends)
    # Where the first page of a range is wanted as what follows the range before, and the last one as what precedes the next.
    before = {low: ends[k - 1][0] for k, (_, low, _) in enumerate(ends) if k}
    after = {high: ends[k + 1][0] for k, (_, _, high) in enumerate(ends[:-1])}
    dealt = keyed.mapInArrow(lambda b: _parse(b, cuts, before, after), _ROW).repartition(max(1, len(ends)), "part")
    return dealt.sortWithinPartitions("part", "host", "path", "key").mapInArrow(_difference, _OUT)
