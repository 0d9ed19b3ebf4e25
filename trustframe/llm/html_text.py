"""Main text of web pages by differencing against the nearest page of the host.

A page is cut into lines, one per block element, in page order. Lines inside
elements that are never part of an article (navigation, footers, forms, adverts,
notices, comments, ...) are left out; a class or id tells boilerplate only as a whole
known name, not on a heading, and not on an element that is or contains the
article. Where the page marks its article (``article``, ``main`` or a block named
like one), the lines inside the marks that hold the most text are the
text, without the template at their ends (see below). The other lines are judged against the page whose URL is
nearest: pages of a host are ordered by path, and of the two neighbours the one
with the longer common path is taken. The two pages' lines are aligned by
their longest common subsequence, and shared lines are deleted: a template repeats,
an article does not. Where the other neighbour lies in the same directory, a line
goes only if it is shared with it too, so two neighbouring copies of an article keep it. On a page without a marked article, what is left is the text.
Inside a marked article, lines are deleted where they are shared with both neighbours of one directory and make up its
first or last lines, which is where a template puts its boxes, unless those hold half of its text: a line
amid an article, copies of an article, and license lines that two articles share, stay.

Order and neighbours are found on narrow rows (line hashes): these are sorted by
ranges over the whole table, so a host with a third of all pages is spread over
tasks, and the rows at the ranges' edges are passed on, so each page has its
true neighbours whatever the ranges. The pages then meet the numbers of
their deleted lines in one join.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names, local_ranks
from trustframe.session import cut_lineage

# ---- lines of a page --------------------------------------------------------

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|[^<]+|<""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {"script", "style", "textarea", "title", "xmp", "noscript", "iframe", "noframes", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
           "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr"}
_SKIP = {"nav", "aside", "form", "button", "select", "head", "footer", "menu", "svg", "canvas", "object", "audio", "video", "dialog", "math"}
#: class and id words of boilerplate and of articles
_BAD = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbox", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies",
        "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "sidebar", "menu", "navbar", "nav", "navigation",
        "breadcrumb", "breadcrumbs", "share", "sharing", "social", "comment", "comments", "disqus", "related", "recommended", "newsletter",
        "subscribe", "subscription", "signup", "login", "footer", "masthead", "topbar", "toolbar", "widget", "pagination", "pager", "skip",
        "disclaimer", "copyright", "toc", "tags", "commentlist", "commentform", "responses", "adsbygoogle", "googlead", "cookiebanner", "cookiebar",
        "cookieconsent"}
#: words that a name of boilerplate may hold besides; any other word ("no-sidebar", "social-history") makes it another name
_BESIDE = {"site", "page", "global", "main", "top", "bottom", "left", "right", "primary", "secondary", "inner", "outer", "box", "bar", "block", "area",
           "section", "container", "wrap", "wrapper", "list", "item", "items", "link", "links", "button", "buttons", "icon", "icons", "form", "unit",
           "slot", "text", "message", "post", "posts", "entry", "article", "articles", "stories", "google", "zone", "native", "reading", "reads", "cta", "wp",
           "header", "title"}
#: in a class, these words make the whole name boilerplate whatever stands beside them, but for the words below
_STRONG = {"comment", "comments", "commentlist", "disqus", "cookie", "cookies", "gdpr", "newsletter", "sidebar"}
_UNLESS = {"no", "not", "non", "has", "have", "with", "without", "is", "hide", "hidden", "show", "open", "content", "main", "article", "body", "post", "entry",
           "story", "layout", "grid", "col", "cols", "column", "columns", "template", "theme", "hljs", "token", "recipe", "recipes"}
#: whole names
_NAMES = {"sponsored-content", "promoted-content", "author-box", "author-bio", "about-author", "about-the-author"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_GOOD = {"article", "articlebody", "post", "entry", "story", "content", "maincontent", "body-text"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert", "form"}
_CLOSES_P = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "header", "footer", "nav",
             "aside", "form", "pre", "blockquote", "main", "dl", "figure", "hr", "address", "fieldset"}


def _boilerplate(name: str, is_class: bool = False) -> bool:
    """Whether a class or id is boilerplate as a whole: made of such words, and words that may stand beside them
    (numbers and sizes count for nothing). An id names a topic as often as a part of the page, so the strong
    words decide classes only."""
    if name in _NAMES:
        return True
    parts = [x for x in re.split(r"[^a-z0-9]+", name) if x and not re.fullmatch(r"\d+(x\d+)?", x)]
    if is_class and any(x in _STRONG for x in parts) and not any(x in _UNLESS for x in parts):
        return True
    return any(x in _BAD for x in parts) and all(x in _BAD or x in _BESIDE for x in parts)


def _kind(tag: str, attrs: str) -> tuple[bool, bool, int]:
    """(left out, named boilerplate, kind of mark: 1 article, 2 main, 4 a block named like an article, 0 none)."""
    good = 1 if tag == "article" else 2 if tag == "main" else 0
    if not attrs or attrs.isspace():
        return False, False, good
    a = {m[0].lower(): (m[1] or m[2] or m[3]).lower() for m in _ATTR.findall(attrs)}
    words = set(re.split(r"[^a-z0-9]+", a.get("class", "") + " " + a.get("id", "")))
    classes, ids = a.get("class", "").split(), a.get("id", "").split()
    whole = {*classes, *ids}
    if (a.get("role") in _ROLES or "hidden" in a or a.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""))):
        return True, False, 0
    if not good and a.get("role") in ("main", "article"):
        good = 2 if a["role"] == "main" else 1
    if not good and (a.get("itemprop") == "articlebody" or tag in ("div", "section", "td") and
                     (whole & _GOOD or {"article", "body"} <= words or {"main", "content"} <= words or {"post", "content"} <= words
                      or {"entry", "content"} <= words or {"article", "content"} <= words)):
        good = 4
    if tag in ("body", "html", "main") or tag in _HEADINGS or not (words & _BAD or whole & _NAMES):
        return False, False, good
    if tag in _INLINE:  # "comment" on inline text is a colour of source code
        classes = [x for x in classes if x not in ("comment", "comments")]
    return False, any(_boilerplate(x, True) for x in classes) or any(map(_boilerplate, ids)), good


def page_lines(page: str) -> list[tuple[str, int]]:
    """(text, marks it is in) of each block outside the elements left out. White space
    in a block is one space. The marks are 1 or 2, the outermost of article and
    main, plus 4 in a block named like an article.

    An element named as boilerplate is not left out if one mark in it (or itself)
    holds over half of the page's text: that is the article, whereas comments or teasers
    may be marked too, but each is short."""
    lines, now = [], []
    # tag, left out, marks, named elements it is in, (named element, first mark in it)
    stack: list[tuple[str, bool, int, tuple, tuple]] = []
    held: dict[str, int] = {}
    skip, mark, named, first = top = (False, 0, (), ())
    at, n = 0, len(page)

    def flush():
        if now:
            t = " ".join("".join(now).split())
            if t:
                lines.append((t, mark, named, first))
            now.clear()

    def close(tag: str):
        nonlocal skip, mark, named, first
        while stack:
            t = stack.pop()[0]
            held[t] -= 1
            if t == tag:
                break
        skip, mark, named, first = stack[-1][1:] if stack else top

    match = _TOKEN.match
    while at < n:
        m = match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            t = m[0]
            if t[0] != "<":
                if not skip:
                    now.append(_html.unescape(t) if "&" in t else t)
            elif t == "<":
                rest = page[at:at + 1]
                if rest.isalpha() or rest in ("/", "!", "?"):
                    if ">" not in page[at:]:  # a tag that the page's end cuts off
                        break
                    at = page.index(">", at) + 1
                elif not skip:
                    now.append(t)
            continue
        tag = tag.lower()
        if tag == "br":
            now.append(" ")
            continue
        block = tag not in _INLINE
        if block:
            flush()
        if m[1]:
            if held.get(tag):
                close(tag)
            continue
        if tag in _VOID:
            continue
        if tag in _RAW:
            if m[0].endswith("/>"):
                continue
            e = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = e.end() if e else n
            continue
        if m[0].endswith("/>") and block is False:
            continue
        if tag in _CLOSES_P and held.get("p"):
            # a block ends an open paragraph, unless something it is inside began after it
            inner = []
            for x in reversed(stack):
                inner.append(x[0])
                if x[0] == "p" or x[0] not in _INLINE:
                    break
            if inner and inner[-1] == "p":
                close("p")
        elif tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
            close(tag)
        out, bad, good = _kind(tag, m[3])
        # a header of the page is left out; an article's own header holds its title
        out = out or tag in _SKIP or tag == "header" and not mark
        inside = (*named, m.start()) if bad else named
        if good and inside:
            have = {x for x, _ in first}
            first = (*first, *((x, m.start()) for x in inside if x not in have))
        stack.append((tag, skip or out, mark if mark & 3 and good in (1, 2) else mark | good, inside, first))
        held[tag] = held.get(tag, 0) + 1
        skip, mark, named, first = stack[-1][1:]
    flush()
    holds: dict[tuple[int, int], int] = {}
    for t, _, _, pairs in lines:
        for x in pairs:
            holds[x] = holds.get(x, 0) + len(t)
    total = sum(len(x[0]) for x in lines)
    free = {x for (x, _), k in holds.items() if 2 * k > total}
    return [(t, k) for t, k, ins, _ in lines if free.issuperset(ins)]


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


# ---- alignment ----------------------------------------------------------------

#: table cells up to which the alignment is read off one table
CELLS = 4_000_000


def _prefix_lcs(x: list[int], y: list[int]) -> np.ndarray:
    """LCS lengths of x with each prefix of y, by bit vectors of y's length."""
    n = len(y)
    at: dict[int, list[int]] = {}
    for j, v in enumerate(y):
        at.setdefault(v, []).append(j)

    def mask(js: list[int]) -> int:
        if len(js) == 1:
            return 1 << js[0]
        b = np.zeros(n, np.uint8)
        b[js] = 1
        return int.from_bytes(np.packbits(b, bitorder="little").tobytes(), "little")
    often = {v: mask(js) for v, js in at.items() if len(js) >= 64}
    full = (1 << n) - 1
    bits = full
    for v in x:
        if v in at:
            u = bits & (often[v] if v in often else mask(at[v]))
            bits = (bits + u | bits - u) & full
    steps = np.unpackbits(np.frombuffer(bits.to_bytes(n // 8 + 1, "little"), np.uint8), count=n, bitorder="little")
    return np.r_[0, np.cumsum(1 - steps.astype(np.int64))]


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which lines of ``a`` are in the longest common subsequence with ``b``. Common
    ends first; then by dynamic programming; where that table would pass ``CELLS``,
    ``a`` is halved and ``b`` cut where the halves' subsequences are longest
    together (Hirschberg), so memory stays linear and the length exact."""
    got = np.zeros(len(a), bool)
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    got[:head] = True
    x, y = a[head:], b[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    if tail:
        got[len(a) - tail:] = True
        x, y = x[:len(x) - tail], y[:len(y) - tail]
    # lines of one side only cannot be shared
    keep = np.flatnonzero(np.isin(x, y))
    x, y = x[keep], y[np.isin(y, x)]
    if not len(x):
        return got
    if len(x) == 1:
        got[head + keep] = True
        return got
    if len(x) * len(y) <= CELLS:
        t = np.zeros((len(x) + 1, len(y) + 1), np.int32)
        for i in range(len(x)):
            row = np.maximum(t[i, 1:], np.where(y == x[i], t[i, :-1] + 1, 0))
            t[i + 1, 1:] = np.maximum.accumulate(row)
        i, j = len(x), len(y)
        while i and j:
            if x[i - 1] == y[j - 1] and t[i, j] == t[i - 1, j - 1] + 1:
                got[head + keep[i - 1]] = True
                i, j = i - 1, j - 1
            elif t[i - 1, j] >= t[i, j - 1]:
                i -= 1
            else:
                j -= 1
        return got
    half = len(x) // 2
    cut = int(np.argmax(_prefix_lcs(x[:half].tolist(), y.tolist()) + _prefix_lcs(x[half:][::-1].tolist(), y[::-1].tolist())[::-1]))
    got[head + keep[:half]] = shared_lines(x[:half], y[:cut])
    got[head + keep[half:]] = shared_lines(x[half:], y[cut:])
    return got


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


# ---- the operator ---------------------------------------------------------------

def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def _directory(a: str, b: str) -> str:
    """The directory that holds both paths."""
    return a[:a.rfind("/", 0, _common(a, b)) + 1]


def _used(path: str, sides: list[tuple[str, list[int]]]) -> list[tuple[str, list[int]]]:
    """The nearest of the neighbours (path, lines) of one host, before and after, and the other in the same directory."""
    sides = sorted(sides, key=lambda s: -_common(s[0], path))
    near = {_directory(path, s[0]) for s in sides[:1]}
    return [s for s in sides if _directory(path, s[0]) in near]


def template_lines(path: str, lines: list[int], sides: list[tuple[str, list[int]]]) -> list[int]:
    """Numbers of the lines that the page shares with its neighbours (path, lines) of one host, before and after."""
    if not sides or not lines:
        return []
    at = np.arange(len(lines))
    for _, theirs in _used(path, sides):
        at = at[shared_lines(np.array(lines, np.int64)[at], np.array(theirs, np.int64))]
    return at.tolist()


def _line_rows(pages: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            rows, best = [], []
            for p in b.column("html").to_pylist():
                ls = page_lines(p) if p else []
                rows.append([_hash(t) for t, _ in ls])
                best.append(any(m for _, m in ls))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("host"), b.column("path"), pa.array(rows, pa.list_(pa.int64())),
                                              pa.array(best, pa.bool_())], ["key", "host", "path", "lines", "marked"])
    return pages.mapInArrow(run, "key string, host string, path string, lines array<long>, marked boolean")


def shared_with_nearest(pages: DataFrame) -> DataFrame:
    """(key, shared, both) from (key, host, path, html): numbers of the lines that the page shares
    with the page of its host whose path is nearest (ties: the one before), and with the other
    neighbour where that lies in the same directory (both)."""
    rows = cut_lineage(_line_rows(pages).dropDuplicates(["key"]))
    part, rank = "__part", "__rank"
    ordered = local_ranks(rows.repartitionByRange("host", "path", "key"), [F.col("host"), F.col("path"), F.col("key")], part, rank)
    one = F.struct("host", "path", "lines")
    w = Window.partitionBy(part).orderBy(rank)
    near = ordered.withColumn("before", F.lag(one).over(w)).withColumn("after", F.lead(one).over(w))
    # first and last page of each range, handed to the neighbouring ranges: one row per range
    edge = ordered.groupBy(part).agg(F.min_by(one, rank).alias("first"), F.max_by(one, rank).alias("last"))
    v = Window.orderBy(part)
    edge = cut_lineage(edge.select(F.col(part).alias("p"), F.lag("last").over(v).alias("from_before"), F.lead("first").over(v).alias("from_after")))
    near = near.join(edge, F.col(part) == F.col("p")).select(
        "key", "host", "path", "lines", "marked", F.coalesce("before", "from_before").alias("before"), F.coalesce("after", "from_after").alias("after"))

    def run(batches):
        for b in batches:
            out, both = [], []
            for r in b.to_pylist():
                sides = [(s["path"], s["lines"]) for s in (r["before"], r["after"]) if s is not None and s["host"] == r["host"]]
                out.append(template_lines(r["path"], r["lines"], sides))
                both.append(len(_used(r["path"], sides)) > 1)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.list_(pa.int32())), pa.array(both, pa.bool_())], ["key", "shared", "both"])
    return near.mapInArrow(run, "key string, shared array<int>, both boolean")


def main_text(lines: list[tuple[str, int]], shared: list[int], both: bool = False) -> str:
    """Lines inside ``main`` or inside articles outside it, whichever hold more text
    (all of main, so what it has beside an article stays); with the blocks named like
    an article, if these hold more than that again; without their first and last lines that are
    shared (with ``both`` neighbours), where these hold less than half of the text. Without a mark, all but the shared
    lines (all, if none would be left)."""
    size = [sum(len(t) for t, m in lines if m & 3 == k) for k in range(3)]
    kind = 1 if size[1] > size[2] else 2
    named = sum(len(t) for t, m in lines if m & 4 and m & 3 != kind)
    blocks = named > size[kind]
    left = [i for i, (_, m) in enumerate(lines) if m and (m & 3 == kind or blocks and m & 4)]
    gone = set(shared)
    if left:
        own = [n for n, i in enumerate(left) if not both or i not in gone]
        inner = left[own[0]:own[-1] + 1] if own else []
        if 2 * sum(len(lines[i][0]) for i in inner) > sum(len(lines[i][0]) for i in left):
            left = inner
        return "\n".join(lines[i][0] for i in left)
    left = [t for i, (t, _) in enumerate(lines) if i not in gone]
    return "\n".join(left or [t for t, _ in lines])


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of pages (all by default), text (main text, blocks joined by \\n; empty
    if none) and n_shared (template lines: shared with the nearest
    page, and with the other neighbour in the same directory).

    A null html is an empty page; a page without a usable URL belongs to the host
    "". Rows equal in URL and html are one page for the pairing and get equal
    results. Clashing names get a leading "_"."""
    columns = pages.columns if columns is None else columns
    key, sh, two, text, n_shared = free_names(pages, "__key", "__shared", "__both", "text", "n_shared")
    url, page = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    own = F.md5(F.concat(F.length(F.coalesce(url, F.lit(""))).cast("string"), F.lit(":"), F.coalesce(url, F.lit("")),
                         F.coalesce(page, F.lit(""))).cast("binary"))
    narrow = pages.select(own.alias("key"), _host(url).alias("host"), _path(url).alias("path"), page.alias("html"))
    shared = shared_with_nearest(narrow).select(F.col("key").alias(key), F.col("shared").alias(sh), F.col("both").alias(two))
    left = pages.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, html_col])], own.alias(key))
    joined = left.join(shared, key, "left").drop(key)
    schema = pages.select(*[F.col(f"`{c}`") for c in columns]).schema.add(text, "string").add(n_shared, "integer")

    def run(batches):
        for b in batches:
            texts, ns = [], []
            for p, s, both in zip(b.column(html_col).to_pylist(), b.column(sh).to_pylist(), b.column(two).to_pylist()):
                texts.append(main_text(page_lines(p) if p else [], s or [], bool(both)))
                ns.append(len(s or []))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(texts, pa.string()), pa.array(ns, pa.int32())],
                                             [*columns, text, n_shared])
    return joined.mapInArrow(run, schema)
