"""Main text of web pages: reading of the markup, and differencing against the nearest URL.

A page becomes lines: one per block element, white space folded, character references
decoded; scripts, styles and form controls are no lines. Every page is paired with the page of
the same host whose path is nearest (the neighbour in path order that shares the longer
beginning), the lines of both are aligned by longest common subsequence, and shared lines are
deleted as the site's frame. A neighbour that shares every line that may be text is a copy of the
page and says nothing about those; they stay.

A check against the markup follows, since articles of a site share lines and its adverts change.
Markup that states its role (menus, footers, side bars, forms, notices, adverts and comments)
deletes lines that differencing left, and where a page marks its article (``article``, ``main``,
role main), its lines are restored and those outside go. An element that is only named like a
part of the frame (``main-banner-free``) gives way to an article inside it if the page has no
other. ``n_frame``, ``n_restored`` and ``n_marked`` count the lines that differencing deleted
for good, those that the check restored and those that only the check deleted.

Paths are compared without query, fragment, closing slash and ending; pages with one path are
one page for the pairing. Neighbours come from a range-partitioned sort, so a host of any
size is spread over many tasks. Line hashes are shuffled, and the text that may stay once, with
the decisions; pages are read a second time for that, which writes less than keeping it.

Edge cases: null html or url count as empty (pages without a host are one host); pages alone
in their host lose only what the markup tells; a page cut off in the middle of markup loses the
unfinished tag only, and one that leaves a button, list or text field open loses it up to the
next block; rows that repeat get the same text; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cupola.session import materialise

#: Elements whose whole content is never text.
SILENT = "script|style|noscript|template|svg|iframe|object|title|canvas|audio|video|annotation"
#: Elements of forms, silent too, that pages leave open; they end at the next block then.
CONTROLS = {"button", "select", "textarea"}
#: Elements without content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are no part of the main text, and roles that say the same.
FRAME = {"nav", "footer", "aside", "form", "menu", "dialog"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
#: Words of class or id that mark menus, notices, adverts and the like.
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "toolbar",
    "footer", "sidebar", "widget", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay",
    "share", "sharing", "social",
    "newsletter", "subscribe", "subscription", "signup", "login", "search", "masthead", "copyright", "skip",
}
#: Words that mark reader comments; an article of that name is a comment too.
COMMENTS = {"comment", "comments", "disqus", "respond", "replies"}
#: Words that mark lists of other articles, alone or beside a word of such a list.
OTHERS, LISTS = {"related", "recommended"}, {"articles", "box", "content", "items", "links", "list", "news", "pages", "posts", "products", "reading", "stories", "topics", "videos"}
#: Words of a class that says something about the page: ``has-sidebar``, ``comments-open``.
ABOUT = {"has", "no", "with", "without", "free", "open", "closed", "enabled", "disabled"}
CONTENT = {"article", "main"}
BLOCKS = {
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot",
    "tr", "td", "th", "caption", "section", "article", "main", "header", "blockquote", "pre", "figure", "figcaption",
    "address", "details", "summary", "fieldset", "hr", "head", "body", "html", "center", "hgroup",
} | FRAME
#: Elements that may be left open and hold no others of the frame.
LOOSE = {"p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "hr", "br", "head", "body", "html", "h1", "h2", "h3", "h4", "h5", "h6", "caption"}

_REST = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<svg\b{_REST}/>"
    rf"|<({SILENT})\b[^>]*>.*?(?:</\1[^>]*>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9]*)({_REST})>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-zA-Z]+")
_CONTROL = {t: re.compile(rf"<(/?){t}\b[^>]*>", re.I) for t in CONTROLS}
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})\b", re.I)

#: What hides an element: nothing, a name that an article inside it outweighs, or for good.
SHOWN, NAMED, HIDDEN = 0, 1, 2


def named(value: str, content: bool) -> int:
    """What the names in a class or id hide; of an article only those of comments count."""
    found = SHOWN
    for name in value.split():
        words = {w.lower() for w in _WORD.findall(name)}
        if words & ABOUT:
            continue
        if words & COMMENTS:
            return HIDDEN
        if content:
            continue
        if words & OTHERS and (len(words) == 1 or words & LISTS):
            return HIDDEN
        if words & NAMES:
            found = NAMED
    return found


def hides(tag: str, attrs: str, in_content: bool) -> int:
    if tag in FRAME or (tag == "header" and not in_content):
        return HIDDEN
    found = SHOWN
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NONE.search(value):
            return HIDDEN
        if tag == "body":
            continue
        if name == "role" and tag not in CONTENT and ROLES.intersection(value.lower().split()):
            return HIDDEN
        if name in ("class", "id"):
            found = max(found, named(value, tag in CONTENT))
    return HIDDEN if found and in_content else found


def lines(page: str | None) -> list[tuple[str, int]]:
    """``(line, mark)`` of the blocks, in page order: 2 inside an article, 1 inside an article in
    an element that is named like a part of the frame, -1 in the frame, else 0."""
    page = page or ""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool, int]] = []  # tag, what it hides, is content, names around the content
    hidden = around = content = behind = 0
    held: list[str] = []
    frame: list[str] = []
    at = 0

    def close():
        for part, mark in ((held, (1 if behind else 2) if content else 0), (frame, -1)):
            if part:
                line = " ".join(html.unescape("".join(part)).split())
                part.clear()
                if line:
                    out.append((line, mark))

    def push(tag, own, is_content):
        nonlocal hidden, around, content, behind
        stack.append((tag, own, is_content, around if is_content else 0))
        hidden += own == HIDDEN
        around += own == NAMED
        content += is_content
        if is_content:
            behind += around > 0
            around = 0

    def pop():
        nonlocal hidden, around, content, behind
        tag, own, is_content, names = stack.pop()
        hidden -= own == HIDDEN
        around -= own == NAMED
        content -= is_content
        if is_content:
            behind -= names > 0
            around = names
        return tag

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue  # inside a control
        if m.start() > at:
            (frame if hidden or around else held).append(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            frame.append(" ")
        elif tag in CONTROLS:
            if not m[2]:
                end = _CONTROL[tag].search(page, at)
                if end and end[1]:
                    at = end.end()
                else:  # left open
                    end = _BLOCK.search(page, at)
                    at = end.start() if end else len(page)
        elif tag not in BLOCKS:
            if tag in VOID:
                continue
            if m[2]:
                if stack and stack[-1][0] == tag:
                    pop()
            elif not m[4].endswith("/"):
                own = hides(tag, m[4], content > 0) if m[4] else SHOWN
                if own or stack and stack[-1][0] == tag:  # an equal one inside it
                    push(tag, own, False)
        else:
            close()
            if not m[2]:
                if tag in VOID or tag in LOOSE and not m[4] or m[4].endswith("/"):
                    continue
                own = hides(tag, m[4], content > 0)
                if tag in LOOSE and not own:
                    continue
                role = re.search(r"""\brole\s*=\s*["']?main\b""", m[4], re.I) if "role" in m[4] else None
                push(tag, own, own != HIDDEN and (tag in CONTENT or role is not None))
            elif any(s[0] == tag for s in stack):
                while pop() != tag:
                    pass
    if at < len(page):
        (frame if hidden or around else held).append(page[at:])
    close()
    return out


def choose(found: list[tuple[str, int]]) -> tuple[list[int], bool]:
    """Places of the lines that may be text, and whether no markup says that they are."""
    mark = max((c for _, c in found), default=-1)
    return [i for i, (_, c) in enumerate(found) if c == mark >= 0], mark == 0


def read(page: str | None) -> tuple[list[str], bool]:
    found = lines(page)
    body, is_open = choose(found)
    return [found[i][0] for i in body], is_open


def shared(a: list[int], b: list[int]) -> set[int]:
    """Places of ``a`` on a longest common subsequence of ``a`` and ``b``."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    ends: list[int] = []  # smallest end in b of a common subsequence of each length
    last: list[tuple | None] = []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(ends, j)
            link = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(link)
            elif ends[k] != j:
                ends[k], last[k] = j, link
    out: set[int] = set()
    link = last[-1] if last else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _hash(line: str) -> int:
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(line), "little", signed=True)


def line_table(src: DataFrame) -> DataFrame:
    """Rows ``(row, host, path, open, body, lines)``: hashes of all lines of each page, and the
    places of those that may be text."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                got = [lines(h) for h in part.column(3).to_pylist()]
                body, is_open = zip(*map(choose, got))
                cols = [pa.array(is_open, pa.bool_()), pa.array(body, pa.list_(pa.int32())), pa.array([[_hash(t) for t, _ in l] for l in got], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *cols], ["row", "host", "path", "open", "body", "lines"])

    return src.select("row", "host", "path", "html").mapInArrow(run, "row long, host string, path string, open boolean, body array<int>, lines array<long>")


def body_table(src: DataFrame) -> DataFrame:
    """Rows ``(id, url, row, kept)``: the lines that may be text."""
    import pyarrow as pa

    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                kept = [read(h)[0] for h in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(kept, pa.list_(pa.string()))], ["id", "url", "row", "kept"])

    return src.select("id", "url", "row", "html").mapInArrow(run, f"id {kind}, url string, row long, kept array<string>")


def neighbours(table: DataFrame) -> DataFrame:
    """Rows ``(host, path, near)``: the lines of the nearest page, null for a page alone in its host."""
    import pyarrow as pa

    one = table.groupBy("host", "path").agg(F.min_by("lines", "row").alias("lines"))
    ranged = materialise(one.repartitionByRange("host", "path").withColumn("pid", F.spark_partition_id()))
    me = F.struct("host", "path", "lines")
    ends = ranged.groupBy("pid").agg(F.min_by(me, F.struct("host", "path")).alias("head"), F.max_by(me, F.struct("host", "path")).alias("tail"))
    by_pid = Window.orderBy("pid")  # one row per range partition
    edges = ends.select("pid", F.lag("tail").over(by_pid).alias("tail"), F.lead("head").over(by_pid).alias("head"))
    order = Window.partitionBy("pid").orderBy("host", "path")

    def if_same_host(c):
        return F.when(c["host"] == F.col("host"), F.struct(c["path"].alias("path"), c["lines"].alias("lines")))

    both = (
        ranged.withColumn("b", F.lag(me).over(order))
        .withColumn("a", F.lead(me).over(order))
        .join(F.broadcast(edges), "pid")
        .select("host", "path", if_same_host(F.coalesce("b", "tail")).alias("before"), if_same_host(F.coalesce("a", "head")).alias("after"))
    )

    def nearer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for path, before, after in zip(*[batch.column(c).to_pylist() for c in range(1, 4)]):
                best = max((x for x in (before, after) if x), key=lambda x: _common(path, x["path"]), default=None)
                near.append(best and best["lines"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(near, pa.list_(pa.int64()))], ["host", "path", "near"])

    return both.mapInArrow(nearer, "host string, path string, near array<long>")


def difference(mine: list[int], near: list[int] | None, body: list[int], is_open: bool) -> tuple[list[int], int, int, int]:
    """What the nearest page and the check against the markup delete of a page: places in ``body``
    of its lines that go, and ``n_frame``, ``n_restored``, ``n_marked``."""
    same = shared(mine, near) if near else set()
    if same.issuperset(body):
        same.difference_update(body)  # a copy of the page
    gone = [i for i, at in enumerate(body) if at in same]
    n_marked = len(mine) - len(body) - len(same) + len(gone)
    return (gone, len(same), 0, n_marked) if is_open else ([], len(same) - len(gone), len(gone), n_marked)


def frame_lines(table: DataFrame) -> DataFrame:
    """Rows ``(row, gone, n_frame, n_restored, n_marked)``: every page against its nearest page."""
    import pyarrow as pa

    rows = table.join(neighbours(table), ["host", "path"]).select("row", "lines", "near", "body", "open")
    counts = ["n_frame", "n_restored", "n_marked"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                gone, *n = zip(*[difference(*x) for x in zip(*[part.column(c).to_pylist() for c in range(1, 5)])])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(gone, pa.list_(pa.int32())), *[pa.array(c, pa.int32()) for c in n]], ["row", "gone", *counts])

    return rows.mapInArrow(run, f"row long, gone array<int>, {', '.join(f'{c} int' for c in counts)}")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``(id, url, text, n_frame, n_restored, n_marked)``, one per row of ``pages``; blocks are joined by one line feed."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    where = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"
    src = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.lower(F.regexp_extract(url, where, 1)).alias("host"),
        F.regexp_replace(F.regexp_extract(url, where, 2), r"(/|\.[A-Za-z]{3,5}|/index\.[A-Za-z]{3,5})$", "").alias("path"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).withColumn("row", F.xxhash64("id", "url", "html"))
    decided = frame_lines(materialise(line_table(src))).dropDuplicates(["row"])
    left = F.filter("kept", lambda t, i: ~F.array_contains(F.col("gone"), i))
    got = body_table(src).join(decided, "row").select("id", "url", F.array_join(left, "\n").alias("text"), "n_frame", "n_restored", "n_marked")
    return got.withColumnsRenamed({"id": id_col, "url": url_col})
