"""HTML extraction by nearest-URL page differencing.

A page becomes text lines, one per block, each with a role: *main* (inside an
article or main element), *furniture* (inside an element that by tag, class or
role is a menu, header, footer, sidebar, notice, advert, form or comment list)
or *open* (anywhere else).  A class or id name marks an element only as a whole
(``ad-box``, not ``has-sidebar``); with a mark among other words its lines are
open.  Names never mark an article or main element, nor a wrapper that would
take the page's only one.  Pages of a host are ordered by URL path, and each
is paired with the neighbour that shares more leading path segments (the one
before it on a tie).  The lines of the two pages are aligned by longest common
subsequence, and the shared ones are deleted: they belong to the site, not to
the page.

What a check keeps or takes after that: furniture goes even when the neighbour
does not have it, and a *main* line stays even when the neighbour shares it,
because an article may repeat a paragraph of another.  So the alignment decides
every line of a page without an article element, and the open lines of others.

At scale: pages are parsed once into a written table.  Neighbours come from a
range partitioning by (host, path), so a host that holds a third of all pages
is spread over many tasks; the rows at the partitions' ends are linked through
one small table with two rows per partition.  Alignment works on 64-bit line
hashes; only pages with open lines meet its result.

Defined cases: a null or empty html gives an empty text; a null url is a host
of its own; the only page of a host loses no line; pages of a host with equal
lines have one neighbour, the nearest with other lines; a page whose lines the
neighbour all has keeps them; repeated rows are pages of their own; unclosed elements end with
their parent or the page; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import html as htmllib
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from starling.llm.common import written

OPEN, MAIN, FURNITURE = 0, 1, 2
HARD = 3  # furniture whatever it holds
_STRENGTH = (MAIN, OPEN, FURNITURE)
STEP = 128

# Elements whose text is never page text, and elements that are furniture.
_RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "object", "canvas", "xmp"}
_FURNITURE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset", "audio",
                   "video", "map"}
_MAIN_TAGS = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div",
           "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
           "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
           "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_SPACED = {"br", "td", "th", "wbr", "img"}
# Words of class and id values, and role values, that mark furniture.
_MARKS = frozenset("""
    ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist
    consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu menubar modal nav navbar navigation
    newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related replies reply
    respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget
""".split())
# Words that only say that an element is a box: a class name of marks and these is a mark as a whole.
_BOXES = frozenset("""
    area articles aside bar block body bottom box button buttons col column container div global icon icons inner item
    items left link links list main outer page pane panel posts right row section site slot stories title top unit wrap
    wrapper zone
""".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

_TOKEN = re.compile(
    r"<!--(?:.*?)(?:--\s*!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _marked(value: str, in_main: bool) -> int:
    """FURNITURE for a class or id value with a name that is a mark as a whole, OPEN for a name with a mark
    among other words (``has-sidebar``, ``notice-text``), else MAIN."""
    found = MAIN
    for name in value.split():
        words = {w.lower() for w in _WORDS.findall(name)}
        marks = words & _MARKS if in_main else words & (_MARKS | {"header"})
        if marks and all(w in _BOXES or w.isdigit() for w in words - marks):
            return FURNITURE
        if marks:
            found = OPEN
    return found


def _verdict(tag: str, attrs: str, in_main: bool, holds_main: bool) -> int:
    """HARD (by tag, role or style), FURNITURE (by a class or id name), OPEN (in doubt by a name) or MAIN.

    Names say nothing of an article or main element, or of one that ``holds_main``.
    """
    if tag in _FURNITURE_TAGS or tag == "header" and not in_main:
        return HARD
    found = MAIN
    if not attrs.strip():
        return found
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), htmllib.unescape("".join(values))
        if name in ("class", "id"):
            if not holds_main and tag not in _MAIN_TAGS and tag not in ("html", "body"):
                found = max(found, _marked(value, in_main), key=_STRENGTH.index)
        elif name == "role" and value.lower() in _ROLES:
            return HARD
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return HARD
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return HARD
    return found


def page_lines(page: str) -> list[tuple[str, int]]:
    """The text lines of a page, in order, each with its role."""
    holders: frozenset[int] = frozenset()
    while True:
        lines, found = _walk(page, holders)
        if not found:
            return lines
        holders |= found  # names marked the wrappers of the article: read again without them


def _walk(page: str, holders: frozenset[int]) -> tuple[list[tuple[str, int]], set[int]]:
    """The lines and, for a page left without a main line, where the elements begin that are furniture by their
    names though an article or main element is inside.  Names count for nothing at ``holders``."""
    lines: list[tuple[str, int]] = []
    buffer: list[str] = []
    stack: list[tuple[str, int]] = []
    named: list[tuple[int, int]] = []  # (depth in the stack, place) of the open elements marked by their names
    found: set[int] = set()

    def role() -> int:
        return stack[-1][1] if stack else OPEN

    def flush() -> None:
        if buffer:
            text = " ".join(htmllib.unescape("".join(buffer)).split())
            if text:
                lines.append((text, min(role(), FURNITURE)))
            buffer.clear()

    def close(tag: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        buffer.append(page[at:m.start()])
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            if m.group().startswith("<![CDATA["):
                buffer.append(m.group()[9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if m.group(1) or m.group(4):
            if tag in _BLOCKS:
                flush()
            elif tag in _SPACED:
                buffer.append(" ")
            close(tag)
            continue
        attrs = m.group(3) or m.group(6) or ""
        if tag in _RAW:
            if not attrs.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in _BLOCKS:
            flush()
            if any(t == "p" for t, _ in stack[-8:]):
                close("p")  # a block ends an open paragraph
            if tag in ("li", "dt", "dd", "tr") and stack and stack[-1][0] == tag:
                stack.pop()
        elif tag in _SPACED:
            buffer.append(" ")
        if tag in _VOID or attrs.rstrip().endswith("/"):
            continue
        inside = role()
        while named and named[-1][0] >= len(stack):
            named.pop()
        here = HARD
        if inside != HARD:
            if tag in _MAIN_TAGS:
                found.update(place for _, place in named)
            here = _verdict(tag, attrs, inside == MAIN, m.start() in holders)
            if here == FURNITURE:
                named.append((len(stack), m.start()))
            elif here != HARD and inside == FURNITURE:
                here = FURNITURE
            elif here == MAIN and tag not in _MAIN_TAGS:
                here = inside
        if here != inside and tag not in _BLOCKS:
            flush()
        stack.append((tag, here))
    flush()
    if any(r == MAIN for _, r in lines):
        found.clear()
    return lines, found


# ---------------------------------------------------------------- alignment
def _rows(a: list[int], b: list[int]) -> list[int]:
    """Bit rows of the LCS table: bit j of row i is 0 where the length grows from b[:j] to b[:j + 1] for a[:i]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _last_row_lengths(a: list[int], b: list[int]) -> list[int]:
    v = full = (1 << len(b)) - 1
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out, n = [0], 0
    for bit in format(v, f"0{len(b)}b")[::-1] if b else "":
        n += bit == "0"
        out.append(n)
    return out


def common_lines(a: list[int], b: list[int], cells: int = 1 << 28) -> list[int]:
    """Indexes of ``a`` in a longest common subsequence with ``b``.

    Equal ends are taken first and lines without a partner left out; what is
    left is aligned with bit rows, or split in halves while they would take
    more than ``cells`` bits.
    """
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < len(a) - lo and hi < len(b) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    both = set(a[lo:len(a) - hi]) & set(b[lo:len(b) - hi])
    index = [i for i in range(lo, len(a) - hi) if a[i] in both]
    y = [x for x in b[lo:len(b) - hi] if x in both]
    return [*range(lo), *(index[i] for i in _align([a[i] for i in index], y, cells)), *range(len(a) - hi, len(a))]


def _align(x: list[int], y: list[int], cells: int) -> list[int]:
    if not x or not y:
        return []
    if len(x) > 1 and len(x) * len(y) > cells:
        mid = len(x) // 2
        head, tail = _last_row_lengths(x[:mid], y), _last_row_lengths(x[:mid - 1:-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: head[j] + tail[len(y) - j])
        return _align(x[:mid], y[:cut], cells) + [mid + i for i in _align(x[mid:], y[cut:], cells)]
    rows, out, j = _rows(x, y), [], len(y)
    for i in range(len(x), 0, -1):
        below = (1 << j) - 1
        # trailing positions of y that add nothing to row i
        j = (~rows[i] & below).bit_length()
        if j == 0:
            break
        if (~rows[i - 1] & ((1 << j) - 1)).bit_count() < (~rows[i] & ((1 << j) - 1)).bit_count():
            out.append(i - 1)
            j -= 1
    return out[::-1]


# ---------------------------------------------------------------- pages
def parsed_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Written once, a row per page: page_id, url, row, host, path, hashes (of all lines), ``open`` (any open
    line), ``lines`` and ``place`` (index of each) of the lines that are not furniture, ``free`` (open ones)."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    schema = (f"page_id {id_type}, url string, row long, host string, path string, hashes array<bigint>, "
              "open boolean, lines array<string>, place array<int>, free array<boolean>")

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                out: list[list] = [[] for _ in range(8)]
                for i, (url, page) in enumerate(zip(piece.column("url").to_pylist(), piece.column("html").to_pylist())):
                    host, path = split_url(url)
                    found = page_lines(page)
                    kept = [(k, t, r == OPEN) for k, (t, r) in enumerate(found) if r != FURNITURE]
                    hashes = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for t, _ in found]
                    for column, value in zip(out, (row + i, host, path, hashes, any(f for _, _, f in kept),
                                                   [clean(t) for _, t, _ in kept], [k for k, _, _ in kept],
                                                   [f for _, _, f in kept])):
                        column.append(value)
                row += piece.num_rows
                types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.bool_(), pa.list_(pa.string()),
                         pa.list_(pa.int32()), pa.list_(pa.bool_())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), *[pa.array(v, t) for v, t in zip(out, types)]],
                    names=["page_id", "url", "row", "host", "path", "hashes", "open", "lines", "place", "free"])

    return written(rows.mapInArrow(run, schema).withColumn("content", F.xxhash64("hashes")), "pages")


def clean(text: str) -> str:
    """A character reference may name a lone surrogate, which no encoding can hold."""
    return text.encode("utf-8", "replace").decode("utf-8")


def split_url(url: str | None) -> tuple[str | None, str]:
    if url is None:
        return None, ""
    try:
        parts = urlsplit(url.strip())
        return (parts.hostname or "").lower(), parts.path + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", url


def neighbours(parsed: DataFrame) -> DataFrame:
    """``(row, near)``: the row of each page's nearest page by URL path in its host, among pages of other lines.

    Pages of a host with equal lines stand where the first of them stands, and have one neighbour.
    """
    pages = parsed.select("row", "host", "path", "content")
    first = pages.groupBy("host", "content").agg(F.min(F.struct("path", "row")).alias("f"))
    first = written(first.select("host", "content", F.col("f.path").alias("path"), F.col("f.row").alias("row")), "page-firsts")
    near = first.join(nearest(first), "row").select(F.col("host").alias("h"), F.col("content").alias("c"), "near")
    return pages.join(near, F.col("host").eqNullSafe(F.col("h")) & (F.col("content") == F.col("c"))).select("row", "near")


def nearest(pages: DataFrame) -> DataFrame:
    """``(row, near)``: the row of the nearest other page by URL path in the host."""
    order = written(pages.select("row", "host", "path").repartitionByRange(F.col("host"), F.col("path"), F.col("row"))
                    .withColumn("pid", F.spark_partition_id()), "page-order")
    me = F.struct("host", "path", "row")
    # the last page before, and the first page behind, each partition: two rows a partition
    ends = order.groupBy("pid").agg(F.min(me).alias("first"), F.max(me).alias("last"))
    by_pid = Window.orderBy("pid")
    ends = written(ends.select("pid", F.lag("last").over(by_pid).alias("before_all"),
                               F.lead("first").over(by_pid).alias("behind_all")), "page-ends")
    inside = Window.partitionBy("pid").orderBy("host", "path", "row")
    found = order.withColumns({"before": F.lag(me).over(inside), "behind": F.lead(me).over(inside)}).join(ends, "pid")
    found = found.withColumns({"before": F.coalesce("before", "before_all"), "behind": F.coalesce("behind", "behind_all")})

    def shared(other: str) -> Column:
        same = F.zip_with(F.split("path", "/"), F.split(F.col(f"{other}.path"), "/"), lambda a, b: a.eqNullSafe(b))
        first_miss = F.array_position(same, F.lit(False))
        score = F.when(first_miss == 0, F.size(same).cast("long")).otherwise(first_miss - 1)
        return F.when(F.col(other).isNotNull() & F.col(f"{other}.host").eqNullSafe(F.col("host")), score).otherwise(F.lit(-1))

    a, b = shared("before"), shared("behind")
    return found.select("row", F.when((a >= b) & (a >= 0), F.col("before.row")).when(b >= 0, F.col("behind.row"))
                        .alias("near")).where("near is not null")


def shared_lines(parsed: DataFrame) -> DataFrame:
    """``(row, shared)`` for pages with open lines: the indexes of their lines that the neighbour has too."""
    pairs = neighbours(parsed)
    mine = parsed.where("open").select("row", "hashes")
    theirs = parsed.select(F.col("row").alias("near"), F.col("hashes").alias("theirs"))
    both = pairs.join(mine, "row").join(theirs, "near").select("row", "hashes", "theirs")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                piece = b.slice(at, STEP)
                shared = [common_lines(x, y) for x, y in zip(piece.column("hashes").to_pylist(),
                                                            piece.column("theirs").to_pylist())]
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(shared, pa.list_(pa.int32()))],
                                                 names=["row", "shared"])

    return both.mapInArrow(run, "row long, shared array<int>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars, n_lines, n_shared (open lines the neighbour has too)."""
    parsed = parsed_pages(pages, id_col, url_col, html_col)

    def result(df: DataFrame, lines: Column, n_shared: Column) -> DataFrame:
        text = F.array_join(lines, "\n")
        return df.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), text.alias("text"),
                         F.char_length(text).cast("long").alias("n_chars"),
                         F.size(lines).cast("long").alias("n_lines"), n_shared.cast("long").alias("n_shared"))

    closed = result(parsed.where("not open"), F.col("lines"), F.lit(0))
    opened = parsed.where("open").select("page_id", "url", "row", "lines", "place", "free").join(
        shared_lines(parsed), "row", "left").withColumn("shared", F.coalesce("shared", F.array().cast("array<int>")))
    gone = F.zip_with("place", "free", lambda k, f: f & F.array_contains(F.col("shared"), k))
    # a page is not emptied: when every line would go, the neighbour holds the whole page, and none goes
    opened = opened.withColumn("gone", gone).withColumn("gone", F.when(
        F.forall("gone", lambda g: g), F.transform("gone", lambda _: F.lit(False))).otherwise(F.col("gone")))
    left = F.filter("lines", lambda _, i: ~F.get("gone", i))
    return closed.unionByName(result(opened, left, F.size(F.filter("gone", lambda g: g))))
