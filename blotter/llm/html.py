"""Main text of web pages: page structure, and differencing against the page
of nearest URL.

A page is read into text lines, one for each block, with a mark where a line
lies in an article. Lines of menus, headers, footers, side bars, notices,
adverts, forms, scripts, styles and reader comments, known by element, role or
class, are no lines at all. Inside an article a class or id tells them only as
a whole name, or as a name with words of layout (``comments-area``, ``ad-slot``);
an article inside another one is dropped by the same names.

Pages are ordered by host and URL path and each is paired with that neighbour
of its host whose path shares the longer beginning. The lines of the two are
aligned by longest common subsequence; what they share is template and is
deleted, on every page, with or without an article. The structure then checks
what is left (:func:`kept_lines`): shared lines inside an article come back, since
pages may share article text in full, and lines outside it stay only where the
pair has shown its template there. A page without an article all of whose lines
are shared (a copy) keeps them.

The pairing works on line hashes: rows are numbered over range partitions by
host and path, so a host with a third of all pages is spread by path, and
neighbours meet in an equi-join on consecutive numbers. Pages are parsed once
for the hashes and once for the lines, which are then joined to the positions of
the shared ones; equal pages that are many are dealt over many tasks there.

Defined cases: null or empty html gives empty text; a null url is a host of
its own; rows with equal content have equal results; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import HOT_ROWS, HOT_SHARE, numbered, salted_join, saved, slices

#: Elements without content, elements that break lines, elements
#: that are never main text, elements and roles that hold it.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "aside button canvas dialog footer form head header iframe map math menu nav noframes noscript object script "
    "select style svg template textarea title".split()
)
RAW = frozenset("script style textarea title noscript iframe noframes".split())
MAIN = frozenset(("article", "main"))
CONTAINERS = frozenset("html body".split()) | MAIN
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header masthead menu modal nav navbar navigation newsletter notice notification popup promo related replies "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
DROPPED_CLASS = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(sorted(DROPPED_NAMES))})(?:$|[\s_-])", re.IGNORECASE)

#: Inside an article these elements are text, and only a whole class or id of
#: these names drops an element (no id of a heading, which is made of its text).
DROPPED_INSIDE = DROPPED - frozenset("button math object".split())
NAMES_INSIDE = DROPPED_NAMES - {"notice"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Words that say how such an element is laid out.
LAYOUT = frozenset(
    "area bar block body box btn button buttons card container content count feed form frame group holder icons inner item "
    "items links list module panel row section slot strip text thread title tools top unit wrap wrapper zone".split()
)

#: Cells of the table of an alignment, in bits; longer pages are divided.
TABLE_BITS = 1 << 24

#: Bytes of a line's hash in the marks of a page.
MARK = 5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([A-Za-z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def _named_inside(value: str) -> bool:
    """Whether a class or id names a part that is no text: a whole name, or a
    name whose other words are of layout."""
    for name in value.lower().split():
        first, *rest = re.split("[-_]+", name)
        if name in NAMES_INSIDE or first in NAMES_INSIDE and rest and LAYOUT.issuperset(rest):
            return True
    return False


def _dropped(tag: str, attributes: str, inside: bool) -> bool:
    if tag in (DROPPED_INSIDE if inside else DROPPED):
        return True
    container = tag in CONTAINERS and not (inside and tag == "article")
    if container or "=" not in attributes:
        return "hidden" in attributes.lower().split() and not container
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            if not inside:
                gone = DROPPED_CLASS.search(value) is not None
            else:
                gone = not (name == "id" and tag in HEADINGS) and _named_inside(value)
            if gone:
                return True
        if name == "role" and value.lower() in DROPPED_ROLES or name == "aria-hidden" and value.lower() == "true":
            return True
    return False


def lines(html: str) -> list[tuple[str, bool]]:
    """The page's text lines in order, and whether each lies in an article."""
    out: list[tuple[str, bool]] = []
    held: list[str] = []
    #: Open elements that matter: (name, dropped, main), with those around.
    stack: list[tuple[str, bool, bool]] = [("", False, False)]

    def flush():
        if held:
            line = " ".join(unescape("".join(held)).split())
            if line:
                out.append((line, stack[-1][2]))
            held.clear()

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            if not stack[-1][1]:
                held.append(html[at:])
            break
        if m.start() > at and not stack[-1][1]:
            held.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            held.append(" ")
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
            at = close.start() if close else end
            continue
        drop = stack[-1][1] or _dropped(tag, m[3], stack[-1][2])
        main = stack[-1][2] or tag in MAIN or "articleBody" in m[3] or "role=\"main\"" in m[3]
        if tag not in VOID and not m[3].endswith("/") and ((drop, main) != stack[-1][1:] or any(s[0] == tag for s in stack)):
            stack.append((tag, drop, main))
    flush()
    return out


def cut(marks: bytes) -> list[bytes]:
    return [marks[i : i + MARK] for i in range(0, len(marks), MARK)]


def _steps(a: list, b: list) -> Iterator[int]:
    """The rows of the alignment table: whole-number bit vectors with a bit for
    each line of ``a``, one for each line of ``b``. A zero bit is a place where the
    common subsequence of ``a`` up to there grows."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    now = full = (1 << len(a)) - 1
    for x in b:
        meet = now & places.get(x, 0)
        now = ((now + meet) | (now - meet)) & full
        yield now


def _grown(a: list, b: list) -> np.ndarray:
    """Lengths of the common subsequences of ``b`` with each beginning of ``a``."""
    row = full = (1 << len(a)) - 1
    for row in _steps(a, b):
        pass
    bits = np.unpackbits(np.frombuffer((full ^ row).to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits[: len(a)], dtype=np.int64)])


def common_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Memory is bounded: where the table would be large, ``b`` is halved and ``a``
    divided where the lengths of both halves add up to the most."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append(a1)
        if a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) > TABLE_BITS and b1 - b0 > 1:
            middle = (b0 + b1) // 2
            before = _grown(a[a0:a1], b[b0:middle])
            after = _grown(a[a0:a1][::-1], b[middle:b1][::-1])[::-1]
            at = a0 + int(np.argmax(before + after))
            todo += [(a0, at, b0, middle), (at, a1, middle, b1)]
            continue
        table, row, col = list(_steps(a[a0:a1], b[b0:b1])), b1 - b0, a1 - a0
        while row and col:
            if table[row - 1] >> (col - 1) & 1:
                col -= 1
            else:
                row -= 1
                if not row or table[row - 1] >> (col - 1) & 1:
                    col -= 1
                    out.append(a0 + col)
    return sorted(out)


def kept_lines(found: list[tuple[str, bool]], shared: list[int]) -> list[str]:
    """The lines that are the page's text, by the positions of those it shares.

    What is shared goes. Then the structure has its say: the lines of an article
    are text also if they are shared, and outside of one a line is text only if
    others there are shared (else the neighbour has another template, or there is
    none, and says nothing). Without an article all lines stay if all are shared."""
    gone = set(shared)
    left = [i not in gone for i in range(len(found))]
    if not any(main for _, main in found):
        return [line for (line, _), own in zip(found, left) if own or not any(left)]
    told = any(not main and not own for (_, main), own in zip(found, left))
    return [line for (line, main), own in zip(found, left) if main or told and own]


def main_text(html: str, shared: list[int]) -> str:
    return "\n".join(kept_lines(lines(html), shared))


def keyed(pages: DataFrame) -> DataFrame:
    """``page_id, url, row, host, path, html``; ``row`` is equal for equal pages."""
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    address = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_replace(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", "")
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), url.alias("url"),
        F.xxhash64(address, F.coalesce(html, F.lit(""))).alias("row"), host.alias("host"), path.alias("path"), html.alias("html"),
    )


def marked(pages: DataFrame) -> DataFrame:
    """``row, host, path, marks`` of :func:`keyed` pages: the hashes of their lines."""

    def run(batches):
        for b in slices(batches):
            marks = [
                b"".join(xxhash.xxh3_64_digest(line)[:MARK] for line, _ in lines(h or "")) for h in b.column("html").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("row", "host", "path")), pa.array(marks, pa.binary())], ["row", "host", "path", "marks"]
            )

    return pages.select("row", "host", "path", "html").mapInArrow(run, "row bigint, host string, path string, marks binary")


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, row, lines, inside`` of :func:`keyed` pages; ``inside`` has a
    byte for each line, 1 if it lies in an article."""

    def run(batches):
        for b in slices(batches):
            found = [lines(h or "") for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in ("page_id", "url", "row")),
                    pa.array([[line for line, _ in page] for page in found], pa.list_(pa.string())),
                    pa.array([bytes(main for _, main in page) for page in found], pa.binary()),
                ],
                ["page_id", "url", "row", "lines", "inside"],
            )

    return pages.select("page_id", "url", "row", "html").mapInArrow(
        run, "page_id bigint, url string, row bigint, lines array<string>, inside binary"
    )


def _shared_start(a, b):
    """Characters that two paths share from their beginning."""
    at = F.sequence(F.lit(1), F.least(F.length(a), F.length(b)) + 1)
    return F.array_position(F.transform(at, lambda i: F.substring(a, F.lit(1), i) != F.substring(b, F.lit(1), i)), True)


def url_order(pages: DataFrame) -> DataFrame:
    """``pos, row, copies, host, path, marks``: the different pages in the order of
    their URLs, and how many equal ones there are of each."""
    rows = marked(pages).groupBy("row").agg(
        F.count(F.lit(1)).alias("copies"), F.first(F.struct("host", "path", "marks")).alias("m")
    )
    order, _ = saved(numbered(rows.select("row", "copies", "m.*"), "host", "path", "row"), "html-order")
    return order


def shared_lines(order: DataFrame) -> DataFrame:
    """``row, shared``: positions of the lines that a page (of :func:`url_order`) has
    in common with the page of nearest URL path of its host."""
    mates = None
    for step in (-1, 1):
        other = order.select(
            (F.col("pos") - step).alias("pos"), F.col("host").alias("o_host"), F.col("path").alias("o_path"),
            F.col("marks").alias("o_marks"),
        )
        pair = order.join(other, "pos").where("host = o_host").select(
            "row", "marks", "o_marks", _shared_start(F.col("path"), F.col("o_path")).alias("near"), F.lit(step).alias("step")
        )
        mates = pair if mates is None else mates.union(pair)
    best = mates.groupBy("row").agg(F.max_by(F.struct("marks", "o_marks"), F.struct("near", -F.col("step"))).alias("m"))

    def run(batches):
        for b in slices(batches):
            found = [
                common_lines(cut(x), cut(y)) for x, y in zip(b.column("marks").to_pylist(), b.column("o_marks").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(found, pa.list_(pa.int32()))], ["row", "shared"])

    return best.select("row", "m.marks", "m.o_marks").mapInArrow(run, "row bigint, shared array<int>")


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = keyed(pages)
    order = url_order(rows)
    # Fewer than 1 / HOT_SHARE pages, whatever the input.
    total = order.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = [r[0] for r in order.where(F.col("copies") > max(total * HOT_SHARE, HOT_ROWS)).select("row").collect()]

    def run(batches):
        for b in slices(batches):
            found = zip(b.column("lines").to_pylist(), b.column("inside").to_pylist(), b.column("shared").to_pylist())
            texts = ["\n".join(kept_lines(list(zip(own, map(bool, inside))), shared or [])) for own, inside, shared in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    # The positions are the small side; the lines are not sorted for the join.
    shared = shared_lines(order).hint("shuffle_hash")
    joined = salted_join(parsed(rows), shared, "row", F.monotonically_increasing_id(), hot=hot)
    texts = joined.select("page_id", "url", "lines", "inside", "shared").mapInArrow(run, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
