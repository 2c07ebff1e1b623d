"""Main text of web pages by differencing each page with its nearest neighbour.

Pages are put in the order (host, path, position), and each is paired with the
one of its two neighbours of the same host whose path has more leading parts in
common. Their text lines are aligned by longest common subsequence; lines that
stand in both pages are the site's, not the page's. Pages are ordered by a range
exchange and neighbours meet by rank, so a host with a third of all pages is
spread like any other; only hashes of lines are exchanged for the pairs.

Markup decides before the difference where it says what a line is. Elements that
by tag, role, class or id are menus, page headers, footers, sidebars, notices,
adverts, forms, comments or hidden go, also where no neighbour has the same
words. Where a page has an article or main element, only lines in it are kept,
and its headings, paragraphs, items, cells, quotes and preformatted lines are
the page's own even when another page repeats them; what stands there loosely,
and all lines of a page without such an element, go if they are shared. A page
that shares all of its lines is a copy, which shows nothing of the template, and
keeps them.

A null or empty page has no text. A page whose address is null, or alone on its
host, has no neighbour and is read by its markup only. Repeated rows are pages
of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.llm.words import pieces
from flowgauge.sources.scratch import written

PAGE_BYTES = 1 << 20

# Names of HTML elements and of common parts of web pages.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in "script style textarea title xmp iframe noembed noframes".split()}
UNSEEN = set(
    "head script style noscript template title textarea iframe svg math object audio video canvas map "
    "nav footer aside form button select option datalist dialog menu label fieldset".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
OWN = set("p h1 h2 h3 h4 h5 h6 li dd dt td th caption blockquote pre figcaption summary".split())
MAIN = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
PARTS = re.compile(
    r"^(ad|ads|advert|adverts|advertisement|advertising|adbox|adsense|banner|sponsor|sponsored|promo|promotion|"
    r"cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|subscription|"
    r"sidebar|aside|widget|widgets|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|topbar|masthead|header|footer|copyright|"
    r"comment|comments|respond|replies|disqus|discussion|share|sharing|social|related|recommended|recommendations|"
    r"pagination|pager|toolbar|login|signup|search|skip|hidden)$"
)
SAYS_OF_OTHERS = {"no", "has", "with", "without"}
CLOSES = {"p": BLOCKS - {"article", "main", "body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
LAID_OUT = re.compile(r"\s+")
ADDRESS = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)")


@dataclass
class Line:
    text: str
    in_main: bool
    own: bool


def _unwanted(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is no part of an article, by its tag, role, class, id or style."""
    if tag in UNSEEN or (tag == "header" and not in_main):
        return True
    if not attributes or attributes.isspace() or tag in MAIN or tag in ("html", "body"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for label in value.split():
                parts = {p.lower() for p in PART.findall(label)}
                if not parts & SAYS_OF_OTHERS and any(PARTS.match(p) for p in parts - ({"header"} if in_main else set())):
                    return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True
    return False


def page_lines(page: str) -> list[Line]:
    """Text lines of a page that markup does not rule out, one for each block."""
    lines: list[Line] = []
    text: list[str] = []
    stack: list[str] = []
    unseen: list[int] = []  # heights of the stack at which unwanted elements stand
    mains: list[int] = []
    owns: list[int] = []

    def flush() -> None:
        line = LAID_OUT.sub(" ", entities.unescape("".join(text))).strip() if text else ""
        text.clear()
        if line:
            lines.append(Line(line, bool(mains), bool(owns)))

    def close(height: int) -> None:
        del stack[height:]
        for marks in (unseen, mains, owns):
            while marks and marks[-1] >= height:
                marks.pop()

    at = 0
    while tag := TAG.search(page, at):
        if tag.start() > at and not unseen:
            text.append(page[at : tag.start()])
        at = tag.end()
        name = tag.group(2)
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            text.append(" ")
        if tag.group(1):
            for height in range(len(stack) - 1, -1, -1):
                if stack[height] == name:
                    close(height)
                    break
            continue
        while stack and name in CLOSES.get(stack[-1], ()):
            close(len(stack) - 1)
        if name == "p" and "p" in stack:  # an open paragraph with unclosed inline elements
            close(len(stack) - 1 - stack[::-1].index("p")) if not unseen else None
        if name in VOID or tag.group(3).endswith("/") and name not in BLOCKS:
            continue
        height = len(stack)
        stack.append(name)
        if _unwanted(name, tag.group(3), bool(mains)):
            unseen.append(height)
        if name in MAIN:
            mains.append(height)
        if name in OWN:
            owns.append(height)
        if name in RAW:  # markup in it is no markup
            end = RAW[name].search(page, at)
            at = end.start() if end else len(page)
    if not unseen:
        text.append(page[at:])
    flush()
    return lines


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Indices in a of a longest common subsequence of a and b."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []  # smallest last index in b of a common subsequence of each length
    links: list[tuple | None] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def main_text(lines: list[Line], shared: set[int]) -> str:
    """The lines of the article, joined by line ends."""
    framed = any(line.in_main for line in lines)
    kept = []
    copy = len(shared) == len(lines)
    for i, line in enumerate(lines):
        if framed and not line.in_main:
            continue
        if i in shared and not copy and not (line.in_main and line.own):
            continue
        kept.append(line.text)
    return "\n".join(kept)


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path and hashes of the lines of each page that has an address."""
    for batch in pieces(batches, PAGE_BYTES, "html"):
        out: dict[str, list] = {"at": [], "host": [], "path": [], "lines": []}
        for at, url, page in zip(*(batch.column(c).to_pylist() for c in ("at", "url", "html"))):
            address = ADDRESS.match(url or "")
            if address:
                hashes = [xxhash.xxh64_intdigest(line.text.encode("utf-8", "replace")) for line in page_lines(page)]
                row = (at, address[1].lower(), address[2], np.array(hashes, np.uint64).tobytes())
                for values, value in zip(out.values(), row):
                    values.append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("at", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("lines", pa.binary())]))


def _nearness(a: str, b: str | None) -> int:
    """Leading path parts in common; -1 without a neighbour."""
    if b is None:
        return -1
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ats, shared = [], []
        rows = [batch.column(c).to_pylist() for c in ("at", "path", "lines", "path_before", "lines_before", "path_after", "lines_after")]
        for at, path, lines, path_before, before, path_after, after in zip(*rows):
            other = before if _nearness(path, path_before) >= _nearness(path, path_after) else after
            if other is not None:
                ats.append(at)
                shared.append(common_lines(np.frombuffer(lines, np.uint64).tolist(), np.frombuffer(other, np.uint64).tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.array(shared, pa.list_(pa.int32()))], ["at", "shared"])


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, PAGE_BYTES, "html"):
        pages, shared = batch.column("html").to_pylist(), batch.column("shared").to_pylist()
        texts = [main_text(page_lines(page), set(both or ())) for page, both in zip(pages, shared)]
        rest = [batch.column(c) for c in ("page_id", "url")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], ["page_id", "url", "text"])


def ranked_pages(pages: DataFrame) -> DataFrame:
    """The pages with their rank in the order (host, path, at), without bringing a host to one task."""
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(pages.repartitionByRange(parts, "host", "path", "at").withColumn("part", F.spark_partition_id()), "pages")
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("host", "path", "at"))
    return written(dealt.withColumn("n", within).join(offsets, "part").select("at", "host", "path", "lines", (F.col("n") + F.col("offset")).alias("rank")), "ranked-pages")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    named = pages.select(
        F.monotonically_increasing_id().alias("at"),
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(page), F.lit("")).alias("html"),
    )
    hashed = named.mapInArrow(_line_batches, "at long, host string, path string, lines binary")
    ranked = ranked_pages(hashed)

    def beside(name: str, step: int) -> DataFrame:
        return ranked.select(
            (F.col("rank") + step).alias("rank"), "host", F.col("path").alias(f"path_{name}"), F.col("lines").alias(f"lines_{name}")
        )

    trios = ranked.join(beside("before", 1), ["rank", "host"], "left").join(beside("after", -1), ["rank", "host"], "left")
    shared = trios.mapInArrow(_shared_batches, "at long, shared array<int>")
    schema = f"page_id {named.schema['page_id'].dataType.simpleString()}, url string, text string"
    return named.join(shared, "at", "left").mapInArrow(_text_batches, schema)


@query("op3_page_differencing")
def op3(spark, sf_dir):
    text = F.col("text")
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length(text).cast("long").alias("n_chars"))
