"""Main text of web pages: blocks of text, and differencing of pages whose URLs are nearest."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.chunks import slices
from threadlens.llm.common import identity, partitions
from threadlens.llm.url_rules import host_of, path_of
from threadlens.session import written

# Names that HTML defines, and words that name page furniture in class, id and role.
_SILENT = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button form nav header footer aside dialog menu".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|side|aside|header|masthead|footer|cookies?|consent|notices?|alert|popup|modal|newsletter|"
    r"subscribe|social|share|sharing|related|recommended|comments?|respond|reply|replies|disqus|widget|pagination|pager|login|search|contentinfo|complementary|navigation)(?:$|[\s_-]|\d)", re.I
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)


def blocks_of(html: str) -> list[tuple[str, bool]]:
    """(text, inside the article) of the blocks of a page that are no furniture by their markup, in page order.

    Tags may be left open or closed out of turn: a closing tag ends what was opened since its opening one, and is ignored
    without one. A header inside the article counts as its own, unless it is named as furniture.
    """
    out: list[tuple[str, bool]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, silent, in the article
    silent = main = False

    def flush() -> None:
        if text:
            block = " ".join(unescape("".join(text)).split())
            if block:
                out.append((block, main))
            text.clear()

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at and not silent:
            text.append(html[at:stop])
        if not m:
            break
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            text.append(" ")
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    flush()
                    del stack[k:]
                    silent, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                    break
            continue
        if tag in _RAW and not m[3].endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag in ("p", "li") and stack and stack[-1][0] == tag:
            stack.pop()
        named = " ".join(x or y or z for x, y, z in _NAMED.findall(m[3]))
        furniture = tag in _SILENT and not (tag == "header" and main) or bool(named and _FURNITURE.search(named) and tag not in ("html", "body", "article", "main")) or bool(m[3] and _HIDDEN.search(m[3]))
        if furniture and not silent:
            flush()
        parent = stack[-1] if stack else ("", False, False)
        stack.append((tag, parent[1] or furniture, parent[2] or tag in _MAIN))
        silent, main = stack[-1][1], stack[-1][2]
    flush()
    return out


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` of a longest common subsequence of `a` and `b`.

    Equal beginnings and ends are taken first. For the rest, row by row, bits mark where the length grows (one big integer
    a row), and the way back through the rows gives the places.
    """
    low, n, m = 0, len(a), len(b)
    while low < min(n, m) and a[low] == b[low]:
        low += 1
    while n > low and m > low and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    both = set(a[low:n]) & set(b[low:m])
    x = [i for i in range(low, n) if a[i] in both]
    y = [j for j in range(low, m) if b[j] in both]
    where: dict[int, int] = {}
    for k, j in enumerate(y):
        where[b[j]] = where.get(b[j], 0) | 1 << k
    full, rows = (1 << len(y)) - 1, []
    v = full
    for i in x:
        u = v & where[a[i]]
        v = (v + u | v - u) & full
        rows.append(v)
    found, k = [], len(y) - 1
    for r in range(len(x) - 1, -1, -1):
        while k >= 0 and rows[r] >> k & 1:
            k -= 1
        if k < 0:
            break
        if r == 0 or rows[r - 1] >> k & 1:
            found.append(x[r])
            k -= 1
    return [*range(low), *reversed(found), *range(n, len(a))]


def _parsed(pages: DataFrame) -> DataFrame:
    """_page (digest of the row), host, path and blocks of each page."""
    keyed = pages.select(
        identity("page_id", "url", "html").alias("_page"), "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.coalesce("html", F.lit("")).alias("html")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("line", pa.string()), ("main", pa.bool_())]))
        for rows, pages_ in slices(batches, "html"):
            blocks = [[{"line": t, "main": m} for t, m in blocks_of(html)] for html in pages_]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(blocks, kind)], [*rows.schema.names[:-1], "blocks"])

    return keyed.mapInArrow(work, "_page string, page_id bigint, url string, host string, path string, blocks array<struct<line:string,main:boolean>>")


def _near(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def layout_lines(lines: list[dict], others: list[list[int]]) -> list[int]:
    """Places of the lines (d, n, main) of a page that are layout by the digests of the pages beside it, nearest first."""
    places = common_lines([x["d"] for x in lines], others[0])
    if len(others) > 1 and 2 * sum(lines[i]["n"] for i in places) > sum(x["n"] for x in lines):
        both = set(common_lines([x["d"] for x in lines], others[1]))
        places = [i for i in places if i in both]
    inside = sum(lines[i]["n"] for i in places if lines[i]["main"])
    return [i for i in places if not lines[i]["main"]] if 2 * inside > sum(x["n"] for x in lines if x["main"]) else places


def shared_lines(parsed: DataFrame) -> DataFrame:
    """_page and _shared, the places of the lines that each page shares with the one whose URL is nearest.

    Pages are sorted by host, path, lines and digest over ranges; of the closest pages before and after with other lines on
    the same host, the one with the longer common path beginning is nearest, at a tie the one before. Equal pages are passed
    over however many there are. Only digests and lengths of lines travel. Lines are aligned by a longest common
    subsequence, inside articles too. All shared lines go. Where they hold over half of the page's text and there is a page
    on the other side as well, those go that it shares too, so that an edited copy beside a page is not taken for layout.
    An article that would still lose over half of its own text keeps it.
    """
    digests = F.transform("blocks", lambda x: F.struct(F.xxhash64(x["line"]).alias("d"), F.length(x["line"]).alias("n"), x["main"].alias("main")))
    lines = parsed.where(F.size("blocks") > 0).select("host", "path", "_page", digests.alias("lines")).withColumn("sig", F.xxhash64(F.transform("lines", lambda x: x["d"])))
    order = ("host", "path", "sig", "_page")
    row, place = F.struct(*order, "lines"), F.struct(*order)
    ranged = written(lines.dropDuplicates(["_page"]).repartitionByRange(partitions(parsed.sparkSession), *order).withColumn("_part", F.spark_partition_id()), "page_lines")
    edges = _range_edges(ranged, row, place)
    guests = edges.select("_part", F.explode(F.array_compact(F.array("a", "b"))).alias("r")).select("r.*", "_part", F.lit(True).alias("_guest"))
    around = ranged.withColumn("_guest", F.lit(False)).unionByName(guests)
    for side, ways in (("before", [F.col(c).asc() for c in order]), ("after", [F.col(c).desc() for c in order])):
        within = Window.partitionBy("_part").orderBy(*ways)
        beside = F.lag(F.struct("host", "path", "sig", "lines")).over(within)
        around = around.withColumn("_beside", beside).withColumn(
            side, F.last(F.when(F.col("_beside.sig") != F.col("sig"), F.col("_beside")), ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
        ).drop("_beside")
    sides = [F.when(F.col(f"{side}.host") == F.col("host"), F.col(f"{side}.{c}")).alias(f"{side}_{c}") for side in ("before", "after") for c in ("path", "lines")]
    paired = around.where("not _guest").select("_page", "path", "lines", *sides).where("before_lines is not null or after_lines is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, shared = [], []
            for r in batch.to_pylist():
                near = {side: _near(r["path"], r[f"{side}_path"]) for side in ("before", "after") if r[f"{side}_lines"] is not None}
                others = [[x["d"] for x in r[f"{side}_lines"]] for side in sorted(near, key=near.get, reverse=True)]
                places = layout_lines(r["lines"], others)
                if places:
                    pages.append(r["_page"])
                    shared.append(places)
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.string()), pa.array(shared, pa.list_(pa.int32()))], ["_page", "_shared"])

    return paired.mapInArrow(work, "_page string, _shared array<int>")


def _range_edges(ranged: DataFrame, row: Column, place: Column) -> DataFrame:
    """_part of each range, and the closest rows before (a) and after it (b) whose lines differ from its first and last row's.

    A range whose rows all have the same lines passes on what lies beyond it.
    """
    ends = ranged.groupBy("_part").agg(F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last"))
    borders = ends.select("_part", F.col("first.sig").alias("low"), F.col("last.sig").alias("high"))
    runs = ranged.join(F.broadcast(borders), "_part")
    inner = runs.groupBy("_part").agg(
        F.max_by(F.when(F.col("sig") != F.col("high"), row), F.when(F.col("sig") != F.col("high"), place)).alias("before_last"),
        F.min_by(F.when(F.col("sig") != F.col("low"), row), F.when(F.col("sig") != F.col("low"), place)).alias("after_first"),
    )
    edges = ends.join(inner, "_part")
    for out, ways, near, far, inside in (("a", F.col("_part").asc(), "first", "last", "before_last"), ("b", F.col("_part").desc(), "last", "first", "after_first")):
        over = Window.orderBy(ways)
        beside = F.lag(far).over(over)
        edges = edges.withColumn("_beside", F.when(beside["sig"] != F.col(near)["sig"], beside))
        edges = edges.withColumn("_beyond", F.last(F.coalesce(inside, "_beside"), ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0)))
        edges = edges.withColumn(out, F.coalesce("_beside", F.lag("_beyond").over(over))).drop("_beside", "_beyond")
    return edges.select("_part", "a", "b")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page: its blocks of text, joined by two line ends.

    Blocks are what is no furniture by tag, class, id or role, inside and outside of <article> and <main>, less the lines
    that the page shares with its nearest URL's (`shared_lines`).
    Null and empty pages have empty text; repeated rows stay, each with the same result.
    """
    parsed = _parsed(pages)
    shared = written(shared_lines(parsed), "shared_lines")
    joined = parsed.join(shared, "_page", "left")
    own = F.filter("blocks", lambda x, i: F.col("_shared").isNull() | ~F.array_contains("_shared", i))
    text = F.array_join(F.transform(own, lambda x: x["line"]), "\n\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
