"""Main text of web pages: block extraction and differencing against the page with the nearest URL.

A page is cut into blocks at block-level tags. Blocks in menus, headers,
footers, sidebars, notices, adverts, forms, reader comments (by tag name, role
or the words of class and id), scripts and styles are no candidates for the
main text. Every page is paired with its neighbour in the order of URL
paths within its host, the blocks of the two are aligned as lines by their
longest common subsequence, and lines that both share are deleted, as are the
blocks named above. An article or main element protects: its lines stay also
if they are shared, so that mirrors of an article and passages that many
articles quote keep their text. A page without a neighbour has nothing to be
compared with; if it has an article or main element, its text is that. In a
page without one, differing in no line from its neighbour tells nothing, and
nothing is deleted but the blocks named above.

The neighbour is the page before in the order (host, path, rest of the URL,
page id) or, where that is of another host or has the same lines, the page after;
a page between two with its own lines, or alone on its host, has none. Pages that
are equal in id, URL and text count as one in this order. Each row gives one row.

Rows: null html is an empty page with empty text; a null or unparsable URL is
the host "" with the URL as path; ids may be null. Character references are
decoded, white space in a block is one space, blocks are trimmed, empty ones
go, the rest is joined by two \\n. Columns other than the three named are not
read. Time and memory of a task grow with its largest page, broken markup or
not; the alignment's time with the product of the lines that are left between
a common head and tail, its memory with their sum.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from period_etl.llm.common import ordered, ship, stored
from period_etl.llm.markup import Markup

#: Elements whose content is text of another kind, and so never shown as text.
_RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "title", "head", "select", "canvas"}
#: Elements that are no part of an article.
_ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: Words of class and id that mark boilerplate.
_MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
          "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
          "notice", "notices", "pagination", "popup", "promo", "related", "share", "sharing", "sidebar", "signup", "social", "sponsor",
          "sponsored", "subscribe", "toolbar"}
_NOT = {"no", "not", "without", "has", "with"}
#: Words behind a mark that say that it names a part of the page, not a subject ("share-buttons", not "share-price").
_PLACES = {"area", "bar", "block", "box", "buttons", "container", "content", "feed", "form", "icons", "item", "items", "link", "links", "list", "module",
           "panel", "posts", "section", "slot", "stories", "text", "thread", "unit", "widget", "wrap", "wrapper"}
#: Elements whose text is shown in an article.
_SHOWN = {"math", "noscript", "object"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
          "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "button"}
_CONTENT = {"article", "main"}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


def _boilerplate(name: str, attributes: str, inside: bool) -> bool:
    if name in _ASIDE or name == "header" and not inside:
        return True
    if attributes and "=" in attributes or "hidden" in attributes:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key == "role" and value in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if key in ("class", "id") and name not in ("html", "body"):
                if any(_marked(name, inside) for name in value.split()):
                    return True
    return False


def _marked(name: str, inside: bool) -> bool:
    """Whether a class or id marks boilerplate; in an article a mark counts at the name's end or before a place or number only."""
    words = [w for w in _PARTS.split(name) if w]
    for i, w in enumerate(words):
        if w in _MARKS and (i == 0 or words[i - 1] not in _NOT):
            rest = words[i + 1] if i + 1 < len(words) else ""
            if not inside or w != "header" and (not rest or rest in _PLACES or rest in _MARKS or rest.isdigit()):
                return True
    return False


def blocks(page: str) -> Iterator[tuple[str, bool, bool]]:
    """(text, is boilerplate, is inside an article or main element) of each block in page order."""
    stack: list[tuple[str, bool, bool]] = []
    opened: Counter[str] = Counter()
    text: list[str] = []
    bad = inside = False
    markup, last = Markup(page), 0

    def flush():
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        return line

    for start, end, closes, name, attributes in markup.tags():
        text.append(page[last:start])
        last = end
        if not name:
            continue
        if not closes and name in _RAW and not (inside and name in _SHOWN):
            _, close = markup.close(name, end)
            if close >= 0 or name in ("script", "style"):
                markup.at = last = close if close >= 0 else len(page)
            continue
        if name == "br":
            text.append(" ")
            continue
        mark = not closes and _boilerplate(name, attributes, inside)
        if name in _BLOCK or mark and name not in _VOID:
            if line := flush():
                yield line, bad, inside
        if closes:
            if opened[name]:
                while stack:
                    top = stack.pop()
                    opened[top[0]] -= 1
                    if top[0] == name:
                        break
                if name in _BLOCK or top[1] != (stack[-1][1] if stack else False):
                    if line := flush():
                        yield line, bad, inside
                bad, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        elif name not in _VOID and not attributes.endswith("/"):
            if name == "p" and stack and stack[-1][0] == "p":
                opened[stack.pop()[0]] -= 1
            stack.append((name, bad or mark, inside or name in _CONTENT and not bad))
            opened[name] += 1
            bad, inside = stack[-1][1], stack[-1][2]
    text.append(page[last:])
    if line := flush():
        yield line, bad, inside


#: Cells of the table by which a subsequence is traced; larger pairs are halved first.
_CELLS = 1 << 22


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.where(b == x, row[:-1] + 1, row[1:]))
    return row


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``a`` whether it stands in one longest common subsequence with ``b``."""
    out = np.zeros(len(a), bool)
    if not len(a) or not len(b):
        return out
    if len(a) * len(b) > _CELLS and len(a) > 1:   # memory stays linear: cut a in the middle and b where the halves' lengths add up best
        half = len(a) // 2
        cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        return np.concatenate([_common(a[:half], b[:cut]), _common(a[half:], b[cut:])])
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        hit = np.where(b == a[i], best[i + 1, 1:] + 1, best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(hit[::-1])[::-1]
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out[i] = True
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def shared(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each of my lines whether it stands in a longest common subsequence with the other's."""
    out = np.zeros(len(mine), bool)
    lo, hi, end = 0, len(mine), len(other)
    while lo < min(hi, end) and mine[lo] == other[lo]:
        out[lo] = True
        lo += 1
    while hi > lo and end > lo and mine[hi - 1] == other[end - 1]:
        hi, end = hi - 1, end - 1
        out[hi] = True
    a, b = mine[lo:hi], other[lo:end]
    place = np.flatnonzero(np.isin(a, b))     # what the other lacks is in no common subsequence
    a, b = a[place], b[np.isin(b, a)]
    out[lo + place[_common(a, b)]] = True
    return out


def main_text(page: str, mate: np.ndarray) -> str:
    """The page's main text; ``mate`` holds the line hashes of its neighbour, none without one."""
    found = list(blocks(page))
    article = any(inside and not bad for _, bad, inside in found)
    if len(mate):
        again = shared(line_hashes(found), mate)
        if not article and all(s or bad for (_, bad, _), s in zip(found, again.tolist(), strict=True)):
            again[:] = False
        return "\n\n".join(t for (t, bad, inside), s in zip(found, again.tolist(), strict=True) if not bad and (inside or not s))
    return "\n\n".join(t for t, bad, inside in found if not bad and (inside or not article))


def line_hashes(found: list[tuple[str, bool, bool]]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t, _, _ in found], np.uint64).view(np.int64)


def _hashed(batches):
    for batch in batches:
        lines = [line_hashes(list(blocks(page or ""))) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k1", "k2", "host", "path", "url", "page_id")), pa.array(lines, pa.list_(pa.int64()))],
                                         names=["k1", "k2", "host", "path", "url", "page_id", "lines"])


def _texts(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            text = [main_text(page or "", np.array(mate or [], np.int64)) for page, mate in zip(
                part.column("html").to_pylist(), part.column("mate").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string())], names=["page_id", "url", "text"])


def neighbours(lines: DataFrame) -> DataFrame:
    """(k1, k2, mate): the lines of each page's neighbour in (host, path, url, page_id) order, null without one.

    A neighbour with the page's own lines is none.

    Neighbours in one range partition are found there. Across partitions only
    the first and the last page of each goes through the driver.
    """
    spark = lines.sparkSession
    seats = stored(ordered(lines, "host", "path", "url", "page_id", "k1", "k2"), "html-order")
    row = F.struct("host", "lines")
    ends = seats.groupBy("_part").agg(F.min_by(row, "_row").alias("first"), F.max_by(row, "_row").alias("last"), F.max("_row").alias("at")).orderBy("_part").collect()
    edges = [(e._part, 0, ends[i - 1]["last"], None) for i, e in enumerate(ends) if i] + [
        (e._part, e["at"], None, ends[i + 1]["first"]) for i, e in enumerate(ends[:-1])]
    kind = "host string, lines array<long>"
    edge = spark.createDataFrame(edges, f"_part int, _row long, prior struct<{kind}>, later struct<{kind}>").groupBy("_part", "_row").agg(
        F.first("prior", True).alias("prior"), F.first("later", True).alias("later"))
    line = Window.partitionBy("_part").orderBy("_row")
    both = (seats.withColumns({"p": F.lag(row).over(line), "l": F.lead(row).over(line)}).join(F.broadcast(edge), ["_part", "_row"], "left")
            .withColumns({"p": F.coalesce("p", "prior"), "l": F.coalesce("l", "later")}))
    def other(side):
        return (F.col(f"{side}.host") == F.col("host")) & (F.col(f"{side}.lines") != F.col("lines"))

    mate = F.when(other("p"), F.col("p.lines")).when(other("l"), F.col("l.lines"))
    return both.select("k1", "k2", mate.alias("mate"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for each row of ``pages``; see the module."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = rows.withColumns({
        "k1": F.xxhash64("page_id", "url", "html"), "k2": F.xxhash64("html", F.lit(1), "url", "page_id"), "host": host,
        "path": F.when(host == "", url).otherwise(F.regexp_extract(url, r"^[^:]*://[^/?#]*([^?#]*)", 1))})
    lines = rows.mapInArrow(_hashed, "k1 long, k2 long, host string, path string, url string, page_id long, lines array<long>")
    lines = lines.groupBy("k1", "k2").agg(*[F.first(c).alias(c) for c in ("host", "path", "url", "page_id", "lines")])
    mates = stored(neighbours(lines), "html-mates")
    return rows.join(mates, ["k1", "k2"]).select("page_id", "url", "html", "mate").mapInArrow(_texts, "page_id long, url string, text string")
