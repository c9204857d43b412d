"""Main text of web pages by differencing pages with their nearest URLs.

Within each host, pages are ordered by URL path and every page is compared with
its two neighbours, the one whose path is most alike first. The text lines of
two pages are aligned by their longest common subsequence; a line matches one
with the same text in the same kind of place (inside or outside an article or
main element). What is shared is template, and goes. Structure only vetoes or
supports:

* what stands in navigation, headers, footers or asides always goes;
* so does what stands in an element whose class or id names it as an advert,
  notice, comment or the like, or in a form, unless that element holds all the
  article text of the page or, where it has none, most of its text (comments apart);
* a line outside an article goes if the nearest page that is no copy shares it;
* a line in an article goes only if two different neighbours have it at the same
  place (as many article lines from the first or from the last one), neither of
  which shares over half of the article's words (pages quote and copy each
  other, and a copy must not empty its original).

A page that has no neighbour to compare with is judged by structure alone.
Only line hashes move to find pairs; to meet its neighbours' hashes a page sends
its text lines once, never its HTML.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bind, range_count, stored

# Element and class names by their role on a page.
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "textarea",
           "select", "button", "audio", "video"}
CHROME = {"nav", "header", "footer", "aside", "dialog", "menu"}
CHROME_WORDS = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav",
                "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted", "related", "reply",
                "replies", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
                "topbar", "widget"}
COMMENT_WORDS = {"comment", "comments", "disqus", "reply", "replies"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
                "alertdialog", "menu", "menubar"}
MAIN_WORDS = {"article", "main"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "center", "dd", "details", "dialog", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table",
          "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe"}
CLOSES_PARAGRAPH = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset",
                    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
                    "main", "menu", "nav", "ol", "pre", "section", "table", "ul"}
CLOSED_BY_SIBLING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

MARKUP = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
TAG_PART = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACE_RUN = re.compile(r"\s+")
ARTICLE, PLAIN, GONE = 2, 1, 0


SOFT, COMMENTS = 1, 2  # chrome by name only, and reader comments by name


def _element(tag: str, attributes: str, zone: int) -> tuple[int, int]:
    """Zone inside an element, given the zone around it, and whether its name,
    class or id says that it is chrome (0, ``SOFT`` or ``COMMENTS``)."""
    if zone == GONE or tag in SKIPPED or tag in CHROME:
        # An article's own header (its title) is part of it.
        return (zone if tag == "header" and zone == ARTICLE else GONE), 0
    doubt = SOFT if tag == "form" else 0
    if attributes:
        words, role, hidden = set(), "", False
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            value = (a or b or c).lower()
            if name.lower() in ("class", "id"):
                words.update(re.split(r"[^a-z0-9]+", value))
            elif name.lower() == "role":
                role = value
            else:
                hidden |= name.lower() == "hidden" or value == "true"
        if hidden or role in CHROME_ROLES:
            return GONE, 0
        if role in MAIN_WORDS:
            return ARTICLE, 0
        if tag not in ("html", "body", "article", "main") and words & CHROME_WORDS:
            doubt = COMMENTS if words & COMMENT_WORDS else SOFT
    return (ARTICLE if tag in MAIN_WORDS else zone), doubt


class _Tags:
    """Ends of tags, found in one pass over the page: a quote opens a value only
    after an equals sign, and one that is never closed does not hide the tag's end."""

    def __init__(self, html: str):
        self.html, self.unclosed = html, set()

    def end(self, at: int) -> int:
        """Index after the tag that is open at ``at``; the page's end if it stays open."""
        while m := TAG_PART.search(self.html, at):
            quote = m.group(1)
            if quote is None:
                return m.end()
            at = m.end()
            if quote not in self.unclosed:
                close = self.html.find(quote, at)
                if close < 0:
                    self.unclosed.add(quote)
                else:
                    at = close + 1
        return len(self.html)


def _chrome(doubted: list[list], lines: list) -> list[bool]:
    """Which of the doubted elements (``[kind, words, article words, the doubted
    element around it or -1]``, those inside others not counted yet) are chrome,
    or stand in one that is: not one that holds all article text of the page; on a
    page without article text, not one that holds most of its text, unless it is
    named as comments."""
    total = sum(n for _, _, _, n in lines)
    article = sum(n for _, zone, _, n in lines if zone == ARTICLE)
    for _, words, inside, around in reversed(doubted):  # inner elements come later
        if around >= 0:
            doubted[around][1] += words
            doubted[around][2] += inside
    gone: list[bool] = []
    for kind, words, inside, around in doubted:
        own = inside < article if article else kind == COMMENTS or 2 * words <= total
        gone.append(own or (around >= 0 and gone[around]))
    return gone


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """Text blocks of a page in order, each with its zone. White space inside a
    block is one blank; character references are decoded after the markup is
    taken apart. An unclosed tag at the end of the page is markup. Elements that
    are chrome by name only are judged once the whole page is read."""
    lines: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int, int]] = []  # element, and the zone and the doubted element around it
    is_open: Counter[str] = Counter()
    doubted: list[list] = []
    parts: list[str] = []
    zone, inside, raw, at = PLAIN, -1, "", 0

    def end_block():
        if parts:
            text = SPACE_RUN.sub(" ", unescape("".join(parts))).strip()
            if text and zone != GONE:
                n = len(text.split())
                lines.append((text, zone, inside, n))
                if inside >= 0:
                    doubted[inside][1] += n
                    doubted[inside][2] += n * (zone == ARTICLE)
            parts.clear()

    def close(depth: int):
        nonlocal zone, inside
        _, zone, inside = stack[depth]
        is_open.subtract(name for name, _, _ in stack[depth:])
        del stack[depth:]

    html = html or ""
    tags = _Tags(html)
    while at < len(html):
        if raw:  # nothing but its own end tag ends such an element
            found = re.compile(f"</{raw}(?=[\\s/>]|$)", re.I).search(html, at)
            at = found.start() if found else len(html)
            raw = ""
            continue
        m = MARKUP.search(html, at)
        if zone != GONE:
            parts.append(html[at:m.start() if m else len(html)])
        if not m:
            break
        tag = (m.group(2) or "").lower()
        if not tag:
            mark = "-->" if m.group() == "<!--" else ">"
            at = html.find(mark, m.end())
            at = len(html) if at < 0 else at + len(mark)
            continue
        at = tags.end(m.end())
        attributes = html[m.end():at - 1]
        block = tag in BLOCKS or tag in SKIPPED
        if m.group(1):  # an end tag closes up to its element, if that is open
            if block:
                end_block()
            for depth in range(len(stack) - 1, -1, -1) if is_open[tag] else ():
                if stack[depth][0] == tag:
                    if (zone, inside) != stack[depth][1:]:
                        end_block()
                    close(depth)
                    break
            continue
        if block:
            end_block()
        closes = {tag} if tag in CLOSED_BY_SIBLING else {"p"} if tag in CLOSES_PARAGRAPH else set()
        for depth in range(len(stack) - 1, max(-1, len(stack) - 9), -1) if closes else ():
            if stack[depth][0] in closes:
                end_block()
                close(depth)
                break
            if stack[depth][0] in BLOCKS:
                break
        inner, doubt = _element(tag, attributes, zone)
        if inner != zone or doubt:
            end_block()
        if tag in VOID or attributes.endswith("/"):
            continue
        stack.append((tag, zone, inside))
        is_open[tag] += 1
        zone = inner
        if doubt:
            doubted.append([doubt, 0, 0, inside])
            inside = len(doubted) - 1
        if tag in RAW:
            raw = tag
    end_block()
    gone = _chrome(doubted, lines)
    return [(text, z) for text, z, around, _ in lines if around < 0 or not gone[around]]


def _lcs_rows(a: list[int], b: list[int]) -> Iterator[int]:
    """After each entry of ``a``, a number whose bit j is clear where the longest
    common subsequence with b[:j + 1] is longer than with b[:j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        step = row & places.get(x, 0)
        row = ((row + step) | (row - step)) & every
        yield row


def _lcs_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _lcs_rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[:len(b)].astype(np.int64))])


def _lcs_hits(a: list[int], b: list[int], at: int, hit: np.ndarray) -> None:
    """Mark the entries of ``a`` (the first one is ``hit[at]``) in a longest common
    subsequence with ``b``. Long inputs are halved where both halves' lengths add
    up to the most, so memory stays linear; every step works on whole bit rows."""
    if not a or not b:
        return
    if len(a) * len(b) > LCS_BITS and len(a) > 1:
        half = len(a) // 2
        split = int(np.argmax(_lcs_lengths(a[:half], b) + _lcs_lengths(a[half:][::-1], b[::-1])[::-1]))
        _lcs_hits(a[:half], b[:split], at, hit)
        _lcs_hits(a[half:], b[split:], at + half, hit)
        return
    rows = [(1 << len(b)) - 1, *_lcs_rows(a, b)]
    i, j = len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            hit[at + i] = True


LCS_BITS = 1 << 26


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of ``a`` are in its longest common subsequence with ``b``.
    Common ends are matched first; entries that the other side lacks take no part."""
    hit = np.zeros(len(a), dtype=bool)
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    lo = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero((a[len(a) - n:] != b[len(b) - n:])[::-1])
    tail = min(int(differ[0]) if len(differ) else n, n - lo)
    hit[:lo] = True
    hit[len(a) - tail:] = True
    inner_a, inner_b = a[lo:len(a) - tail], b[lo:len(b) - tail]
    known = np.flatnonzero(np.isin(inner_a, inner_b))
    inside = np.zeros(len(known), dtype=bool)
    _lcs_hits(inner_a[known].tolist(), inner_b[np.isin(inner_b, inner_a)].tolist(), 0, inside)
    hit[lo + known[inside]] = True
    return hit


def line_hashes(lines: list[tuple[str, int]]) -> np.ndarray:
    """63 bits of each line's text, the lowest bit tells whether it is in an article."""
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) & ~1 | (zone == ARTICLE)
                     for t, zone in lines], dtype=np.uint64)


def same_place(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of ``a`` are in ``b`` as far from the first or the last one."""
    hit = np.zeros(len(a), dtype=bool)
    n = min(len(a), len(b))
    hit[:n] = a[:n] == b[:n]
    hit[len(a) - n:] |= a[len(a) - n:] == b[len(b) - n:]
    return hit


def main_text(lines: list[tuple[str, int]], neighbours: Sequence[np.ndarray] | None) -> str:
    """The lines that are no template of the ``neighbours`` (line hashes, the
    nearest page first)."""
    article = np.array([zone == ARTICLE for _, zone in lines], dtype=bool)
    hashes = line_hashes(lines)
    shared, others = [], []
    for i, other in enumerate(neighbours or ()):
        if len(other) and not any(np.array_equal(other, same) for same in neighbours[:i]):
            hit = shared_lines(hashes, other)
            if not hit.all():  # a copy does not tell template from text
                shared.append(hit)
                others.append(other)
    words = np.array([len(t.split()) for t, _ in lines], dtype=np.int64)
    if not shared:
        # Little text in articles beside much outside: those are teasers.
        keep = article if 4 * words[article].sum() >= words.sum() and article.any() else np.ones(len(lines), dtype=bool)
    else:
        keep = ~shared[0] | article
        words = words * article
        votes = [same_place(hashes[article], other[other & 1 == 1]) for hit, other in zip(shared, others, strict=True)
                 if 2 * words[hit].sum() <= words.sum()]
        if len(votes) > 1:
            keep[np.flatnonzero(article)[votes[0] & votes[1]]] = False
    return "\n".join(t for (t, _), stays in zip(lines, keep, strict=True) if stays)


def _hash_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"page_id": frame["page_id"],
                            "lines": [line_hashes(page_lines(h)).tobytes() for h in frame["html"]]})


def packed(lines: list[tuple[str, int]]) -> str:
    """Lines and zones as one text, a line's zone before it; a line holds no
    line break, as its white space is blanks."""
    return "\n".join(f"{zone}{text}" for text, zone in lines)


def unpacked(text: str) -> list[tuple[str, int]]:
    return [(line[1:], int(line[0])) for line in text.split("\n")] if text else []


def _lines(html: pd.Series) -> pd.Series:
    return pd.Series([packed(page_lines(h)) for h in html], dtype=object)


def _text(lines: pd.Series, neighbours: pd.Series) -> pd.Series:
    return pd.Series([main_text(unpacked(t), None if n is None else [np.frombuffer(x, dtype=np.uint64) for x in n])
                      for t, n in zip(lines, neighbours, strict=True)], dtype=object)


def url_neighbours(pages: DataFrame) -> DataFrame:
    """``page_id, near``: for each page the ids of the pages of its host before
    and after it in path order, the one with the longer common start of path
    first; at either end the two next ones.

    The pages of all hosts are dealt by ranges of (host, path, id) and ordered
    inside each range; the rows next to a range's edges are handed to it from
    the ranges around, so neither their number nor where they cut moves a result.
    """
    rest = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), r"/+$", "")
    rows = pages.where(F.col("page_id").isNotNull()).select(
        "page_id", F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"), path.alias("path"))
    rows = rows.groupBy("page_id").agg(F.min(F.struct("host", "path")).alias("u")).select("page_id", "u.host", "u.path")
    rows = stored(rows, "op4-paths")
    order = ["host", "path", "page_id"]
    ranges = range_count(rows.count())
    rows = stored(rows.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "op4-ranges")
    w = Window.partitionBy("part").orderBy(*order)
    # The first and last two rows of each range (a table bounded by MAX_RANGES)
    # hold the two rows on either side of every range.
    placed = rows.withColumn("nth", F.row_number().over(w)) \
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("part")))
    edges = sorted((r.part, r.nth, r.host, r.path, r.page_id)
                   for r in placed.where("nth <= 2 or nth > n - 2").select("part", "nth", *order).collect())
    starts = [i for i, e in enumerate(edges) if i == 0 or edges[i - 1][0] != e[0]]
    handed = [(edges[i][0], *e[2:]) for i, end in zip(starts, [*starts[1:], len(edges)], strict=True)
              for e in (*edges[max(0, i - 2):i], *edges[end:end + 2])] if edges else []
    handed = rows.sparkSession.createDataFrame(handed, "part int, host string, path string, page_id long")
    rows = rows.select("part", *order, F.lit(True).alias("own")).unionByName(
        handed.withColumn("own", F.lit(False)))
    at = F.struct("page_id", "path")
    same_host = lambda f, n: F.when(f("host", n).over(w) == F.col("host"), f(at, n).over(w))
    near = rows.select("own", "page_id", "path", *[same_host(f, n).alias(f"{name}{n}") for n in (1, 2)
                                                   for name, f in (("before", F.lag), ("after", F.lead))]).where("own")

    def alike(other: Column) -> Column:
        """Code points of the common start of both paths; -1 without another path."""
        letters = lambda c: F.split(c, "")
        same = F.zip_with(letters(F.col("path")), letters(other), lambda x, y: F.coalesce(x == y, F.lit(False)))
        first = bind(same, lambda equal: F.when(F.array_position(equal, False) > 0, F.array_position(equal, False) - 1)
                     .otherwise(F.size(equal)))
        return F.when(other.isNull(), F.lit(-1)).otherwise(first)

    two = F.when(F.col("before1").isNull(), F.array("after1", "after2")) \
        .when(F.col("after1").isNull(), F.array("before1", "before2")) \
        .when(alike(F.col("after1.path")) > alike(F.col("before1.path")), F.array("after1", "before1")) \
        .otherwise(F.array("before1", "after1"))
    return near.select("page_id", F.transform(F.array_compact(two), lambda c: c["page_id"]).alias("near")) \
        .where(F.size("near") > 0)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """For each row of ``pages`` (``page_id, url, html``): ``page_id, url,
    text, n_chars``.

    ``text`` is the page's blocks in order, one line each; null or empty html
    gives an empty text. Pages with no other page near them, a null url or a
    null id are judged by structure alone. Rows repeating an id count as one
    page when pairing, by their smallest url, and are extracted each. An empty
    table gives an empty result. Other columns are not read.
    """
    near = url_neighbours(pages)
    hashes = pages.where(F.col("page_id").isNotNull()).select("page_id", "html") \
        .mapInPandas(_hash_rows, "page_id long, lines binary")
    hashes = hashes.groupBy("page_id").agg(F.min("lines").alias("lines"))
    pairs = near.select(F.col("page_id").alias("id"), F.posexplode("near").alias("nth", "page_id"))
    partners = pairs.join(hashes, "page_id").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("nth", "lines"))).alias("n"))
    partners = stored(partners.select("id", F.col("n.lines").alias("neighbours")), "op4-partners")
    rows = pages.select("page_id", "url", F.pandas_udf(_lines, "string")("html").alias("lines"))
    rows = rows.join(partners, rows["page_id"] == partners["id"], "left")
    text = F.pandas_udf(_text, "string")
    return rows.select("page_id", "url", text("lines", "neighbours").alias("text")) \
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
