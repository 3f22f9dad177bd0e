"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of the page (paragraph, heading, list item,
table row ...).  What markup itself says is no article text (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) leaves no text, and
outside an article it leaves a gap of empty lines.  The distribution is the sum of text
lengths over sliding windows of ``WINDOW`` lines.  Reading starts where a window surges to
``SURGE`` characters (or to the page's own peak, if that is lower), at the first of the
unbroken lines there, and goes on until the window dives to nothing; the lines between the
two points are kept, links and short ones included.

The length that counts for a line is its text outside links, so runs of links are dives.
On a page with an ``article`` or ``main`` element only lines inside one count, in full (of
its ``header`` the headings); on other pages short lines without a heading right at the surge
point belong to the gap before, and copyright lines at the dive to the gap after.

Defined cases: null, empty and text-free pages give an empty text; unclosed and misnested
elements end with the element around them; a raw element (script, style ...) without its
end tag hides the rest of the page, as in a browser; white space is what Unicode calls so,
no-break spaces included; repeated rows give repeated results; an empty table gives no rows;
other columns are left behind.  Pages are read one by one, so memory is bounded by a batch
or the longest page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

WINDOW = 3
SURGE = 86
NEAR = 50  # open elements among which the one that holds a paragraph is looked for
SHORT = 25  # a line right at a surge, shorter than this and no heading, belongs to the gap

RAW = frozenset("script style textarea title noscript template iframe object svg math canvas audio video select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
                   "sub sup time tt u var label".split()) | {"br", "img", "wbr"}
FORMATS = INLINE - {"span", "label"}  # never tracked: closing them ends nothing
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
ARTICLES = frozenset(("article", "main"))
BOILERPLATE = frozenset("nav header footer aside form button fieldset dialog menu".split())
# Words of class, id and role that mark such parts on any element.
MARKS = frozenset("""
ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner
nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar pagination pager skip
header masthead topbar footer foot copyright colophon contentinfo
sidebar aside complementary widget widgets related recommended teaser teasers trending
notice notices cookie cookies consent gdpr alert popup modal overlay disclaimer newsletter subscribe signup login
form search comment comments commentlist disqus reply replies respond share sharing social
""".split())
# First words of names that tell of another element (content with-sidebar).
STATES = frozenset("has with without no not is".split())
# Elements that paragraphs consist of, or stand in, within the element that holds the text.
INNER = INLINE | HEADINGS | frozenset("p li dt dd td th tr ul ol dl tbody thead table blockquote pre figure figcaption".split())
# Marks that an element of the page's frame may carry together with the article itself
# (<body class="has-sidebar">): they say nothing there.
FRAME = frozenset(("html", "body", "main", "article"))
COMMENT_MARKS = frozenset("comment comments commentlist disqus reply replies respond related recommended teaser teasers".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_DECLARED = re.compile(r"<[!?]")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
_MARK = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_OWNER = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)  # the line that ends a page
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def marks_of(attributes: str) -> set[str]:
    """The words of an element's class, id and role that mark boilerplate."""
    words: set[str] = set()
    for found in _MARK.findall(attributes):
        for name in "".join(found).split():
            parts = [p.lower() for p in _PART.findall(name)]
            if parts and parts[0] not in STATES:
                words.update(parts)
    return words & MARKS


class Lines:
    """Lines of one page: ``texts``, the ``lengths`` that count for them, ``headings``."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.lengths: list[int] = []
        self.headings: list[bool] = []
        self.inside: list[bool] = []  # within an article
        self.pieces: list[str] = []
        self.linked = 0  # characters inside links
        # [element, no article text, reader comments and the like, paragraphs of its own]
        self.stack: list[list] = []
        self.names: Counter[str] = Counter()  # open elements by name
        self.off = 0
        self.articles = 0
        self.headers = 0  # of an article: only their headings are article text
        self.heading = self.link = False
        self._read(html)
        self._line()

    def _line(self) -> None:
        """End the current line."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text and (self.heading or not self.headers):
                self.texts.append(text)
                self.lengths.append(max(0, len(text) - self.linked))
                self.headings.append(self.heading)
                self.inside.append(self.articles > 0)
                for element in self.stack[:-NEAR:-1]:
                    if element[0] not in INNER:
                        element[3] += 1
                        break
            self.pieces = []
        self.linked = 0

    def _gap(self) -> None:
        """Empty lines, but not between the paragraphs of one element."""
        if self.articles or self.stack and self.stack[-1][3] and self.stack[-1][0] not in FRAME:
            return
        for _ in range(WINDOW):
            self.texts.append("")
            self.lengths.append(0)
            self.headings.append(False)
            self.inside.append(False)

    def _text(self, raw: str) -> None:
        if raw and not self.off:
            text = unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.link:
                self.linked += len(" ".join(text.split()))

    def _pop(self) -> None:
        name, off, _, _ = self.stack.pop()
        self.names[name] -= 1
        self.headers -= name == "header" and self.headers > 0
        self.off -= off
        self.articles -= name in ARTICLES
        if off:
            self._gap()

    def _open(self, name: str, attributes: str) -> None:
        block = name not in INLINE
        if block:
            self._line()
            self.link = False
            self.heading = name in HEADINGS
            if self.stack and (top := self.stack[-1][0]) in ("p", "li", "dt", "dd", "option", *HEADINGS) and (
                    top not in ("li", "dt", "dd") or name in ("li", "dt", "dd")):
                self._pop()  # elements whose end tag may be left out
        elif name == "br":
            self._text(" ")
        elif name == "a":
            self.link = True
        if name in VOID or name in FORMATS and not attributes:
            return
        marks = marks_of(attributes) if attributes else set()
        if name == "header" and self.articles:
            marks.discard("header")
        if name in ARTICLES and not marks & COMMENT_MARKS:
            # An unclosed menu or advert does not hide the article after it.
            while self.off and not any(element[2] for element in self.stack):
                self._pop()
        off = (name in BOILERPLATE and not (name == "header" and self.articles)
               or bool(marks and (name not in FRAME or marks & COMMENT_MARKS and name == "article"))
               or bool(attributes and _HIDDEN.search(attributes)))
        if name in FORMATS and not off:
            return
        if off:
            self._line()
            self._gap()
        self.stack.append([name, off, bool(marks & COMMENT_MARKS) or name == "aside", 0])
        self.names[name] += 1
        self.headers += name == "header" and (self.articles > 0 or self.headers > 0)
        self.off += off
        self.articles += name in ARTICLES

    def _close(self, name: str) -> None:
        if name == "a":
            self.link = False
        if name not in INLINE:
            self._line()
            self.heading = False
        if not self.names[name]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == name:
                while len(self.stack) > at:
                    self._pop()
                return
            if name in INLINE and self.stack[at][0] not in INLINE:
                return  # an inline end tag does not end a block

    def _read(self, html: str) -> None:
        at, end, last = 0, len(html), html.rfind(">")
        while at < end:
            if at > last:  # no tag is left; an open comment or declaration hides the rest
                self._text(_DECLARED.split(html[at:], maxsplit=1)[0])
                return
            found = _TOKEN.search(html, at)
            if found is None:
                self._text(html[at:])
                return
            self._text(html[at:found.start()])
            at = found.end()
            slash, name, attributes = found.group(1), found.group(2), found.group(3)
            if name is None:
                slash, name, attributes = found.group(4), found.group(5), found.group(6)
                if name is None:
                    if html.startswith("<![CDATA[", found.start()):
                        self._text(found.group()[9:].removesuffix("]]>"))
                    continue
            name = name.lower()
            if slash:
                self._close(name)
            elif name in RAW:
                if not attributes.endswith("/") or name in ("script", "style", "title", "textarea", "iframe"):
                    closing = _ENDS[name].search(html, at)
                    at = closing.end() if closing else end
            else:
                self._open(name, attributes)


def distribution(lengths: list[int], window: int = WINDOW) -> list[int]:
    """The sum of ``lengths`` over the ``window`` lines that start at each line."""
    sums, total = [0] * len(lengths), 0
    for i in range(len(lengths) - 1, -1, -1):
        total += lengths[i] - (lengths[i + window] if i + window < len(lengths) else 0)
        sums[i] = total
    return sums


def stretches(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first line, line after the last) of each stretch between a surge and a dive."""
    sums = distribution(lengths, window)
    level = min(surge, max(sums, default=0))
    out, i = [], 0
    while level and i < len(sums):
        if lengths[i] and sums[i] >= level:
            start, end = i, i
            while start and lengths[start - 1]:
                start -= 1
            while end < len(sums) and sums[end]:
                end += 1
            out.append((start, end))
            i = end
        i += 1
    return out


def main_text(html: str) -> str:
    """The main text of a page: its blocks in page order, joined by an empty line."""
    lines = Lines(html)
    if structured := any(t and a for t, a in zip(lines.texts, lines.inside)):
        lengths = [len(t) if a else 0 for t, a in zip(lines.texts, lines.inside)]
    else:
        lengths = lines.lengths
    kept = []
    for a, b in stretches(lengths):
        while not structured and a < b - 1 and not lines.headings[a] and lengths[a] < SHORT:
            a += 1
        while b > a and (not lengths[b - 1] or not structured and _OWNER.match(lines.texts[b - 1])):
            b -= 1
        kept += [t for t, own in zip(lines.texts[a:b], lines.inside[a:b]) if t and (own or not structured)]
    return "\n\n".join(kept)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; a scan without a shuffle."""
    ship_package(pages.sparkSession)
    source = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                          F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    types = {f.name: f.dataType.simpleString() for f in source.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
