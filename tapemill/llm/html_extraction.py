"""Main text of a web page by the distribution of text over its lines.

Markup is stripped, block-level tags end a line. A line's length is that of its text outside links; it is 0 in
elements that are no article text by their tag or by a word of their class, id or role, and, where the page
marks an article, outside of it. Lengths are summed over sliding windows of lines. Text surges where the sums
rise from nothing to SURGE and dives where they fall back to nothing; the lines with text between a surge and
its dive are a passage. Passages in one container that are parted only by elements left out are one; text that
stands in no element such as `body` or `div` has no container. Kept are the longest passage and those at least
SHARE as long; in a marked article, every line that is not in an element left out.

Defined cases: a null or empty page, or one without text, gives an empty text. Character references are
decoded, white space within a line becomes one space, lines are joined by an empty line. An element that is
left out ends at its end tag, at the end of one around it, or where an article begins; a page may stop
anywhere, also within a tag or comment, which then is no text. Repeated rows are extracted each; other columns
are ignored, so their names cannot clash.
"""

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from tapemill.llm.common import bound_batches

WINDOW = 3
SURGE = 40
SHARE = 0.3

# Elements of HTML by their part in a page.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed"}
_LEFT_OUT = {
    *{"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "button", "select", "label", "fieldset"},
    *{"svg", "canvas", "object", "video", "audio", "map", "datalist", "math"},
}
_VOID = {
    *{"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
}
_INLINE = {
    *{"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i"},
    *{"img", "ins", "kbd", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong"},
    *{"sub", "sup", "time", "tt", "u", "var", "wbr"},
}
_ARTICLE = {"article", "main"}
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|side-?bar|footer|header|masthead"
    r"|breadcrumbs?|cookies?|consent|notices?|popup|modal|newsletter|subscribe|share|sharing|social|related"
    r"|comments?|comment-?list|replies|reply|disqus|login|signup|search|pagination|pager|toolbar|widget|copyright"
    r"|navigation|contentinfo|complementary)(?:$|[\s_-])",
    re.IGNORECASE,
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^'\">]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


class _Page:
    """Lines of a page as (text, length outside links, inside an article, number of the container)."""

    def __init__(self, html: str, names: bool = True):
        """`names`: whether class, id and role can mark an element as no article text."""
        self.names = names
        self.lines: list[tuple[str, int, bool, int]] = []
        self.text: list[str] = []
        self.linked = 0
        # Open elements that matter, as (tag, is left out), and the numbers of those that hold blocks.
        self.open: list[tuple[str, bool]] = []
        self.containers = [0]
        self.articles = self.skipped = self.links = self.numbered = 0
        at = 0
        while match := _TOKEN.search(html, at):
            self._add_text(html[at : match.start()])
            at = match.end()
            tag = (match["tag"] or "").lower()
            if tag and match["end"]:
                self._end(tag)
            elif tag in _RAW:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE)
                end = closing.search(html, at)
                at = end.end() if end else len(html)
                self._break()
            elif tag:
                self._start(tag, match["attributes"])
        self._add_text(html[at:])
        self._break()

    def _add_text(self, raw: str) -> None:
        if raw:
            self.text.append(raw)
            if self.links:
                self.linked += len(raw.strip())

    def _break(self) -> None:
        text = " ".join(unescape("".join(self.text)).split())
        length = 0 if self.skipped else max(0, len(text) - self.linked)
        # A line left out stands for several empty ones: no window reaches across it.
        if self.skipped:
            self.lines += [("", 0, False, 0)] * WINDOW
        elif text:
            self.lines.append((text, length, self.articles > 0, self.containers[-1]))
        self.text, self.linked = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE:
            self._break()
        elif tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            return
        noisy = self.names and tag not in {"html", "body"} and self._noisy(attributes)
        if tag in _ARTICLE and not noisy:
            # An element left open before the article does not swallow it.
            while self.skipped and not self.articles:
                self._close()
        left_out = tag in _LEFT_OUT and not (tag == "header" and self.articles) or noisy
        if tag in _ARTICLE and not left_out and not self.skipped:
            self.articles += 1
        elif not left_out and tag not in {"a", "div", "section", "body", "table", "ul", "ol", "td", "li", *_ARTICLE}:
            return
        elif tag in _ARTICLE:
            left_out = True
        self.open.append((tag, left_out))
        self.skipped += left_out
        self.links += tag == "a"
        if tag != "a":
            self.numbered += 1
            self.containers.append(self.numbered)

    @staticmethod
    def _noisy(attributes: str) -> bool:
        return bool(attributes) and any(_NOISE.search("".join(found)) for found in _NAMED.findall(attributes))

    def _end(self, tag: str) -> None:
        if tag not in _INLINE:
            self._break()
        if any(name == tag for name, _ in self.open):
            while self._close() != tag:
                pass

    def _close(self) -> str:
        tag, left_out = self.open.pop()
        self.skipped -= left_out
        self.links -= tag == "a"
        if tag != "a":
            self.containers.pop()
        if tag in _ARTICLE and not left_out:
            self.articles -= 1
        return tag


def _passages(lines: list[tuple[str, int, bool, int]], least: int) -> list[range]:
    """Ranges of lines between a surge and the next dive of the window sums, joined if they belong together."""
    lengths = [length for _, length, _, _ in lines]
    totals = [0, *accumulate(lengths)]
    n = len(lengths)
    # The window that ends with a line, and the one that begins with it.
    behind = [totals[i + 1] - totals[max(0, i + 1 - WINDOW)] for i in range(n)]
    ahead = [totals[min(n, i + WINDOW)] - totals[i] for i in range(n)]
    found: list[tuple[range, int]] = []
    start = None
    for i in range(n + 1):
        alive = i < n and behind[i] > 0 and ahead[i] > 0
        if alive and start is None:
            start = i
        elif not alive and start is not None:
            passage, height = range(start, i), max(ahead[start:i])
            start = None
            # Windows from both sides of a gap may meet on a line within it, which is no passage.
            if not any(lengths[passage.start : i]):
                continue
            if found and _belong(lines, found[-1][0], passage):
                before, higher = found.pop()
                passage, height = range(before.start, i), max(height, higher)
            found.append((passage, height))
    return [passage for passage, height in found if height >= least]


def _belong(lines: list[tuple[str, int, bool, int]], before: range, after: range) -> bool:
    """Whether two passages lie in one container with nothing but left-out elements between them."""
    container = lines[after.start][3]
    between = any(lines[i][0] for i in range(before.stop, after.start))
    return container > 0 and container == lines[before.stop - 1][3] and not between


def main_text(html: str) -> str:
    """The main text of a whole page."""
    lines = _Page(html).lines
    if not any(length for _, length, _, _ in lines):
        # Its names may be about the whole page, such as a class for a layout with a sidebar.
        lines = _Page(html, names=False).lines
    if any(length for _, length, inside, _ in lines if inside):
        return "\n\n".join(text for text, _, inside, _ in lines if inside)
    passages = _passages(lines, SURGE) or _passages(lines, 1)
    sizes = [sum(lines[i][1] for i in passage) for passage in passages]
    least = SHARE * max(sizes, default=0)
    kept = (i for passage, size in zip(passages, sizes, strict=True) if size >= least for i in passage)
    return "\n\n".join(lines[i][0] for i in kept if lines[i][0])


def extract_text(html: Column) -> Column:
    """Main text of each page; empty where there is none."""

    bound_batches()

    @pandas_udf(StringType())
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(page or "") for page in pages], dtype=object)

    return extract(html)
