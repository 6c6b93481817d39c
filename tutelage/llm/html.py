"""Main text of pages from parser events and the text-to-tag ratio of their lines.

The standard library's parser streams events; every block of text is a line with the number of tags met since the last one.
The ratios of characters to tags are smoothed by a Gaussian over neighbouring lines and split by a threshold
between two clusters. A region (an article, or else the innermost container) with a line above the threshold that is not mostly
links is content, and all of its lines are kept, short ones too. Elements that by name, role, class or id are not part of an article
(menus, headers, footers, asides, forms, adverts, notices, comments, scripts) never are; an article that
starts while such an element is still open ends it.

Defined cases: a null or empty page has an empty text; broken and unclosed markup is read as far as it goes; text
without any tag is one line and content; repeated rows are each extracted; null urls stay null; other columns
are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import batched, utf8

#: Width of the smoothing, in lines; least ratio of the clusters' centres to be two clusters at all.
SIGMA, APART = 1.0, 2.0

SILENT = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "select", "textarea", "button", "canvas", "audio", "video"}
APART_BY_NAME = {"nav", "footer", "aside", "form", "dialog", "menu"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "th", "table", "ul", "ol", "dl", "blockquote", "figure", "header", "center"}
BLOCKS = CONTAINERS | APART_BY_NAME | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "pre", "hr", "figcaption", "address", "fieldset", "legend", "caption", "summary", "details", "html"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"}
HINTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promoted", "banner", "cookie", "cookies", "consent",
         "gdpr", "notice", "notices", "notification", "alert", "sidebar", "sidenav", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
         "masthead", "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe",
         "signup", "login", "popup", "modal", "widget", "pagination", "pager", "toolbar", "skip"}
#: What a start tag closes if it is still open, and where the search for it ends: elements whose end tags may be left out.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: A paragraph ends where one of these begins.
ENDS_P = BLOCKS - {"td", "th", "tr", "html", "body", "caption", "legend", "summary"}
_TOKENS = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")


class Lines(HTMLParser):
    """The lines of a page: text, tags before and in it, region, whether it is set apart, and whether most of it is links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, bool]] = []
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, region, silent, set apart
        self.text: list[str] = []
        self.tags = self.regions = self.articles = self.linked = 0
        self.link = False
        self.names: Counter[str] = Counter()  # open elements by name, so that an end tag without one costs nothing

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not wanted."""
        return j

    def state(self) -> tuple[str, int, bool, bool]:
        return self.open[-1] if self.open else ("", 0, False, False)

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, region, _, aside = self.state()
            self.lines.append((text, self.tags, region, aside, 2 * self.linked > len(text)))
            self.tags = 0
        self.text, self.linked = [], 0

    def aside(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in APART_BY_NAME or (tag == "header" and not self.articles):
            return True
        for name, value in attrs:
            value = (value or "").strip()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value.lower() in ROLES:
                return True
            if name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
            if name in ("class", "id") and tag not in ("html", "body", "article", "main") and HINTS & set(_TOKENS.sub(" ", value).lower().split()):
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.link = True
        if tag not in BLOCKS and tag not in SILENT:
            if tag not in VOID and self.aside(tag, attrs):
                self.push(tag, aside=True)
            return
        self.end_line()
        self.implied(tag)
        if tag in VOID:
            return
        if tag in ("body", "article", "main"):
            while self.open and (self.open[-1][2] or self.open[-1][3]) and not self.articles:
                self.cut(len(self.open) - 1)
        self.push(tag, tag in SILENT, self.aside(tag, attrs))

    def implied(self, tag: str) -> None:
        """Close what a start tag ends without an end tag: a paragraph before a block, an item before the next one."""
        closed, within = CLOSES.get(tag, ((), ()))
        if self.names["p"] and tag in ENDS_P:
            self.close_last({"p"}, CONTAINERS | APART_BY_NAME)
        if any(self.names[t] for t in closed):
            self.close_last(closed, within)

    def close_last(self, closed: set[str], within: set[str]) -> None:
        """Close the innermost of ``closed`` and what is open in it, unless one of ``within`` is further in."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in within:
                break
            if self.open[i][0] in closed:
                self.cut(i)
                break

    def cut(self, at: int) -> None:
        """Close the elements from ``at`` on."""
        for name, *_ in self.open[at:]:
            self.names[name] -= 1
            self.articles -= name in ("article", "main")
        del self.open[at:]

    def push(self, tag: str, silent: bool = False, aside: bool = False) -> None:
        _, region, was_silent, was_aside = self.state()
        if tag in CONTAINERS and not self.articles:
            self.regions += 1
            region = self.regions
        self.articles += tag in ("article", "main")
        self.names[tag] += 1
        self.open.append((tag, region, silent or was_silent, aside or was_aside))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.link = False
        if tag in BLOCKS:
            self.end_line()
        if not self.names[tag]:
            return
        at = next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag)
        self.end_line()
        self.cut(at)

    def handle_data(self, data: str) -> None:
        if not self.state()[2]:
            self.text.append(data)
            self.linked += len(data) if self.link else 0

    def close(self) -> None:
        super().close()
        self.end_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach:reach + len(ratios)] / weight


def threshold(ratios: np.ndarray) -> float:
    """Half-way between the centres of two clusters of the logarithms; zero if these are not apart."""
    x = np.sort(np.log1p(ratios))
    sums, low, high, at = np.cumsum(x), float(x[0]), float(x[-1]), 0
    while low < high:
        cut = int(x.searchsorted((low + high) / 2, side="right"))
        if cut in (0, at, len(x)):
            break
        at, low, high = cut, float(sums[cut - 1]) / cut, float(sums[-1] - sums[cut - 1]) / (len(x) - cut)
    return float(np.expm1((low + high) / 2)) if high - low > np.log(APART) else 0.0


def main_text(page: str) -> str:
    parser = Lines()
    parser.feed(page)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratios = smoothed(np.array([len(text) / max(1, tags) for text, tags, *_ in lines]))
    least = threshold(ratios)
    sizes: dict[int, int] = {}
    wanted = set()
    for (text, _, region, aside, linked), r in zip(lines, ratios, strict=True):
        if not aside:
            sizes[region] = sizes.get(region, 0) + len(text)
            if r >= least and not linked:
                wanted.add(region)
    if not wanted and sizes:
        wanted = {max(sizes, key=sizes.get)}
    return "\n\n".join(text for text, _, region, aside, _ in lines if region in wanted and not aside)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of every page."""
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h.decode("utf-8", "replace")) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return batched(pages.select("page_id", "url", utf8("html").alias("html")), run, schema)
