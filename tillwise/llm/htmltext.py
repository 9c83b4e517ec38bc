"""Main text of web pages by text-to-tag ratios over a streaming parse.

The standard library's parser hands over tags and text as it meets them. A line is what stands between two
boundaries of block elements; it knows its text, its element and how many tags led to it. Then, per page:

1. Lines below an element that is no article by its kind (menus, page headers and footers, sidebars, forms, scripts,
   and whatever its role, class or id calls an advert, a notice, a comment and so on) are set aside.
2. Every line has its text-to-tag ratio: characters outside links over tags. The ratios (as logarithms, since one long
   paragraph would dwarf the others) are smoothed over the neighbouring lines by a Gaussian kernel, and two-means
   clustering puts a threshold between high and low. Lines above it are the content regions.
3. Regions lie in a container: the deepest element that holds nearly all their text, ``article`` and ``main`` first
   where a page has them. Its short lines belong to the text like its long ones, so the whole container is given; in a
   container without a name of its own, parts without a region go if they consist of links or lie outside the regions.

Defined results: a null page and a page without text outside the parts set aside give an empty text; unclosed, stray and
misnested tags are taken as browsers take them; repeated rows and ids are extracted each; a very long page is fed to
the parser in pieces; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.text import small_batches, table

SIGMA = 1.5  # of the smoothing, in lines
MOST = 0.9  # of the regions' text that a container holds
_FEED = 1 << 20

# Kinds of elements as the HTML standard has them.
VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base head link meta noscript script style template title".split())
# A start tag ends these open elements, up to the element that holds the list, row or table.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}

TABLE = frozenset("table thead tbody tfoot tr td th caption html body".split())
CELLS = frozenset("td th caption button object".split())

# What is never article text, whatever stands in it.
SILENT = frozenset(
    "audio button canvas datalist dialog embed head iframe input map noscript object script select style svg template "
    "textarea title video".split()
)
ASIDE = frozenset("aside footer menu nav search".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog menu menubar navigation search status toolbar".split()
)
_NAMED = re.compile(
    r"(ads?|adv|adbox|adslot|adsense|advert\w*|sponsor\w*|promos?|promotions?|banners?|nav|navbar|navigation|menus?|"
    r"breadcrumbs?|sidebars?|footers?|masthead|topbar|cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|modals?|"
    r"overlays?|newsletters?|subscribe|subscription|signup|signin|login|share|sharing|sharebar|socials?|comments?|"
    r"commentlist|commentary|disqus|respond|replies|related|recommended|recommendations|widgets?|pagination|pager|toolbar|"
    r"skiplinks?|copyright)"
)
_REPLY = re.compile(r"comments?|commentlist|disqus|respond|reply|replies")
_CARD = re.compile(r"comments?|reply|replies|related|recommended|ads?|advert\w*|sponsor\w*|promos?")
_HEADER = re.compile(r"(site|page|top|main|global)?header")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# Names that speak of the page around the element, such as has-sidebar or no-comments.
_ABOUT = re.compile(r"(has|no|with|without|is|hide|show)[-_]")


def _names(attrs: dict[str, str]) -> list[list[str]]:
    """The words of every class and of the id, but of names that speak of something else."""
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return [[w.lower() for w in _WORD.findall(n)] for n in names if not _ABOUT.match(n.lower())]


def _called_aside(tag: str, attrs: dict[str, str]) -> bool:
    """Whether role, class or id say that an element is no part of the article."""
    if tag in ("html", "body", "main"):
        return False
    names = _names(attrs)
    if tag == "article":  # of these only what is another one's comment or a teaser
        return any(words and _CARD.fullmatch(words[0]) for words in names)
    if attrs.get("role", "").strip().lower() in ROLES:
        return True
    return any(any(map(_NAMED.fullmatch, words)) or _HEADER.fullmatch("".join(words)) for words in names)


class Page(HTMLParser):
    """Elements and lines of one page, gathered from the parser's events.

    ``parent``, ``tag``, ``block`` (the innermost block element) and the flags have one entry per element in page
    order, so a parent's number is below its children's. Text in a silent element, or in an inline one called an advert or
    so, is not kept.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.block = [-1], ["#page"], [0]
        self.called, self.replies, self.main = [False], [False], [False]
        self.texts, self.owners, self.tags, self.linked = [], [], [], []
        self._stack, self._open = [0], {}
        self._parts, self._owner, self._seen, self._link, self._muted = [], None, 0, 0, []
        for at in range(0, len(html), _FEED):
            self.feed(html[at : at + _FEED])
        self.close()
        self._break()

    # ---- events

    def handle_starttag(self, tag: str, attrs) -> None:
        if "head" in self._open and tag not in IN_HEAD:
            self._leave("head")
        if tag in BLOCKS:
            self._break()
            if "p" in self._open:
                self._leave_above("p", CELLS)
            for names, stops in [CLOSES[tag]] if tag in CLOSES else []:
                self._leave_all(names, stops)
        elif tag == "br":
            self._parts.append(" ")
        self._seen += 1
        if tag not in VOID:
            self._enter(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag: str, attrs) -> None:
        # a slash closes nothing but void elements
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._break()
        self._seen += 1
        if tag not in self._open:
            return
        if tag in BLOCKS:
            self._leave_above(tag, set() if tag in TABLE else CELLS)
        else:
            self._leave_above(tag, BLOCKS)

    def handle_data(self, data: str) -> None:
        blank = not data.strip()
        if not blank and self.tag[self._stack[-1]] == "head":
            self._leave("head")
        if self._muted:
            return
        if self._owner is None and not blank:
            self._owner = self.block[self._stack[-1]]
        self._parts.append(data)
        if "a" in self._open:
            self._link += len(data.strip())

    def parse_html_declaration(self, i: int) -> int:
        # conditional and unknown sections are comments, as in browsers
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    # ---- open elements

    def _enter(self, tag: str, attrs: dict[str, str]) -> None:
        self._stack.append(len(self.tag))
        self._open[tag] = self._open.get(tag, 0) + 1
        self.parent.append(self._stack[-2])
        self.tag.append(tag)
        self.block.append(self._stack[-1] if tag in BLOCKS else self.block[self._stack[-2]])
        self.called.append(_called_aside(tag, attrs))
        self.replies.append(self.called[-1] and any(any(map(_REPLY.fullmatch, words)) for words in _names(attrs)))
        if tag in SILENT or self.called[-1] and tag not in BLOCKS:
            self._muted.append(self._stack[-1])
        body = attrs.get("role", "").lower() == "main" or "articlebody" in attrs.get("itemprop", "").lower()
        self.main.append(tag in ("article", "main") or body)

    def _pop(self) -> str:
        at = self._stack.pop()
        tag = self.tag[at]
        if self._muted and self._muted[-1] == at:
            self._muted.pop()
        self._open[tag] -= 1
        if not self._open[tag]:
            del self._open[tag]
        return tag

    def _leave(self, tag: str) -> None:
        """Close the innermost ``tag``, which is open, and all within it."""
        while self._pop() != tag:
            pass

    def _leave_above(self, tag: str, stops: frozenset[str] | set[str]) -> None:
        """Close the innermost ``tag`` unless one of ``stops`` lies within it."""
        for at in reversed(self._stack):
            if self.tag[at] == tag:
                self._leave(tag)
                return
            if self.tag[at] in stops:
                return

    def _leave_all(self, names: set[str], stops: set[str]) -> None:
        if not any(n in self._open for n in names):
            return
        depth = None
        for i in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[i]] in stops:
                break
            if self.tag[self._stack[i]] in names:
                depth = i
        while depth is not None and len(self._stack) > depth:
            self._pop()

    def _break(self) -> None:
        """End the line."""
        text = " ".join("".join(self._parts).split())
        if text:
            self.texts.append(text)
            self.owners.append(self._owner)
            self.tags.append(max(self._seen, 1))
            self.linked.append(min(self._link, len(text)))
            self._seen = 0
        self._parts, self._owner, self._link = [], None, 0


def _sums(page: Page, values) -> np.ndarray:
    """Values of lines added up over each element and all in it."""
    out = np.zeros(len(page.tag))
    np.add.at(out, page.owners, values)
    for e in range(len(out) - 1, 0, -1):
        out[page.parent[e]] += out[e]
    return out


def set_aside(page: Page) -> list[bool]:
    """For each element, whether it or one around it is no part of the article."""
    count = len(page.tag)
    holds_main, holds_title = [False] * count, [False] * count
    for e in range(count - 1, 0, -1):
        own = page.main[e] and not page.called[e]
        holds_main[page.parent[e]] |= own or holds_main[e]
        holds_title[page.parent[e]] |= page.tag[e] == "h1" or holds_title[e]
    words = _sums(page, [len(t) for t in page.texts])
    out, in_main = [False] * count, [False] * count
    for e in range(1, count):
        tag, up = page.tag[e], page.parent[e]
        own = tag in SILENT or tag in ASIDE
        if tag == "header":  # a page's own, not an article's
            own = not in_main[up] and not holds_main[e]
        elif tag == "form":  # unless the page stands in one
            own = not holds_main[e] and words[e] * 2 < words[0]
        if page.called[e] and not own:
            # a wrapper may be called after what stands beside the article
            most = words[e] * 2 > words[0] and (holds_title[e] or not page.replies[e])
            own = not (holds_main[e] or most)
        out[e] = out[up] or own
        in_main[e] = in_main[up] or page.main[e]
    return out


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means over neighbouring lines; at the ends over those there are."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(values, kernel)[reach : reach + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]


def threshold(values: np.ndarray) -> float:
    """Middle between the means of the low and the high cluster; the only value where all are equal."""
    low, high = float(values.min()), float(values.max())
    for _ in range(100):
        cut = (low + high) / 2
        under, over = values[values < cut], values[values >= cut]
        new = (float(under.mean()) if len(under) else low, float(over.mean()) if len(over) else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def regions(page: Page, aside: list[bool]) -> np.ndarray:
    """Whether each line is above the threshold of the smoothed ratios."""
    kept = np.array([not aside[o] for o in page.owners], dtype=bool)
    if not kept.any():
        return kept
    chars = np.array([len(t) for t in page.texts], dtype=float) - np.array(page.linked)
    ratio = np.where(kept, np.log1p(chars / np.array(page.tags)), 0.0)
    score = smoothed(ratio)
    linked = np.array(page.linked) * 2 > np.array([len(t) for t in page.texts])
    high = kept & (score >= threshold(score[kept]))
    high = high & ~linked if (high & ~linked).any() else high
    # where an article is marked as such, regions are those in it
    named = [False] * len(page.tag)
    for e in range(1, len(named)):
        named[e] = named[page.parent[e]] or (page.main[e] and not aside[e])
    inside = kept & np.array([named[o] for o in page.owners], dtype=bool)
    if inside.any():
        return high & inside if (high & inside).any() else inside
    return high


def container(page: Page, aside: list[bool], high: np.ndarray, children: dict[int, list[int]]) -> int:
    """The deepest element that holds nearly all the regions' text."""
    mass = _sums(page, np.where(high, [len(t) for t in page.texts], 0))
    titled = {page.parent[o] for o in page.owners if page.tag[o] == "h1" and not aside[o]}
    at = 0
    while True:
        best = max(children.get(at, []), key=lambda c: mass[c], default=None)
        if best is None or mass[best] < MOST * mass[0] or page.tag[best] not in BLOCKS or page.tag[best] in HEADINGS | {"p"}:
            return at
        if at in titled or page.main[at] and not page.main[best]:
            return at
        at = best


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, one a line."""
    page = Page(html or "")
    aside = set_aside(page)
    high = regions(page, aside)
    if not high.any():
        return ""
    children: dict[int, list[int]] = {}
    for e in range(1, len(page.tag)):
        children.setdefault(page.parent[e], []).append(e)
    top = container(page, aside, high, children)
    # of every element, the child of the container that it is or lies in
    part = [-1] * len(page.tag)
    for e in range(len(part)):
        part[e] = e if e == top or (e and page.parent[e] == top) else part[page.parent[e]] if e else -1
    kept = [i for i, o in enumerate(page.owners) if part[o] >= 0 and not aside[o]]
    if not page.main[top]:
        kept = _trimmed(page, kept, high, part)
    return "\n".join(page.texts[i] for i in kept)


def _trimmed(page: Page, kept: list[int], high: np.ndarray, part: list[int]) -> list[int]:
    """Lines of a container that is not marked as the article: without parts that hold no region and are links or outside."""
    found = [i for i in kept if high[i]]
    first, last = found[0], found[-1]
    with_region = {part[page.owners[i]] for i in found}
    chars, linked = {}, {}
    for i in kept:
        p = part[page.owners[i]]
        chars[p], linked[p] = chars.get(p, 0) + len(page.texts[i]), linked.get(p, 0) + page.linked[i]
    # the nearest main heading in front belongs to the text, with what follows it
    titles = [i for i in kept if i < first and page.tag[page.owners[i]] == "h1"]
    start = titles[-1] if titles else first
    beside = page.parent[page.owners[last]]

    def belongs(i: int) -> bool:
        owner = page.owners[i]
        if part[owner] in with_region:
            return True
        if linked[part[owner]] * 2 > chars[part[owner]] or i < start:
            return False
        return i <= last or page.parent[owner] == beside and page.tag[owner] in HEADINGS | {"p", "blockquote", "pre"}

    return [i for i in kept if belongs(i)]


@F.pandas_udf(T.StringType())
def main_texts(htmls: pd.Series) -> pd.Series:
    return pd.Series([main_text(h) for h in htmls], dtype="object")


def extracted(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` in a column of its own, which replaces one of that name."""
    small_batches(pages.sparkSession)
    return pages.withColumn(into, main_texts(html))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    pages = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
