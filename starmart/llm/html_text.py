"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams a page as events. Events become lines: a
block element or a line break begins a new one. Every line knows its text
(character references decoded, white space as one space), how many tags and how
much link text it has, and the element it stands in.

1. Lines of navigation, headers, footers, asides, menus, forms, scripts, styles
   and the like are no candidates, nor those of elements whose class, id or
   role names an advert, a notice, a sidebar, reader comments and so on
   (``HINTS``). An element that wraps an article is none of these, unless it
   holds comments or is an aside. The headings in an article's own header stay.
2. A candidate's ratio is its text outside links over its tags. Ratios are
   smoothed with a Gaussian over neighbouring lines, and their logarithms fall
   into two clusters (two means in one dimension); the threshold between them
   picks content lines.
3. The content region is the page's article (or main) element; of several, the
   one with most content, if that is at least half. Otherwise it is the deepest
   element with four fifths of the picked text, from the first picked line to
   the last and whatever shares an element with one; mere link lists outside
   such elements go. All candidates of the region are the text, however short,
   joined by one space in page order.

A null or empty page, and one without text, gives an empty text. Text without
any markup is one line and is kept. If names of classes leave no line at all,
they are ignored. Unclosed and crossing tags, broken declarations and bytes
that are not UTF-8 don't fail. Pages of any length go through whole, one at a
time. Repeated rows each give a row; an empty table gives an empty result;
columns other than id, url and html are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, lean, ship

SIGMA, RADIUS, SHARE, MOST = 1.0, 3, 0.8, 0.5

# Fixed lists: element names of HTML.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNSEEN = frozenset("script style noscript template svg iframe object canvas audio video map head title select button textarea label legend fieldset datalist".split())
AROUND = frozenset("nav header footer aside menu form dialog".split())
STRUCTURE = frozenset("html body div section article main center td".split())
INNER = frozenset("p pre blockquote address ul ol li dl dt dd table caption thead tbody tfoot tr th figure figcaption details summary hgroup".split()) | HEADINGS
ELEMENTS = UNSEEN | AROUND | STRUCTURE | INNER
BREAKS = frozenset(("br", "hr"))
#: What an opening tag ends: elements of these names inside the nearest of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

COMMENTS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
HINTS = COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login sidebar complementary menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer contentinfo masthead "
    "related recommended recommendations share sharing social search toolbar skip copyright".split())
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def hinted(attrs) -> str:
    """'comments', 'hint', 'header' or '' by the names in class, id and role."""
    words = {w.lower() for name, value in attrs if name in ("class", "id", "role") and value for w in TOKEN.findall(value)}
    return "comments" if words & COMMENTS else "hint" if words & HINTS else "header" if "header" in words else ""


class Lines(HTMLParser):
    """The lines of a page, and its elements: parent, name and hint of each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.name, self.hint = [-1], ["html"], [""]
        self.stack = [0]
        self.n_open = Counter()
        self.text, self.tags, self.linked, self.at = [], [], [], []  # by line
        self._new()
        self.link = 0  # depth of the stack in which a link is open

    def _new(self):
        self.data, self.n_tags, self.n_linked = [], 0, 0

    def line(self):
        text = " ".join("".join(self.data).split())
        if text:
            self.text.append(text)
            self.tags.append(self.n_tags)
            self.linked.append(self.n_linked)
            self.at.append(self.stack[-1])
            self._new()
        else:
            self.data = []

    def pop(self, to: int):
        self.line()
        self.n_open.subtract(self.name[k] for k in self.stack[to:])
        del self.stack[to:]
        if self.link > len(self.stack):
            self.link = 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link = len(self.stack)
        if tag in BREAKS:
            self.line()
        elif tag in ELEMENTS:
            self.line()
            if tag not in UNSEEN and self.name[self.stack[-1]] == "p":
                self.pop(len(self.stack) - 1)
            elif tag in ENDS:
                ended, within = ENDS[tag]
                if any(self.n_open[t] > 0 for t in ended):
                    for k in range(len(self.stack) - 1, 0, -1):
                        if self.name[self.stack[k]] in within:
                            break
                        if self.name[self.stack[k]] in ended:
                            self.pop(k)
                            break
            elif tag == "body":
                self.handle_endtag("head")
            if tag in ("html", "body") and self.n_open[tag] > 0:
                return
            self.n_open[tag] += 1
            self.parent.append(self.stack[-1])
            self.name.append(tag)
            self.hint.append("" if tag in ("html", "body", "main", "article") and (h := hinted(attrs)) != "comments" else hinted(attrs))
            self.stack.append(len(self.name) - 1)
        self.n_tags += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.n_tags += 1
        if tag == "a":
            self.link = 0
        elif self.n_open[tag] > 0:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.name[self.stack[k]] == tag:
                    self.pop(k)
                    break

    def handle_data(self, data):
        self.data.append(data)
        if self.link:
            self.n_linked += len(data.strip())

    def parse_marked_section(self, i, report=1):
        """A broken ``<![`` ends at the next ``>``."""
        j = self.rawdata.find(">", i)
        return j + 1 if j >= 0 else -1


def parsed(html: str) -> Lines:
    page = Lines()
    page.feed(html)
    if page.rawdata.startswith("<!--"):  # a comment without an end
        page.rawdata = ""
    page.close()
    page.line()
    return page


def smoothed(ratio: np.ndarray) -> np.ndarray:
    k = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratio, RADIUS, mode="edge"), k / k.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """Midway between the means of the two clusters of some numbers; the least number if all are alike."""
    low, high = values.min(), values.max()
    while low < high:
        cut = (low + high) / 2
        upper = values >= cut
        now = values[~upper].mean(), values[upper].mean()
        if now == (low, high):
            return cut
        low, high = now
    return low


def candidates(page: Lines, hints: bool) -> np.ndarray:
    """Which lines stand in no element that is set aside."""
    n = len(page.name)
    article, wraps, aside = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    gone, in_article, in_header = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    own = [h if hints else "" for h in page.hint]
    for k in range(1, n):  # a parent comes before its children
        up = page.parent[k]
        aside[k] = aside[up] or page.name[k] == "aside" or own[k] == "comments"
        article[k] = page.name[k] in ("article", "main") and not aside[k]
    for k in range(n - 1, 0, -1):
        wraps[page.parent[k]] |= wraps[k] or article[k]
    for k in range(1, n):
        up = page.parent[k]
        in_article[k] = in_article[up] or article[k]
        set_aside = page.name[k] in UNSEEN or (page.name[k] == "aside" or own[k] == "comments") or ((page.name[k] in AROUND or own[k] != "") and not wraps[k])
        header = page.name[k] == "header" or own[k] == "header"
        in_header[k] = in_header[up] or (header and in_article[k])
        gone[k] = gone[up] or (set_aside and not (header and in_article[k]))
    heading = np.array([page.name[k] in HEADINGS for k in page.at], bool)
    at = np.array(page.at, np.int64)
    return ~gone[at] & (~in_header[at] | heading)


def _home(page: Lines) -> list[int]:
    """Nearest element of structure of each element."""
    home = [0] * len(page.name)
    for k in range(1, len(home)):
        home[k] = k if page.name[k] in STRUCTURE else home[page.parent[k]]
    return home


def main_text(html: str) -> str:
    page = parsed(html)
    if not page.text:
        return ""
    live = candidates(page, True)
    if not live.any():
        live = candidates(page, False)
        if not live.any():
            return ""
    size = np.array([len(t) for t in page.text])
    linked = np.minimum(np.array(page.linked), size)
    ratio = np.where(live, (size - linked) / np.maximum(1, page.tags), 0.0)
    score = np.log1p(smoothed(ratio))
    picked = live & (score >= threshold(score[live])) & (ratio > 0)
    if not picked.any():
        picked = live
    # text below each element: picked, and of all candidates
    n = len(page.name)
    mass, most, whole = np.zeros(n), np.zeros(n), size[live].sum()
    np.add.at(mass, np.array(page.at)[picked], size[picked])
    np.add.at(most, np.array(page.at)[live], size[live])
    for k in range(n - 1, 0, -1):
        mass[page.parent[k]] += mass[k]
        most[page.parent[k]] += most[k]
    articles = [k for k in range(1, n) if page.name[k] in ("article", "main") and most[k] > 0]
    inner = [k for k in articles if page.name[k] == "article"] or articles
    within = _inside(page, set(inner))
    inner = [k for k in inner if not within[page.parent[k]]]
    best = max(inner, key=lambda k: (most[k], -k), default=0)
    if best and (len(inner) == 1 or most[best] >= MOST * whole):
        inside = _inside(page, {best})
        return " ".join(t for t, ok, k in zip(page.text, live, page.at) if ok and inside[k])
    # a child with four fifths of all is the only one
    heavy = {page.parent[k]: k for k in range(1, n) if mass[k] >= SHARE * mass[0] and page.name[k] not in INNER}
    region = 0
    while region in heavy:
        region = heavy[region]
    inside, home = _inside(page, {region}), _home(page)
    homes = {home[k] for k, ok in zip(page.at, picked) if ok}
    lines = np.flatnonzero(picked)
    out = []
    for i in np.flatnonzero(live):
        k = page.at[i]
        if inside[k] and (home[k] in homes or (lines[0] <= i <= lines[-1] and 2 * linked[i] <= size[i])):
            out.append(page.text[i])
    return " ".join(out)


def _inside(page: Lines, of: set) -> np.ndarray:
    """Which elements are, or stand in, some element of a set."""
    inside = np.zeros(len(page.name), bool)
    for k in range(len(inside)):
        inside[k] = k in of or (k > 0 and inside[page.parent[k]])
    return inside


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").cast("binary").alias("html"))
    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            out = [main_text((h.as_py() or b"").decode("utf-8", "replace")) for h in b.column(2)]
            yield batch_of(arrow, [b.column(0), b.column(1), out, [len(t) for t in out]])

    return rows.mapInArrow(lean(run), schema)
