"""HTML extraction: parser events to lines, text-to-tag ratios, Gaussian smoothing, threshold clustering, content boxes.

The standard library's parser streams a page once. Block elements cut the page into lines; each line knows its text, its
tags, its linked text and the innermost container it stands in. Lines inside navigation, forms, adverts, comments and the
like are marked by their elements and never chosen.

The ratio of unlinked text to tags of the lines is smoothed with a Gaussian and split into two clusters, on every page. The
unlinked text of the lines in the upper cluster is the weight of the boxes around them (text inside article and main elements
counts `weight` times). From the page inwards, a box that holds nearly all of the weight (or, for an article or main, more
than half) takes its parent's place; an article is not gone into. The text is every unmarked line of the box so found, but
for containers of several lines that are links alone and stay in the lower cluster. Where no box inside stands out and
several articles hold the weight, it is the lines of these. A headline just before the box belongs to it.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Element and attribute names of HTML, and the words that sites name their boxes by.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("html body article main section div td th table nav header footer aside form ul ol dl blockquote figure".split())
CLOSES_P = BLOCKS - {"br"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEAD = frozenset("title meta link script style base noscript template".split())
NEVER = frozenset(
    "head title script style noscript template nav menu footer aside form button select textarea svg canvas iframe object dialog "
    "audio video map".split()
)
BOXES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup "
    "popup modal overlay comment comments commentlist disqus respond social share sharing related recommended widget pagination pager "
    "login search toolbar skip".split()
)
PAGE_HEADS = frozenset("header masthead topbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())


# What stands beside the words above in the names of boxes.
BESIDE = frozenset(
    "site page post posts article articles main global top bottom left right inner outer content section block box bar wrap wrapper "
    "container area list item items link links icon icons button buttons form field head title text sub mobile desktop header sticky "
    "fixed primary secondary slot unit message policy story stories news reader readers user".split()
)
BESIDE_PAGE = BESIDE - frozenset("post posts article articles content section story stories".split())
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def names(value: str, words: frozenset[str], beside: frozenset[str] = BESIDE) -> bool:
    """Is one of the names in a class or id a word of the list, or put together from such words and usual companions?"""
    for name in CAMEL.sub("-", value).lower().replace("_", "-").split():
        if name in words:
            return True
        parts = [p for p in name.split("-") if p.strip("0123456789x")]
        if any(p in words for p in parts) and all(p in words or p in beside for p in parts):
            return True
    return False


class Line:
    __slots__ = ("linked", "marked", "parts", "region", "tags", "title")

    def __init__(self, region: int, marked: bool, title: bool):
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0
        self.region = region
        self.marked = marked
        self.title = title


class Lines(HTMLParser):
    """Collects the lines of one page. The stack holds (tag, marked, region, in an article, in a link) of open elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, bool, bool]] = []
        self.lines: list[Line] = []
        self.parents = [0]  # of each region; region 0 is the page
        self.tags = [""]
        self.now: Line | None = None

    def marks(self, tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
        if tag in NEVER or (tag == "header" and not in_article):
            return True
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if not value:
                continue
            if name in ("class", "id"):
                if names(value, BOXES) or (not in_article and names(value, PAGE_HEADS, BESIDE_PAGE)):
                    return tag not in ("html", "body", "article", "main")
            elif name == "role" and value.lower() in ROLES:
                return True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def pop_to(self, tags: set[str], bounds: frozenset[str] | set[str]) -> None:
        """Close up to the nearest open element of tags, unless a bound stands before it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                del self.stack[i:]
                return
            if self.stack[i][0] in bounds:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or (tag not in HEAD and tag != "head" and tag != "html"):
            self.pop_to({"head"}, CONTAINERS)
        if tag in CLOSES_P:
            self.pop_to({"p"}, CONTAINERS)
        if tag in SIBLINGS:
            self.pop_to(SIBLINGS[tag], {"ul", "ol", "dl", "table", "select"})
        _, marked, region, in_article, linked = self.stack[-1] if self.stack else ("", False, 0, False, False)
        if tag in BLOCKS:
            self.now = None
        if tag in VOID:
            if self.now:
                self.now.tags += 1
            return
        marked = marked or self.marks(tag, attrs, in_article)
        if tag in CONTAINERS:
            self.parents.append(region)
            self.tags.append(tag)
            region = len(self.tags) - 1
            in_article = in_article or tag in ("article", "main")
        if marked and (not self.stack or not self.stack[-1][1]):
            self.now = None  # a marked inline element has lines of its own
        self.stack.append((tag, marked, region, in_article, linked or tag == "a"))
        if self.now:
            self.now.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.now = None
        was = bool(self.stack) and self.stack[-1][1]
        self.pop_to({tag}, () if tag in CONTAINERS else CONTAINERS)
        if was and not (self.stack and self.stack[-1][1]):
            self.now = None
        if self.now:
            self.now.tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("script", "style"):
            self.clear_cdata_mode()
        if tag not in VOID and tag in ("script", "style", "iframe", "textarea", "svg"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        _, marked, region, _, linked = self.stack[-1] if self.stack else ("", False, 0, False, False)
        if self.now is None:
            self.now = Line(region, marked, any(x[0] == "h1" for x in self.stack))
            self.lines.append(self.now)
        self.now.parts.append(data)
        if linked:
            self.now.linked += len(data.strip())


def smoothed(values: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing over neighbours within three sigma, weights summing to one inside the page."""
    reach = max(1, math.ceil(3 * sigma))
    share = [math.exp(-((d / sigma) ** 2) / 2) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        total = sum(share[abs(i - j)] for j in range(low, high))
        out.append(round(sum(values[j] * share[abs(i - j)] for j in range(low, high)) / total, 6))
    return out


def threshold(values: list[float]) -> float:
    """The cut between two clusters of numbers: the mean of the two clusters' means, from the extremes on. Equal numbers are
    one cluster, above the cut."""
    low, high = min(values), max(values)
    for _ in range(50):
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not below or not above:
            break
        new = sum(below) / len(below), sum(above) / len(above)
        if new == (low, high):
            break
        low, high = new
    return min((low + high) / 2, max(values))


NEARLY, HALF = 0.9, 0.5


def content_boxes(parents: list[int], tags: list[str], weights: list[float]) -> list[int]:
    """The regions whose lines are content. weights: of each region's own lines."""
    n = len(tags)
    children: list[list[int]] = [[] for _ in range(n)]
    total = list(weights)
    articled = [w if t == "article" else 0.0 for t, w in zip(tags, total)]  # the weight that lies in articles
    meant = [w if t in ("article", "main") else 0.0 for t, w in zip(tags, total)]
    for r in range(n - 1, 0, -1):  # a region's parent has a smaller number
        up = parents[r]
        children[up].append(r)
        total[up] += total[r]
        articled[up] += total[r] if tags[r] == "article" else articled[r]
        meant[up] += total[r] if tags[r] in ("article", "main") else meant[r]
    box, inside_main = 0, False
    while tags[box] != "article":
        def stands_out(r: int) -> bool:
            whole = total[box] > 0 and total[r] >= NEARLY * total[box]
            in_articles = articled[r] >= NEARLY * total[r] or tags[r] == "article"
            if inside_main:
                return whole and in_articles
            in_meant = meant[r] >= NEARLY * total[r] or tags[r] in ("article", "main")
            return whole or (in_meant and total[r] > HALF * total[box])

        found = [r for r in children[box] if stands_out(r)]
        if not found:
            break
        box = max(found, key=lambda r: (total[r], -r))
        inside_main = inside_main or tags[box] == "main"
    if tags[box] != "article" and not inside_main and total[box] > 0 and articled[box] >= NEARLY * total[box]:
        tops, todo = [], [box]
        while todo:
            r = todo.pop()
            if tags[r] == "article":
                if total[r] > 0:
                    tops.append(r)
            else:
                todo += children[r]
        return tops
    return [box]


def within(parents: list[int], boxes: list[int]) -> list[bool]:
    """For each region whether it lies in one of the boxes."""
    out = [False] * len(parents)
    for r in range(len(parents)):
        out[r] = r in boxes or (r > 0 and out[parents[r]])
    return out


def main_text(html: str, sigma: float = 1.0, weight: float = 2.0) -> str:
    """The main text of a page: chosen lines in page order, white space turned into one space, joined by one space."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = [(line, text) for line in parser.lines if (text := " ".join("".join(line.parts).split()))]
    if all(line.marked for line, _ in lines):
        return ""
    parents, tags = parser.parents, parser.tags
    free = [0 if line.marked else max(0, len(text) - line.linked) for line, text in lines]
    near = smoothed([f / max(1, line.tags) for f, (line, _) in zip(free, lines)], sigma)
    cut = threshold(near)
    up = [v >= cut for v in near]
    meant = within(parents, [r for r, t in enumerate(tags) if t in ("article", "main")])
    weights = [0.0] * len(tags)
    for (line, _), own, high in zip(lines, free, up):
        if high:
            weights[line.region] += own * (weight if meant[line.region] else 1.0)
    if not any(weights):  # links alone
        boxes = [r for r, t in enumerate(tags) if t in ("article", "main")]
        up = [True] * len(lines)
    else:
        boxes = content_boxes(parents, tags, weights)
    inside = within(parents, boxes)
    # a container of several lines that are links alone is a menu, unless its neighbours lift it
    counts, linked = [0] * len(tags), [0] * len(tags)
    for (line, _), own in zip(lines, free):
        counts[line.region] += not line.marked
        linked[line.region] += not line.marked and own == 0
    menu = [n > 1 and n == links for n, links in zip(counts, linked)]
    keep = [inside[line.region] and not line.marked and (not menu[line.region] or high or line.title) for (line, _), high in zip(lines, up)]
    first = keep.index(True) if True in keep else 0
    if not any(line.title for (line, _), kept in zip(lines, keep) if kept):
        for i in range(first - 1, -1, -1):
            if lines[i][0].title and not lines[i][0].marked:
                keep[i] = True
                break
    return " ".join(text for (_, text), kept in zip(lines, keep) if kept)


def extract(df: DataFrame, key: str = "page_id", html: str = "html", url: str = "url", sigma: float = 1.0, weight: float = 2.0) -> DataFrame:
    """page_id, url, text, n_chars of each row. Null and empty pages give an empty text; repeated rows one row each; an
    empty table no rows. Pages of any length are parsed in whole, one by one, in the partitions they are read in; columns
    of df other than these three aren't read."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        for batch in batches:
            texts = [main_text(page, sigma, weight) if page else "" for page in batch.column(2).to_pylist()]
            yield common.batch_of(schema, [batch.column(0), batch.column(1).cast(pa.string()), texts, list(map(len, texts))])

    rows = df.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
