"""Main text of web pages (operator 4).

The standard library's parser streams over the page; its events become lines
(one a block element) with their text and their number of tags.  The
text-to-tag ratio of the lines is smoothed with a Gaussian, a two-means
threshold splits the lines into two clusters, and the runs of the upper one
are the content regions (all lines, where the clusters are near each other).
The regions choose the page's container: its
articles (its main elements where those hold regions outside articles) if
these hold at least half of the regions' text, else the innermost element
that holds every region.  The container gives the text: all its lines, in
page order and whatever their ratio, as an article's short lines belong to
it, but for those in menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments.

Menus and the like are told by elements (SKIPPED) or by marks: a role, a
class or id name, a form, a hidden state.  Marks are hints.  Those around a
main element are not heeded, and where all of them together would leave less
than a tenth of the page's text, the outermost ones with the most text are
not heeded until that much is left.

Defined results: null or empty html gives the empty text.  A page of
SKIPPED elements only gives the empty text.  Broken markup is read as far as the
parser reads it; an element left open ends with its parent.  Repeated rows
give equal rows, extra columns are ignored, an empty table gives an empty
result, null page_id and url are passed through.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from chainstar.llm.common import c, map_batches

# Elements by their place in a page.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
                   "ol p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template head title nav aside footer iframe object svg canvas "
                    "audio video button select textarea option menu dialog math map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                  "toolbar form status".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?<!\bhas[_-])(?<!\bwith[_-])(?<!\bno[_-])(?:ads?|adverts?|advertis\w*|adsense|banner|sponsor\w*|promo\w*|sidebar\w*|side|widget\w*|menu\w*|"
    r"nav\w*|breadcrumbs?|footer\w*|masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|notification\w*|alert|"
    r"popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|related|recommend\w*|"
    r"comments?|commentlist|comment-\w+|respond|replies|disqus|discussion|pagination|pager|tags|skip|"
    r"copyright|legal|disclaimer|search\w*|form|paywall|byline-share)(?:$|[\s_-])", re.I)
# Articles that are teasers, adverts or reader comments; other words in an article's class tell nothing.
LESSER = re.compile(r"(?:^|\s)(?:related|teaser|recommend|advert|promo|sponsor|comment(?!s-(?:open|closed)))[\w-]*"
                    r"(?:$|\s)|(?:^|[\s_-])(?:teaser|advert|sponsored)(?:$|[\s_-])", re.I)
ENDS_P = BLOCKS - {"body", "html"}
LEAST_LEFT = 0.1    # share of the page's text that marks leave
LEAST_NAMED = 0.5   # share of the regions' text that articles and main elements hold to be the container
LEAST_APART = 4     # text per tag of the upper cluster over the lower one's; nearer ones are one cluster
_SPACE = re.compile(r"\s+")


class Lines(HTMLParser):
    """Parser events -> lines: (text, tags, innermost container, left out, innermost marked container).

    Containers are numbered as they open, so a parent's number is below its
    children's; ``up`` and ``mark_up`` hold the parents among all and among the marked
    ones (0: none).  Nothing is kept by line and depth: deep pages take linear time.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Tag, number, whether its content is left out, the innermost marked one down to it.
        self.stack: list[tuple[str, int, bool, int]] = []
        self.open: Counter[str] = Counter()
        self.kinds: list[str] = [""]
        self.up: list[int] = [0]
        self.mark_up: dict[int, int] = {}
        self.lines: list[tuple[str, int, int, bool, int]] = []
        self.text: list[str] = []
        self.tags = 0

    def line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, max(1, self.tags), *(self.stack[-1][1:] if self.stack else (0, False, 0))))
            self.tags = 0
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.line()
            if tag in ENDS_P:                      # a block ends an open paragraph
                self.end("p", stop=BLOCKS - {"p"})
            if tag == "li":
                self.end("li", stop=frozenset(("ul", "ol", "menu")))
            if tag in ("td", "th", "tr"):
                for x in ("td", "th", *(["tr"] if tag == "tr" else [])):
                    self.end(x, stop=frozenset(("table", "tr")) - {x})
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        above, out, mark = self.stack[-1][1:] if self.stack else (0, False, 0)
        n = len(self.kinds)
        if tag == "main":
            mark = 0
        elif self.marked(tag, dict(attrs)):
            self.mark_up[n] = mark
            mark = n
        self.stack.append((tag, n, out or tag in SKIPPED, mark))
        self.open[tag] += 1
        self.kinds.append(tag)
        self.up.append(above)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def marked(self, tag: str, attrs: dict) -> bool:
        if tag in ("html", "body", "main"):
            return False
        if tag == "article":
            return any(LESSER.search(attrs.get(k) or "") for k in ("class", "id"))
        if tag == "form" or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if tag == "header":                        # a page's header; an article's own holds its title
            return not (self.open["article"] or self.open["main"])
        if (attrs.get("role") or "").lower() in ROLES:
            return True
        if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return True
        return any(NAMES.search(attrs.get(k) or "") for k in ("class", "id"))

    def end(self, tag: str, stop: frozenset) -> None:
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.open.subtract(x[0] for x in self.stack[i:])
                del self.stack[i:]
                return
            if self.stack[i][0] in stop:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.line()
        if tag not in VOID:
            # An inline end tag never closes a block; a block's closes what is open inside.
            self.end(tag, stop=frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data):
        # A script's or button's data is no text of the block around it.
        for tag, _, out, _ in reversed(self.stack):
            if not out or tag in BLOCKS:
                break
            if tag in SKIPPED:
                return
        self.text.append(data)


def smooth(ratio: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach:reach + len(ratio)]
    return np.convolve(ratio, kernel)[reach:reach + len(ratio)] / weight


def threshold(x: np.ndarray) -> float:
    """The middle between the means of two clusters (two-means on one axis)."""
    cut = (x.min() + x.max()) / 2
    for _ in range(20):
        low, high = x[x <= cut], x[x > cut]
        if not len(high):
            break
        new = ((low.mean() if len(low) else 0.0) + high.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return float(cut)


def inside(parser: Lines, chosen: set[int]) -> list[bool]:
    """Whether each container is one of ``chosen`` or lies in one."""
    out = [False] * len(parser.up)
    for k in range(1, len(out)):
        out[k] = k in chosen or out[parser.up[k]]
    return out


def within(parser: Lines, *tags: str) -> list[bool]:
    return inside(parser, {k for k, tag in enumerate(parser.kinds) if tag in tags})


def left(parser: Lines) -> list[bool]:
    """Whether each line is neither left out nor in a marked container that is heeded.

    Where an article or main element has text outside of marked containers, all
    marks hold: comments and forms stay out however long they are.  Else marks
    are hints, and the widest ones are not heeded until a part of the text is left.
    """
    lines, named = parser.lines, within(parser, "article", "main")
    if any(named[at] and not out and not mark for _, _, at, out, mark in lines):
        return [not out and not mark for *_, out, mark in lines]
    total = sum(len(t) for t, _, _, out, _ in lines if not out)
    own: Counter[int] = Counter()                  # text by innermost marked container, then with those inside it
    for t, _, _, out, mark in lines:
        own[mark] += 0 if out else len(t)
    mass, under = Counter(own), {}
    for k in sorted(parser.mark_up, reverse=True):
        above = parser.mark_up[k]
        if above:
            mass[above] += mass[k]
        under.setdefault(above, []).append(k)
    shown, unheeded = own[0], {0}
    outermost = [(-mass[k], k) for k in under.get(0, []) if mass[k]]
    heapq.heapify(outermost)
    while shown < LEAST_LEFT * total and outermost:
        most, opened = outermost[0][0], []
        while outermost and 2 * outermost[0][0] <= most:
            opened.append(heapq.heappop(outermost)[1])
        for k in opened:
            unheeded.add(k)
            shown += own[k]
            for x in under.get(k, []):
                if mass[x]:
                    heapq.heappush(outermost, (-mass[x], x))
    open_ = {0}                                    # those in which no mark is heeded
    for k, above in parser.mark_up.items():
        if k in unheeded and above in open_:
            open_.add(k)
    return [not out and mark in open_ for *_, out, mark in lines]


def main_text(html: str | None, sigma: float = 1.0, step: int = 1 << 16) -> str:
    """Blocks of the main text, one a line."""
    if not html:
        return ""
    parser = Lines()
    for at in range(0, len(html), step):
        parser.feed(html[at:at + step])
    parser.close()
    parser.line()
    lines = parser.lines
    shown = left(parser)
    ratio = np.array([np.log1p(len(line[0]) / line[1]) if ok else 0.0 for line, ok in zip(lines, shown)])
    if not len(ratio) or not ratio.any():
        return ""
    smoothed = smooth(ratio, sigma)
    high = (smoothed >= threshold(smoothed)) & (ratio > 0)
    low = ~high & (ratio > 0)
    if not high.any() or (low.any() and smoothed[high].mean() - smoothed[low].mean() < np.log(LEAST_APART)):
        high = ratio > 0                           # one cluster
    # Text of the content regions by container, added up from the innermost.
    mass = [0] * len(parser.up)
    in_article, in_main = within(parser, "article"), within(parser, "main")
    total = held = 0
    loose = False                                  # a region in a main element, outside its articles
    for (text, _, at, *_), hit in zip(lines, high):
        if hit:
            total += len(text)
            mass[at] += len(text)
            held += len(text) * (in_article[at] or in_main[at])
            loose |= in_main[at] and not in_article[at]
    for k in range(len(mass) - 1, 0, -1):
        mass[parser.up[k]] += mass[k]
    if held and held >= LEAST_NAMED * total:
        chosen = {k for k, tag in enumerate(parser.kinds) if tag == "article" or (loose and tag == "main")}
    else:
        whole = [k for k in range(1, len(mass)) if mass[k] == total]
        chosen = {max(whole)} if whole else set()
    held_by = inside(parser, chosen)
    return "\n".join(line[0] for line, ok in zip(lines, shown) if ok and (not chosen or held_by[line[2]]))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text."""

    def make():
        def work(ids, urls, pages_):
            return [ids, urls, [main_text(h) for h in pages_]]
        return work

    kinds = {f.name: f.dataType.simpleString() for f in pages.select(c(id_col), c(url_col)).schema}
    return map_batches(pages.select(c(id_col), c(url_col), c(html_col)), make,
                       f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string")
