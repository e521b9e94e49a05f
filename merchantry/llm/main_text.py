"""The main text of web pages: parser events, text-to-tag ratios of lines, smoothing, clustering into regions."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.llm.rows import add_from_text, pick

# fixed values: elements by what they mean for the text
INVISIBLE = frozenset("script style template noscript head title textarea select option button svg math iframe object canvas audio "
                      "video datalist".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl table".split())
# regions: elements that set a part of the page apart
SECTIONS = frozenset("article main section div td body aside nav header footer form".split())
# what a head may hold, and controls that an article ends
HEAD_PARTS = frozenset("head html title meta link style script base noscript template".split())
CONTROLS = frozenset("button select option datalist".split())
CLOSES_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                             "pre section table ul".split())
# fixed values: words in class, id and role that name parts other than the article
_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended cookie cookies consent gdpr notice "
    "disclaimer popup modal overlay newsletter subscribe signup login form search share sharing social comment comments "
    "reply replies discussion respond disqus pagination pager tags toolbar contentinfo complementary".split())
# of these, those that may name an article element itself, and those whose parts hold articles that are not the page's
_COMMENTS = frozenset("comment comments reply replies disqus".split())
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion".split())
# names of a page's layout, which its wrappers carry as well
_LAYOUT = frozenset("nav navbar navigation menu header masthead footer sidebar aside widget toolbar search share social banner".split())
# before or behind a name in one word these tell of something that an element has, not what it is
_HAS, _STATES = frozenset("has with without no not".split()), frozenset("open opened closed enabled disabled on off".split())
_FILED = frozenset("category tag topic".split())
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")
_TAG = re.compile(r"<[a-zA-Z/!?]")
DEVIATION = 1.0
# means of two clusters that are closer, on the scale of logarithms, are of one cluster
APART = 1.0


@dataclass(eq=False)
class Ban:
    """Why an element bars its lines, an element of that kind or a name, and what bars around it (``above``).

    With neither it is the border of an article: wrappers and parts left open end here, but comments and closed elements bar on.
    """

    above: Ban | None
    element: bool = False
    comments: bool = False
    layout: bool = False
    border: bool = False
    closed: bool = False
    # once the page is read: whether it bars, also an article inside, and whether by layout names alone
    bars: bool = False
    bars_articles: bool = False
    loose: bool = False

    def settle(self) -> None:
        """``above`` is settled before."""
        outer = self.above
        self.bars_articles = self.comments or (self.element and self.closed) or (outer is not None and outer.bars_articles)
        self.bars = self.bars_articles if self.border else True
        self.loose = self.layout and (outer is None or outer.loose)

    def chain(self) -> list[Ban]:
        out, ban = [], self
        while ban is not None:
            out.append(ban)
            ban = ban.above
        return out


def names(attrs: list[tuple[str, str | None]], parts: frozenset[str], features: frozenset[str] = _HAS) -> set[str]:
    """The words of class, id and role that say what an element is: "sidebar" and "left-sidebar", not "with-sidebar"."""
    found = set()
    for k, v in attrs:
        if v and k in ("class", "id", "role"):
            for token in v.split():
                words = [w.lower() for w in _NAME.findall(token)]
                for i, w in enumerate(words):
                    if w in features or words[i + 1 : i + 2] and words[i + 1] in _STATES:
                        break
                    if w in parts:
                        found.add(w)
    return found


@dataclass
class Line:
    """A block of text: what ends at a block element or a line break."""

    text: str
    tags: int
    region: int
    parent: int  # the region around it
    ban: Ban | None
    unit: int  # the innermost article or main element, 0 outside of all
    linked: int  # characters of links
    heading: bool


class _Events(HTMLParser):
    """Streams a page into lines; keeps the open elements, not the tree."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # element, hides, ban, in article or main, article or main, region, list, in a link, in a heading, own ban
        self.open: list[tuple[str, bool, Ban | None, bool, int, int, int, bool, bool, Ban | None]] = []
        self.opened: Counter = Counter()
        self.bans: list[Ban] = []
        self.around = [0]
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def _state(self) -> tuple[bool, Ban | None, bool, int, int, int, bool, bool]:
        return self.open[-1][1:9] if self.open else (False, None, False, 0, 0, 0, False, False)

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            _, ban, _, unit, region, listing, _, heading = self._state()
            # links of a list are a region of their own, its other lines belong to the text around it
            at = listing if listing and 2 * self.linked >= len(text) else region
            self.lines.append(Line(text, self.tags, at, self.around[at], ban, unit, min(self.linked, len(text)), heading))
            self.tags = 0
        self.parts, self.linked = [], 0

    def _ban(self, above: Ban | None, **why: bool) -> Ban:
        self.bans.append(Ban(above, **why))
        return self.bans[-1]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
        self.tags += 1
        if self.opened["head"] and tag not in HEAD_PARTS:
            self._close_open("head")
        if tag in VOID:
            return
        if tag in CLOSES_PARAGRAPH or tag == "li":
            self._close_open("li" if tag == "li" else "p", implied=True)
        article = tag in ARTICLE
        while article and (control := next((c for c in CONTROLS if self.opened[c]), None)):
            self._close_open(control)
        hidden, ban, inside, unit, region, listing, linked, heading = self._state()
        if tag in SECTIONS or tag in LISTS:
            self.around.append(region)
            last = len(self.around) - 1
            region, listing = (last, 0) if tag in SECTIONS else (region, last)
        unit = region if article else unit
        gone = any(k == "hidden" for k, _ in attrs) or any(k == "aria-hidden" and v == "true" for k, v in attrs)
        # headers of the article itself are part of it
        element, named = tag in BOILERPLATE and not (tag == "header" and inside), set()
        if attrs and tag not in ("body", "html", "main"):
            named = names(attrs, _COMMENTS | _ADVERTS, _HAS | _FILED) if article else names(attrs, _PARTS)
        if tag == "main":
            ban = None
        elif article and ban is not None:
            ban = self._ban(ban, border=True)
        own = None
        if element or named:
            own = ban = self._ban(ban, element=element and tag != "form", comments=bool(named & _COMMENTS), layout=not element and named <= _LAYOUT)
        self.opened[tag] += 1
        self.open.append((tag, hidden or tag in INVISIBLE or gone, ban, inside or article, unit, region, listing, linked or tag == "a",
                          heading or tag in HEADINGS, own))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
        self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        self.tags += 1
        if tag not in VOID:
            self._close_open(tag)

    def _close_open(self, tag: str, implied: bool = False) -> None:
        if not self.opened[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                if self.open[k][9]:
                    self.open[k][9].closed = True
                self.opened.subtract(x[0] for x in self.open[k:])
                del self.open[k:]
                return
            # an inline or paragraph end reaches no further than its section
            if name in SECTIONS and (implied or tag in INLINE or tag == "p"):
                return

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][1]):
            self.parts.append(data)
            if self.open and self.open[-1][7]:
                self.linked += len(_SPACE.sub(" ", data))

    def unknown_decl(self, data: str) -> None:
        pass


def _finished(html: str) -> str:
    """The page up to a tag or a comment that never ends: what begins there is no text, and need not be looked at again and again."""
    if (at := html.find("<!--", html.rfind("-->") + 1)) >= 0 and ">" not in html[at + 4 :]:
        html = html[:at]
    last = html.rfind(">") + 1
    cut = _TAG.search(html, last)
    return html[: cut.start()] if cut else html


def lines_of(html: str) -> list[Line]:
    events = _Events()
    events.feed(_finished(html))
    events.close()
    events.flush()
    for ban in events.bans:
        ban.settle()
    return events.lines


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the ends are continued."""
    radius = int(np.ceil(2 * DEVIATION))
    kernel = np.exp(-np.arange(-radius, radius + 1) ** 2 / (2 * DEVIATION**2))
    return np.convolve(np.pad(ratios, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def unbarred(lines: list[Line]) -> np.ndarray:
    """The lines outside of boilerplate parts. What names of a layout bar whole, with nothing left of the page, is its wrapper."""
    free = np.array([x.ban is None or not x.ban.bars for x in lines])
    if not free.any() and (loose := [x.ban for x in lines if x.ban.loose]):
        # bans are made in the order of the page: what bars the first and the last of these lines bars all between
        others = set(map(id, loose[-1].chain()))
        wrappers = {id(b) for b in loose[0].chain() if id(b) in others}
        free = np.array([id(x.ban) in wrappers for x in lines])
    return free


def content(lines: list[Line]) -> list[bool]:
    """Which lines are content.

    Text-to-tag ratios (characters by tags since the line before; 0 in parts named as boilerplate) are smoothed over
    lines and split into two clusters, from the lowest and the highest ratio on. A heading has at least the ratio of the
    line that it heads. Regions are kept whole: those whose lines of the high cluster hold half of their text or more, where
    the text of links counts as low. So a short line goes with its region. An article or main element is a feature only: if
    the high lines hold half of its text, its regions go with it but for those of links; and so do regions that stand between
    two wanted ones of the same element. Lines of boilerplate parts never count. Clusters whose means are
    closer than a factor of about three are one: a page of nothing but text is kept whole.
    """
    if not lines:
        return []
    free = unbarred(lines)
    if not free.any():
        return [False] * len(lines)
    size = np.array([len(x.text) for x in lines], float)
    plain = size - np.array([x.linked for x in lines], float)
    ratios = np.where(free, size / np.maximum([x.tags for x in lines], 1), 0.0)
    for k in range(len(lines) - 2, -1, -1):
        if lines[k].heading and free[k] and not lines[k].linked:
            ratios[k] = max(ratios[k], ratios[k + 1])
    level = smoothed(np.log1p(ratios))
    low, high = level.min(), level.max()
    for _ in range(20):
        above = level > (low + high) / 2
        if above.all() or not above.any():
            break
        low, high = level[~above].mean(), level[above].mean()
    above = level >= (low + high) / 2 if high - low >= APART else np.ones(len(lines), bool)
    regions, units = (np.array(x) for x in ([x.region for x in lines], [x.unit for x in lines]))

    def held(by: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.bincount(by, x)[by] for x in (plain * (free & above), plain * free, size * free))

    good, own_plain, own = held(regions)
    wanted = free & (good * 2 >= own)
    good, _, whole = held(units)
    wanted |= free & (units > 0) & (good * 2 >= whole) & (own_plain * 2 > own)
    if not wanted.any():
        wanted = free
    return _filled(lines, wanted, free & (own_plain * 2 > own)).tolist()


def _filled(lines: list[Line], wanted: np.ndarray, text: np.ndarray) -> np.ndarray:
    """With the lines of text whose region stands between wanted ones of the same element, the page's body apart."""
    ends: dict[int, list[int]] = {}
    for k in np.flatnonzero(wanted):
        for around in {lines[k].region, lines[k].parent} - {0}:
            ends.setdefault(around, [k, k])[1] = k
    between = [k for k in np.flatnonzero(text & ~wanted) if lines[k].parent in ends and ends[lines[k].parent][0] < k < ends[lines[k].parent][1]]
    wanted = wanted.copy()
    wanted[between] = True
    return wanted


def extract(html: str | None) -> str:
    """The main text of a page: its content lines in page order, joined by a space; empty if there is none."""
    lines = lines_of(html or "")
    return " ".join(x.text for x, keep in zip(lines, content(lines)) if keep)


def main_texts(df: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """``df`` with the main text of each whole page; null and empty pages give the empty text, equal rows stay rows.

    Rows are independent and stay in their partitions. ``name`` must not be a column of ``df``.
    """
    return add_from_text(df, html, f"{name} string", lambda pages: {name: pa.array([extract(p) for p in pages], pa.string())})


def extracted_pages(df: DataFrame) -> DataFrame:
    """Every page's id, address, main text and its length in code points."""
    return main_texts(pick(df, "page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
