"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, read, ship

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has he in is it its of on or that the this to was were which will with "
    "als am an auch auf aus bei das dem den der des die ein eine einem einer es für im in ist mit nicht sich sie sind und von war wie zu zum "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne par pas plus pour que qui sa se son sur un une "
    "al como con de del el en es esta la las lo los más no o para pero por que se sin su sus un una y".split())
#: Elements that are never article text, and whole words of class or id that say so.
DROP_TAGS = frozenset("nav header footer aside form menu dialog button select fieldset noscript template iframe object svg canvas audio video map".split())
RAW_TAGS = frozenset("script style title textarea xmp noembed noframes".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments reply replies cookie cookies consent copyright "
    "disqus footer form header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "related respond share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar topbar widget".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
HOLDS = frozenset("div section article main aside nav header footer form menu dialog table ul ol dl fieldset figure details body "
                  "button select noscript template iframe object svg canvas audio video map".split())
LONG_CHARS, STOP_DENSITY, LINK_DENSITY = 70, 0.12, 0.5
#: In the second pass: how much farther a block of another container is, one of an article from a block outside of it, and bad blocks inside one.
WALL, OUTSIDE, BAD_FAR = 3, 20, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)|<[!?/][^>]*+>", re.S)
_SPECIAL = re.compile("[>\"']")
_ATTR = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+|"[^"]*+"|'[^']*+'""")
_WORD = re.compile(r"[^\W\d_]+")


class Element:
    """An open element that holds blocks; its labels are known when all ends of elements are."""

    def __init__(self, tag: str, own: bool, parent: Element | None) -> None:
        self.tag, self.own, self.parent = tag, own, parent
        self.closed = False  # by an end tag of its own
        self.bad, self.firm, self.home, self.number = own, False, 0, 0


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    dropped: bool  # in an element that never holds article text
    home: int  # number of the article or main element it is in, or 0
    box: int = 0  # number of the container it is in, or 0


def _boilerplate(tag: str, attrs: str) -> bool:
    if tag in DROP_TAGS:
        return True
    for name, v in _ATTR.findall(attrs) if attrs else ():
        if v and name.lower() in ("class", "id", "role") and DROP_WORDS & set(re.split(r"[^a-z]+", v.lower())):
            return True
    return False


class Tags:
    """Where the tags of a page end, in linear time for all of them."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.specials = self.ends = (0, -1)  # (from, place): the next of its kind at or after any place between
        self.lost: set[int] = set()  # quotes and ends of page from which no end of a tag is found
        self.none: dict[str, int] = {}  # from where on a quote does not come again

    def _special(self, at: int) -> int:
        if not self.specials[0] <= at <= self.specials[1]:
            m = _SPECIAL.search(self.page, at)
            self.specials = (at, m.start() if m else len(self.page))
        return self.specials[1]

    def _first_end(self, at: int) -> int:
        if not self.ends[0] <= at <= self.ends[1]:
            end = self.page.find(">", at)
            self.ends = (at, end if end >= 0 else len(self.page))
        return self.ends[1]

    def end(self, at: int) -> int:
        """Place of the > that ends a tag with attributes from ``at`` on, or -1.
        Quoted values may hold any >, whatever their length; where a quote is
        never closed, it is the first >."""
        page, n, i, seen = self.page, len(self.page), at, []
        while True:
            i = self._special(i)
            if i < n and page[i] == ">":
                return i
            seen.append(i)
            if i == n or i in self.lost or i >= self.none.get(page[i], n):
                break
            close = page.find(page[i], i + 1)
            if close < 0:
                self.none[page[i]] = i
                break
            i = close + 1
        self.lost.update(seen)
        first = self._first_end(at)
        return first if first < n else -1


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in page order. Inline elements and ``<br>``
    do not end a block; raw-text elements and comments hold no text. A tag
    left open ends with its container, and an article or main element also
    ends any element of boilerplate that has no end tag of its own."""
    out: list[tuple[str, int, Element | None]] = []
    stack: list[Element] = []
    elements: list[Element] = []
    text: list[str] = []
    homes, anchor, links = 0, False, 0

    def flush() -> None:
        nonlocal text, links
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append((joined, links, stack[-1] if stack else None))
        text, links = [], 0

    def enter(tag: str, own: bool) -> None:
        stack.append(Element(tag, own, stack[-1] if stack else None))
        elements.append(stack[-1])
        stack[-1].number = len(elements)

    def say(raw: str) -> None:
        nonlocal links
        if raw:
            said = html.unescape(raw) if "&" in raw else raw
            text.append(said)
            if anchor:
                links += len(said.strip())

    at = 0
    n = len(page)
    tags = Tags(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        end = tags.end(m.end()) if m[2] else m.end()
        if end < 0:  # no tag
            say(page[at:m.start() + 1])
            at = m.start() + 1
            continue
        say(page[at:m.start()])
        close, tag = m[1], m[2]
        at = end
        if not tag:
            continue
        attrs = page[m.end():end]
        at += 1
        tag = tag.lower()
        if tag in RAW_TAGS:
            if not close and not attrs.endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else n
            continue
        if tag == "a":
            anchor = not close
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK_TAGS or tag in HOLDS:
            flush()
            anchor = False
        if tag in HOLDS:
            if close:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag == tag:
                        stack[i].closed = True
                        del stack[i:]
                        break
            elif not attrs.endswith("/"):
                enter(tag, _boilerplate(tag, attrs))
        elif not close and attrs and tag in BLOCK_TAGS and _boilerplate(tag, attrs):
            enter(tag, True)
        elif close and any(e.tag == tag for e in stack):
            while stack[-1].tag != tag:
                stack.pop()
            stack.pop().closed = True
    flush()

    for e in elements:  # parents come first
        up = e.parent
        if up:
            e.bad, e.home = e.own or up.bad, up.home
            # not ended by an article: reader comments and teasers are often articles inside closed boilerplate
            e.firm = up.firm or (up.own and (up.closed or up.tag not in DROP_TAGS))
        if e.tag in ("article", "main") and not e.own and not e.home:
            e.bad = e.firm
            homes += 1
            e.home = homes
    return [Block(t, k, bool(e and e.bad), e.home if e else 0, e.number if e else 0) for t, k, e in out]


def first_pass(b: Block, home: bool = False) -> tuple[str, bool | None]:
    """(rule that speaks, label) of a block by itself: False is out, True is in, None undecided.

    ``home``: the page has an article or main element with a long block of article
    text, and this block is outside of all such; it then takes more than its words to be in."""
    n = len(b.text)
    if b.dropped:
        return "boilerplate", False
    if b.links > LINK_DENSITY * n:
        return "links", False
    if n < LONG_CHARS:
        return "short", None
    words = _WORD.findall(b.text.lower())
    if sum(w in STOP_WORDS for w in words) < STOP_DENSITY * max(1, len(words)):
        return "few stop words", None
    return "stop words", None if home else True


def _second_pass(found: list[Block], first: list[bool | None], far: list[int], ends: tuple[bool | None, bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one. ``far``: how much
    farther each block is from the one before it; ``ends``: labels that the start and
    the end of the blocks count as, if any. On a tie, and where nothing is decided, a block is in."""
    place, at = [], 0
    for i, b in enumerate(found):
        at += 1 + (WALL if i and found[i - 1].box != b.box else 0) + far[i]
        place.append(at)
    out = list(first)
    near: list[list[tuple[float, bool]]] = [[] for _ in found]  # (distance, is it bad)
    for side, order in ((0, range(len(found))), (1, range(len(found) - 1, -1, -1))):
        last = {} if ends[side] is None else {ends[side]: at + 1 if side else 0}
        for i in order:
            if first[i] is None:
                near[i] += [(abs(place[i] - p) * (BAD_FAR if found[i].home and not good else 1), not good) for good, p in last.items()]
            else:
                last[first[i]] = place[i]
    for i, f in enumerate(first):
        if f is None:
            out[i] = not min(near[i])[1] if near[i] else True
    return out


def classify(found: list[Block]) -> list[bool]:
    """Which blocks are article text.

    First pass (``first_pass``): blocks in boilerplate elements are out, and so
    are those that are links for more than half; blocks of ``LONG_CHARS`` or
    more with enough stop words are in; short ones and those of few stop words
    are undecided. Second pass: an undecided block takes the label of the
    nearest decided block, on a tie the good one. Blocks of another container
    are ``WALL`` farther, so a heading goes with the paragraphs below it and
    not with the links above its container. An element of boilerplate says
    nothing of the blocks around it. Where nothing is decided a block is in.

    Article and main elements are a feature. Both passes run over the blocks
    of each by themselves; its start counts as a good block, and bad blocks in
    it as ``BAD_FAR`` times as far. If one of them holds a long block that is
    in, a block outside of all is not in by its own words: it takes the label
    of the nearest decided block or end of the page (which is bad), where
    blocks of the element are ``OUTSIDE`` farther.
    """
    homes: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if not b.dropped:
            homes.setdefault(b.home, []).append(i)
    out: list[bool | None] = [None] * len(found)
    for home, places in homes.items():
        if home:
            own = [found[i] for i in places]
            for i, good in zip(places, _second_pass(own, [first_pass(b)[1] for b in own], [0] * len(own), (True, None))):
                out[i] = good
    known = any(good and len(b.text) >= LONG_CHARS for good, b in zip(out, found))
    seen = [i for i, b in enumerate(found) if not b.dropped] if known else homes.get(0, [])
    rest = [found[i] for i in seen]
    first = [out[i] if found[i].home else first_pass(found[i], known)[1] for i in seen]
    far = [OUTSIDE if k and bool(b.home) != bool(rest[k - 1].home) else 0 for k, b in enumerate(rest)]
    for i, good in zip(seen, _second_pass(rest, first, far, (False, False) if known else (None, None))):
        out[i] = good
    return [bool(x) for x in out]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, good in zip(found, classify(found)) if good)


def extract_html(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    The whole page is read; the text of its article blocks is joined by line
    feeds. Character references are decoded and white space inside a block
    becomes one space. Null and empty pages, and pages without article text,
    give an empty text. No shuffle: pages pass in Arrow batches and each is
    parsed in linear time. Repeated rows stay, an empty table gives an empty
    result, and extra columns are ignored.
    """
    ship(pages.sparkSession)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            text = [main_text(h) for h in p["html"]]
            yield pd.DataFrame({"id": p["id"], "url": p["url"], "text": text, "n_chars": [len(t) for t in text]})

    d = pick(pages, id=id_col, url=url_col, html=html_col)
    kind = dict(d.dtypes)["id"]
    out = d.mapInPandas(extract, f"id {kind}, url string, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_html(read(spark, sf_dir, "pages"))
