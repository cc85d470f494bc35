"""Text lines of an HTML page, tolerant of broken markup, each with what its markup says about it."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

# Elements by their role in a page, after the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Everything up to the end tag is text to the parser; none of it is shown, or only as a form's.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav noscript ol optgroup option "
    "p pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
#: A start tag of these ends an open paragraph.
ENDS_P = BLOCK - frozenset("body br button caption head html legend link meta noscript option optgroup template tbody td tfoot th thead tr".split())
#: A start tag of these ends an open one of the same group, up to the elements behind.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Never part of an article.
NEVER = frozenset(
    "aside audio button canvas datalist dialog footer menu noscript object select svg template video".split()
)
#: Not part of an article unless the article stands inside: page frames, and forms around a whole page.
FRAME = frozenset("form header nav search".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class and id names that say the same.
WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer sidebar widget widgets "
    "cookie cookies consent gdpr notice banner popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended recommendations comment comments disqus respond reply replies".split()
)
#: Names that begin so only say how a container looks.
ABOUT = frozenset("has with without no not is".split())
COMMENTS = frozenset("comment comments disqus respond reply replies".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

NONE, MAIN, ARTICLE = 0, 1, 2
KEPT, DROPPED, COVER = range(3)


class Line(NamedTuple):
    text: str
    marked: bool  # its markup says that it is not of the article
    region: int  # NONE, MAIN or ARTICLE, as declared
    linked: bool  # most of it is link text


@lru_cache(maxsize=4096)
def meaning(name: str, rest: str) -> tuple[int, int]:
    """What a start tag says of what it holds: ``KEPT``, ``DROPPED`` for good, or ``COVER`` (dropped, but for an
    article inside); and the region that it declares."""
    found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(rest)} if rest else {}
    role = found.get("role", "").lower()
    region = NONE
    if name == "article" or role == "article" or "articlebody" in found.get("itemprop", "").lower():
        region = ARTICLE
    elif name == "main" or role == "main":
        region = MAIN
    words = set()
    for one in (found.get("class", "") + " " + found.get("id", "")).split():
        parts = [w.lower() for w in NAME.findall(one)]
        if parts and parts[0] not in ABOUT:
            words.update(parts)
    style = found.get("style", "").replace(" ", "").lower()
    if name in NEVER or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return DROPPED, NONE
    if region != NONE:
        return (DROPPED, NONE) if words & COMMENTS else (KEPT, region)
    if name in ("html", "body"):
        return KEPT, NONE
    if name in FRAME or role in ROLES or words & WORDS:
        return (DROPPED if words & COMMENTS else COVER), NONE
    return KEPT, NONE


class Parser:
    def __init__(self):
        self.lines: list[Line] = []
        self.open: list[tuple[str, int, int, int]] = []  # name, what it means, covers before it, region before it
        self.names: Counter = Counter()
        self.buffer: list[str] = []
        self.linked = self.links = self.dropped = self.covers = 0
        self.region = NONE
        self.seen_article = False

    def text(self, raw: str) -> None:
        if "&" in raw:
            raw = html.unescape(raw)
        self.buffer.append(raw)
        if self.links:
            self.linked += len(raw)

    def end_line(self) -> None:
        if self.buffer:
            joined = "".join(self.buffer)
            text = " ".join(joined.split())
            if text:
                marked = bool(self.dropped or self.covers)
                self.lines.append(Line(text, marked, self.region, 2 * self.linked > len(joined)))
                self.seen_article |= not marked and self.region == ARTICLE
            self.buffer, self.linked = [], 0

    def start(self, name: str, rest: str) -> None:
        what, region = meaning(name, rest)
        if name in BLOCK or what != KEPT or region != NONE:
            self.end_line()
        if name in ENDS_P and self.names["p"]:
            self.close("p")
        if name in SIBLINGS:
            same, behind = SIBLINGS[name]
            for other, *_ in reversed(self.open):
                if other in same:
                    self.close(other)
                    break
                if other in behind:
                    break
        if name in VOID:
            return
        if name == "header" and what == COVER and self.region:
            what = KEPT  # the heading of the article itself
        self.open.append((name, what, self.covers, self.region))
        self.names[name] += 1
        self.links += name in ("a", "button")
        if what == DROPPED:
            self.dropped += 1
        elif what == COVER:
            self.covers += 1
        elif region == MAIN or (region == ARTICLE and not self.seen_article):
            self.covers = 0
        if not self.dropped and not self.covers:
            self.region = max(self.region, region)

    def close(self, name: str) -> None:
        """Close the innermost element of this name and all inside it."""
        while True:
            last, what, covers, region = self.open[-1]
            if last in BLOCK or what != KEPT or region != self.region:
                self.end_line()
            self.open.pop()
            self.names[last] -= 1
            self.links -= last in ("a", "button")
            self.dropped -= what == DROPPED
            self.covers, self.region = covers, region
            if last == name:
                return

    def parse(self, page: str) -> list[Line]:
        at = 0
        while found := TOKEN.search(page, at):
            if found.start() > at:
                self.text(page[at : found.start()])
            at = found.end()
            name = found["name"]
            if not name:
                continue
            name = name.lower()
            if found["end"]:
                if name in BLOCK:
                    self.end_line()
                if self.names[name]:
                    self.close(name)
            elif name in RAW:
                ended = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = ended.end() if ended else len(page)
            else:
                self.start(name, found["rest"])
        if at < len(page):
            self.text(page[at:])
        self.end_line()
        return self.lines


def lines_of(page: str | None) -> list[Line]:
    return Parser().parse(page or "")
