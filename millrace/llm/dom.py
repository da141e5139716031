"""Leaf blocks of a web page: stretches of text between block boundaries, with the elements around them.

A page is read once from front to back; open elements are kept on a stack and
the names that stand around a block in counts, so cost does not follow depth.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template iframe svg xmp noembed noframes object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody"
    " td textarea tfoot th thead title tr ul".split()
)
#: What an element closes where it opens, up to an open one of these, with the elements that such a search doesn't leave.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES |= {t: ("p", "td th table button") for t in BLOCK - set(CLOSES) - set("html head body title button label option optgroup select textarea legend caption col colgroup tbody tfoot thead summary".split())}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}

#: Elements that hold a part of a page.
PART = frozenset("article aside body dialog div footer form header main menu nav section td fieldset details".split())

#: Elements that style words; that one is open says nothing of a block.
STYLE = frozenset("a abbr b big cite code em font i kbd mark q s small span strong sub sup tt u".split())

OPENING = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Parts of the names that pages give to elements: main-Content_2 is main and content.
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str  # white space is one space, none at the ends
    tag: str
    around: tuple[str, ...]  # tags and names of the elements it stands in, once each
    within: tuple[str, ...]  # those of the nearest element that holds a part of the page
    path: str  # tags of the three nearest such elements
    link_chars: int


@dataclass
class Page:
    title: str = ""
    blocks: list[Block] = field(default_factory=list)


def tag_end(page: str, at: int) -> int:
    """The place after the ``>`` of a tag whose name ends at ``at``; a ``>`` inside a quoted value does not end it."""
    while True:
        close = page.find(">", at)
        if close < 0:
            return len(page)
        quote = min((q for q in (page.find('="', at, close), page.find("='", at, close)) if q >= 0), default=-1)
        if quote < 0:
            return close + 1
        after = page.find(page[quote + 1], quote + 2)
        if after < 0:  # a quote that nothing ends
            return close + 1
        at = after + 1


class Reader:
    def __init__(self) -> None:
        self.page, self.stack, self.open = Page(), [], {}  # stack: (tag, names); open: how many elements of a tag are open
        self.names: dict[str, int] = {}
        self.start()

    def start(self) -> None:
        self.parts: list[str] = []
        self.link = 0
        self.around: tuple[str, tuple[str, ...], tuple[str, ...], str] | None = None

    def text(self, raw: str) -> None:
        said = html.unescape(raw) if "&" in raw else raw
        if self.around is None and not said.isspace():
            tag = next((t for t, _ in reversed(self.stack) if t in BLOCK), "body")
            self.around = tag, tuple(self.names), *self.parts_around()
        self.parts.append(said)
        if self.open.get("a"):
            self.link += len(said)

    def parts_around(self) -> tuple[tuple[str, ...], str]:
        near = []
        for t, names in reversed(self.stack):
            if t in PART:
                near.append((t, names))
                if len(near) == 3:
                    break
        return tuple(near[0][1]) if near else (), ">".join(t for t, _ in near)

    def flush(self) -> None:
        if self.around is not None:
            self.page.blocks.append(Block(" ".join("".join(self.parts).split()), *self.around, self.link))
        if self.parts:
            self.start()

    def push(self, tag: str, attributes: str) -> None:
        names = [] if tag in STYLE else [tag]
        if "=" in attributes:
            for m in ATTRIBUTE.finditer(attributes):
                names += ["." + n.lower() for n in NAME.findall(m[2] or m[3] or m[4] or "")]
        self.stack.append((tag, names))
        self.open[tag] = self.open.get(tag, 0) + 1
        for n in names:
            self.names[n] = self.names.get(n, 0) + 1

    def pop(self) -> str:
        tag, names = self.stack.pop()
        self.open[tag] -= 1
        for n in names:
            self.names[n] -= 1
            if not self.names[n]:
                del self.names[n]
        return tag

    def close(self, tags: frozenset[str], within: frozenset[str]) -> None:
        if any(self.open.get(t) for t in tags):
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in within:
                    return
                if self.stack[k][0] in tags:
                    while len(self.stack) > k:
                        self.pop()
                    return


def read(page: str) -> Page:
    """Title and leaf blocks of a page, however broken its markup is. Comments, scripts, styles and the head's title are no blocks."""
    r, at, n = Reader(), 0, len(page)
    while at < n:
        m = OPENING.search(page, at)
        if m is None:
            r.text(page[at:])
            break
        if m.start() > at:
            r.text(page[at : m.start()])
        if m[2] is None:  # a comment or declaration
            mark = "-->" if m[0] == "<!--" else ">"
            end = page.find(mark, m.end())
            at = n if end < 0 else end + len(mark)
            continue
        tag, at = m[2].lower(), tag_end(page, m.end())
        if m[1]:
            if tag in BLOCK:
                r.flush()
            if r.open.get(tag):
                while r.pop() != tag:
                    pass
        elif tag in SILENT or tag == "title":
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if tag == "title" and not r.page.title:
                r.page.title = " ".join(html.unescape(page[at : end.start() if end else n]).split())
            at = tag_end(page, end.end()) if end else n
        else:
            if tag in BLOCK:
                r.flush()
            elif tag == "br":
                r.text("\n")
            if tag in CLOSES:
                r.close(*CLOSES[tag])
            if tag not in VOID:
                r.push(tag, page[m.end() : at])
    r.flush()
    return r.page
