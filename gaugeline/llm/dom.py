"""A lenient HTML tree with what the extraction model needs to know of each block.

Only block elements are nodes; inline elements add to the numbers of the block around
them. Script, style, comments, head and the like leave no text.
"""

from __future__ import annotations

import html
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import defaultdict

_NAME_END = re.compile(r"[\s/>]")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")

# The block elements, the elements without end tags, and those whose
# content is no text of the page, as HTML defines them.
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template iframe object svg math textarea select option button title head canvas "
    "audio video noframes".split())
_RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in ("script", "style", "textarea", "title",
                                                                    "iframe", "noframes", "noscript")}
#: Open elements that a start tag closes.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"},
           "tfoot": {"tr", "td", "th", "tbody", "thead"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
_TABLES = {"table"}


class Node:
    __slots__ = ("tag", "parent", "children", "parts", "tokens", "hidden", "links", "link_chars", "chars",
                 "marks", "depth", "place", "index")

    def __init__(self, tag: str, parent: Node | None, tokens: frozenset = frozenset(), hidden: bool = False):
        self.tag, self.parent, self.tokens, self.hidden = tag, parent, tokens, hidden
        self.children: list[Node] = []
        #: Own text in order; a child stands where its text would.
        self.parts: list[str | Node] = []
        self.links = self.link_chars = self.chars = self.marks = self.index = 0
        self.depth = parent.depth + 1 if parent else 0
        self.place = len(parent.children) if parent else 0
        if parent:
            parent.children.append(self)
            parent.parts.append(self)


class _Tags:
    """The tags and other mark-up of a page, found in one pass: no position is looked at again
    however many tags are left open or quotes unclosed."""

    def __init__(self, page: str):
        self.page = page
        self.stops = array("q", (m.start() for m in _QUOTE_OR_END.finditer(page)))
        self.last = {c: page.rfind(c) for c in ">\"'"}
        #: Quotes that, met outside of quotes, lead to no end of a tag.
        self.dead: set[int] = set()
        self.named = (0, 0)

    def __iter__(self):
        """(start, end, name, whether an end tag, attributes); without a name: the text of CDATA."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("<!--", start):
                at = self._after("-->", start + 4)
                yield start, at, None, False, ""
            elif page.startswith("<![CDATA[", start):
                at = self._after("]]>", start + 9)
                yield start, at, None, False, page[start + 9:at].removesuffix("]]>")
            elif page.startswith(("<!", "<?"), start):
                at = self._after(">", start + 2)
                yield start, at, None, False, ""
            elif start < self.last[">"]:
                closing = page.startswith("/", start + 1)
                first = start + 1 + closing
                if page[first:first + 1].isascii() and page[first:first + 1].isalpha():
                    after = self._name_end(first)
                    end = self._tag_end(after)
                    if end >= 0:
                        at = end + 1
                        yield start, at, page[first:after].lower(), closing, page[after:end]

    def _after(self, mark: str, start: int) -> int:
        found = self.page.find(mark, start)
        return len(self.page) if found < 0 else found + len(mark)

    def _name_end(self, first: int) -> int:
        low, high = self.named
        if not low <= first < high:
            found = _NAME_END.search(self.page, first)
            self.named = first, found.start() if found else len(self.page)
        return self.named[1]

    def _tag_end(self, at: int) -> int:
        """The next > outside of quotes, or -1 if there is none."""
        page, passed = self.page, []
        while True:
            place = bisect_left(self.stops, at)
            if place == len(self.stops):
                break
            stop = self.stops[place]
            mark = page[stop]
            if mark == ">":
                return stop
            passed.append(stop)
            if stop in self.dead or stop == self.last[mark]:
                break
            at = page.index(mark, stop + 1) + 1
        self.dead.update(passed)
        return -1


class _Open:
    """The open elements, with the places of each name and of the blocks among them."""

    def __init__(self):
        self.stack: list[tuple[str, Node | None]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, name: str, own: Node | None) -> None:
        self.places[name].append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, own))

    def pop(self) -> tuple[str, Node | None]:
        name, own = self.stack.pop()
        self.places[name].pop()
        if name in BLOCKS:
            self.blocks.pop()
        return name, own

    def last(self, names) -> int:
        """The place of the innermost of the named elements, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def first_after(self, names, place: int) -> int:
        """The place of the outermost of the named elements within another, or -1."""
        found = [p[k] for n in names if (p := self.places.get(n)) and (k := bisect_right(p, place)) < len(p)]
        return min(found, default=-1)


def parsed(page: str | None) -> Node:
    """The tree of a page; its root stands for the document."""
    root = node = Node("html", None)
    opened = _Open()
    silent = links = at = 0
    page = page or ""

    def text(data: str) -> None:
        if silent or not data:
            return
        if "&" in data:
            data = html.unescape(data)
        node.parts.append(data)
        size = len(data)
        node.chars += size
        node.marks += data.count(",") + data.count(".")
        if links:
            node.link_chars += size

    def close(place: int) -> None:
        nonlocal node, silent, links
        while len(opened.stack) > place:
            name, own = opened.pop()
            if own is not None:
                node = own.parent
                links = 0
            elif name in SILENT:
                silent -= 1
            elif name == "a" and links:
                links -= 1

    tags = _Tags(page)
    for start, end, name, closing, attributes in tags:
        if start < at:
            continue
        text(page[at:start])
        at = end
        if name is None:
            text(attributes)
        elif closing:
            if name == "br":
                text("\n")
            place = opened.last((name,))
            if place >= 0 and not (name in ("div", "p", "span") and opened.last(_TABLES) > place):
                close(place)
        elif name in ("html", "body"):
            # Their end tags never matter, what follows is still the page.
            node.tokens |= _named(attributes)[0] if node is root else frozenset()
        elif name in BLOCKS:
            if opened.blocks and opened.stack[opened.blocks[-1]][0] == "p":
                close(opened.blocks[-1])
            if name in _CLOSES:
                low = opened.first_after(_CLOSES[name], opened.last(_SCOPES.get(name, _TABLES)))
                if low >= 0:
                    close(low)
            if name in VOID:
                node.parts.append(Node(name, None))
                continue
            tokens, hidden = _named(attributes)
            node = Node(name, node, tokens, hidden or node.hidden)
            node.index = 0
            opened.push(name, node)
        elif name in VOID:
            if name in ("br", "wbr") and not silent:
                text("\n" if name == "br" else "")
        elif name in SILENT:
            if name in _RAW:
                found = _RAW[name].search(page, at, tags.last[">"] + 1)
                at = found.end() if found else len(page)
            elif not attributes.rstrip().endswith("/"):
                opened.push(name, None)
                silent += 1
        else:
            opened.push(name, None)
            if name == "a":
                links += 1
                node.links += 1
    if at < len(page):
        text(page[at:])
    return root


def _named(attributes: str) -> tuple[frozenset, bool]:
    """Words of class, id and role; whether the element is hidden."""
    if not attributes or attributes.isspace():
        return frozenset(), False
    tokens, hidden = [], False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden = hidden or bool(_HIDDEN.search(value))
        else:
            tokens += _SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower())
    return frozenset(t for t in tokens if t), hidden


def blocks(node: Node, kept) -> list[str]:
    """Texts of the kept nodes in page order; a child block parts its parent's text."""
    out, run = [], []

    def flush():
        joined = _SPACE.sub(" ", "".join(run)).strip()
        if joined:
            out.append(joined)
        run.clear()
    # Open nodes with what is left of their parts: pages may nest to any depth.
    stack = [(node, iter(node.parts))]
    while stack:
        node, parts = stack[-1]
        for part in parts:
            if isinstance(part, str):
                if kept(node):
                    run.append(part)
            else:
                flush()
                stack.append((part, iter(part.parts)))
                break
        else:
            flush()
            stack.pop()
    return out
