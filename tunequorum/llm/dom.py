"""HTML pages as trees of block elements with their text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

#: HTML elements by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template svg annotation annotation-xml iframe object canvas select textarea button datalist audio video".split())
BLOCKS = frozenset(
    "html body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot "
    "tr caption blockquote pre figure figcaption form fieldset legend address details summary hgroup dialog menu search center".split()
)
SPACED = frozenset("br td th hr option mtd mtr".split())
#: Elements in which a tag that closes itself is empty, and tags that do not end an open head.
FOREIGN = frozenset("svg math".split())
HEAD_TAGS = frozenset("html head title base basefont bgsound link meta style script noscript template".split())
#: An opening tag of the first kind ends open elements of the second, looked for up to the third.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)), "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
}
#: Elements that a stray end tag inside them does not close.
SCOPES = frozenset("body main article section nav aside header footer div form table td th blockquote".split())

_TAG_START = re.compile(r"<[a-zA-Z/!]")


@dataclass
class Node:
    """A block element. ``parent`` is its parent's place in the page's list, -1 for the root."""

    tag: str
    parent: int
    hints: tuple[str, ...] = ()
    marked: bool = False
    inner: bool = False  # below an article
    text_chars: int = 0
    link_chars: int = 0
    last_char: str = ""
    own_chars: int = field(default=0)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1)]
        self.open: list[tuple[str, int]] = [("#page", 0)]  # every open element with its block's place
        self.depths: dict[str, list[int]] = {}  # where in ``open`` elements of a name stand
        self.blocks: list[tuple[int, str]] = []  # (block element, text) in page order
        self.pending: list[str] = []
        self.owner = 0
        self.skip = 0
        self.foreign = 0
        self.links = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.pending).split())
        self.pending = []
        if text:
            self.blocks.append((self.owner, text))
            node = self.nodes[self.owner]
            node.own_chars += len(text)
            node.last_char = text[-1]

    def _pop(self, count: int) -> None:
        for _ in range(count):
            tag, _ = self.open.pop()
            self.depths[tag].pop()
            if tag in BLOCKS:
                self._flush()
            self.links -= tag == "a"
            self.skip -= tag in SKIPPED
            self.foreign -= tag in FOREIGN
        self.owner = self.open[-1][1]

    def _push(self, tag: str) -> None:
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, self.owner))

    def _last(self, names: tuple[str, ...] | frozenset[str]) -> int:
        """Depth of the innermost open element of ``names``, 0 if there is none; the work doesn't grow with the depth."""
        return max((at[-1] for n in names if (at := self.depths.get(n))), default=0)

    def _end(self, names: tuple[str, ...], stop: frozenset[str] | tuple[str, ...]) -> None:
        """Close the innermost open element of ``names``, if none of ``stop`` is opened inside it."""
        depth = self._last(names)
        if depth and depth >= self._last(stop):
            self._pop(len(self.open) - depth)

    def _end_head(self) -> None:
        """Close a head that nothing else skipped is open in; its end tag and the body's tags may be left out."""
        if self.skip == 1:
            self._end(("head",), ())

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._end_head()
        self.foreign += tag in FOREIGN
        if tag in SKIPPED:
            self.skip += 1
            self._push(tag)
            return
        if self.skip and tag == "body":  # a head that was never closed
            while self.skip:
                self._pop(1)
        if tag in SPACED:
            self.pending.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES:
            self._end(*CLOSES[tag])
        if tag in BLOCKS:
            self._end(("p",), SCOPES)
            if re.fullmatch("h[1-6]", tag):
                self._end(("h1", "h2", "h3", "h4", "h5", "h6"), SCOPES)
            self._flush()
            values = dict(attrs)
            words = " ".join(filter(None, (values.get(k) for k in ("class", "id", "role", "aria-label")))).lower()
            hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in (values.get("style") or "").replace(" ", "")
            hints = tuple(re.findall(r"[a-z]+", words)) + (("hidden",) if hidden else ())
            above = self.nodes[self.owner]
            self.nodes.append(Node(tag, self.owner, hints, "data-content" in values, above.inner or above.tag == "article"))
            self.owner = len(self.nodes) - 1
        self.links += tag == "a"
        self._push(tag)

    def handle_startendtag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._end_head()
        if tag in VOID and tag in SPACED:
            self.pending.append(" ")
        if tag not in VOID and tag not in FOREIGN and not self.foreign:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.pending.append(" ")
        elif tag not in VOID:
            self._end((tag,), () if tag in SCOPES or tag in SKIPPED or tag in BLOCKS - {"p", "li"} else SCOPES)

    def handle_data(self, data):
        if self.skip and self.open[-1][0] == "head" and data.strip():
            self._end_head()
        if self.skip:
            return
        self.pending.append(data)
        size = len(data) if self.links else 0
        if size:
            self.nodes[self.owner].link_chars += size


def _whole_tags(html: str) -> str:
    """The page without a tag that its end cuts off; what such a tag has swallowed goes with it."""
    cut = _TAG_START.search(html, html.rfind(">") + 1)
    return html[: cut.start()] if cut else html


def parse(html: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order (parents first) and their blocks of text; anything is accepted, nothing is dropped but
    elements without readable text. Counts of characters include those of children."""
    builder = _Builder()
    builder.feed(_whole_tags(html or ""))
    builder.close()
    builder._pop(len(builder.open) - 1)
    builder._flush()
    nodes = builder.nodes
    for node in nodes:
        node.text_chars = node.own_chars
    for node in reversed(nodes[1:]):
        nodes[node.parent].text_chars += node.text_chars
        nodes[node.parent].link_chars += node.link_chars
    return nodes, builder.blocks
