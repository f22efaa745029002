"""A small document tree of HTML blocks, with the features of its nodes."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
# never text of a page, whatever stands around them
MUTE = frozenset("script style head title template noscript iframe svg math object audio video canvas select textarea "
                 "button datalist noembed noframes".split())
CLOSES = {  # a start tag ends an open element of these, up to an element of the second set
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
TOKENS = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+")
STOPS = re.compile(r"[.!?;:,。！？]")


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "texts", "own", "links", "order", "depth", "mute")

    def __init__(self, tag: str, tokens: tuple[str, ...], parent: Node | None, order: int):
        self.tag, self.tokens, self.parent, self.order = tag, tokens, parent, order
        self.children: list[Node] = []
        self.own = self.links = 0
        self.depth = parent.depth + 1 if parent else 0
        self.mute = tag in MUTE or bool(parent and parent.mute)


class Builder(HTMLParser):
    """Block elements as nodes; inline elements only part of their block's text.

    ``blocks`` are the pieces of text between the edges of blocks, in page order: node and text.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", (), None, 0)
        self.nodes, self.stack = [self.root], [self.root]
        self.open: dict[str, list[int]] = {}  # places in the stack of the open elements of each tag
        self.inline: list[str] = []  # open links
        self.blocks: list[tuple[Node, str]] = []
        self.held: list[str] = []

    def edge(self):
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held = []
            top = self.stack[-1]
            if text and not top.mute:
                self.blocks.append((top, text))
                top.own += len(text)

    def pop_to(self, at: int):
        self.edge()
        for node in self.stack[at:]:
            self.open[node.tag].pop()
        del self.stack[at:]
        self.inline = []

    def nearest(self, tags) -> int:
        """Place of the innermost open element with one of the tags; 0 without any."""
        return max((places[-1] for t in tags if (places := self.open.get(t))), default=0)

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag == "a":
                self.inline.append(tag)
            elif tag in ("br", "wbr", "img"):
                self.held.append(" " if tag != "wbr" else "")
            return
        self.edge()
        if tag in VOID:
            return
        ends, until = CLOSES.get(tag, (set(), set()))
        while True:
            at = self.nearest(ends | {"p"})
            if not at or at < (self.nearest(until) if ends else len(self.stack) - 1):
                break
            self.pop_to(at)
            if not ends or self.stack[-1].tag not in ends:
                break
        words = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label", "itemtype"))
        tokens = tuple(t.lower() for t in TOKENS.findall(words))
        node = Node(tag, tokens, self.stack[-1], len(self.nodes))
        self.stack[-1].children.append(node)
        self.nodes.append(node)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in INLINE:
            if tag == "a" and self.inline:
                self.inline.pop()
            return
        if self.open.get(tag):
            self.pop_to(self.open[tag][-1])

    def parse_html_declaration(self, i):
        """What begins with ``<!`` and is no comment or document type is passed over up to the next ``>``.

        A section that names itself CDATA ends at its own mark. Nothing here raises, whatever a page holds.
        """
        raw = self.rawdata
        if raw.startswith("<!--", i):
            return self.parse_comment(i)
        mark = "]]>" if raw.startswith("<![CDATA[", i) else ">"
        end = raw.find(mark, i + 2)
        if end < 0 and mark != ">":
            mark, end = ">", raw.find(">", i + 2)
        return end + len(mark) if end >= 0 else -1

    def handle_data(self, data):
        self.held.append(data)
        if self.inline:
            self.stack[-1].links += len(data.strip())


def build(html: str) -> Builder:
    """The tree of a page; whatever is not HTML is text. Markup of any kind builds a tree."""
    out = Builder()
    out.feed(html)
    out.close()
    out.edge()
    return out


def features(page: Builder, odds: dict[str, float]) -> list[list[float]]:
    """A row for each node. ``odds``: log-odds of content for tags (``<p``) and attribute tokens."""
    n = len(page.nodes)
    chars, links, stops, pieces, below = ([0] * n for _ in range(5))
    where = [0] * n
    seen = 0
    for node, text in page.blocks:
        i = node.order
        where[i] = where[i] or seen + 1
        seen += len(text)
        chars[i] += len(text)
        stops[i] += len(STOPS.findall(text))
        pieces[i] += 1
    for node in reversed(page.nodes):
        i = node.order
        links[i] += node.links
        if node.parent:
            up = node.parent.order
            chars[up] += chars[i]
            links[up] += links[i]
            stops[up] += stops[i]
            pieces[up] += pieces[i]
            below[up] += below[i] + 1
            where[up] = min(filter(None, (where[up], where[i])), default=0)
    lowest, highest = [0.0] * n, [0.0] * n
    place, same = [0] * n, [0] * n
    for node in page.nodes:
        tags: dict[str, int] = {}
        for k, child in enumerate(node.children):
            place[child.order] = k
            tags[child.tag] = tags.get(child.tag, 0) + 1
        for child in node.children:
            same[child.order] = tags[child.tag]
    out = []
    total = max(seen, 1)
    for node in page.nodes:
        i = node.order
        own = [odds.get(t, 0.0) for t in node.tokens]
        tag = odds.get(f"<{node.tag}", 0.0)
        low, high = min(own, default=0.0), max(own, default=0.0)
        if node.parent:
            up = node.parent.order
            lowest[i] = min(lowest[up], tag, low)
            highest[i] = max(highest[up], tag, high)
            above = chars[up]
            siblings = len(node.parent.children)
            outer = lowest[up], highest[up]
        else:
            above, siblings, outer = chars[i], 1, (0.0, 0.0)
        out.append([
            tag, low, high, *outer, node.depth,
            math.log1p(chars[i]), links[i] / max(chars[i], 1), math.log1p(chars[i] / (below[i] + 1)),
            math.log1p(node.own), stops[i] / max(chars[i], 1), math.log1p(chars[i] / max(pieces[i], 1)),
            where[i] / total, chars[i] / total, chars[i] / max(above, 1),
            math.log1p(siblings), place[i] / max(siblings, 1), same[i] / max(siblings, 1), math.log1p(below[i]),
        ])
    return out
