"""A small DOM of a page: nodes with their text, read from any tag soup."""

from __future__ import annotations

import html
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCKS = frozenset(
    "html body article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd"
    " table thead tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset address"
    " details summary hr select option button dialog center".split()
)
#: Open elements that a start tag ends, and those that stop the search for them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_TOKEN = re.compile(
    r"<!--(?:.*?-->|>|->)|<!--.*|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S
)
_ATTRIBUTES = re.compile(r"\b(class|id|role|rel|itemprop|style|hidden|aria-label)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parent", "items", "depth", "number")

    def __init__(self, tag: str, attributes: str, parent: "Node | None", number: int):
        self.tag, self.attributes, self.parent, self.number = tag, attributes, parent, number
        self.items: list = []  # texts and child nodes in page order
        self.depth = parent.depth + 1 if parent else 0


def parse(page: str | None) -> list[Node]:
    """Nodes in page order, the root first. Comments and processing marks are left out;
    raw elements (scripts, styles and the like) stay as nodes without text. A tag that is
    not closed before the end of the page is ignored."""
    page = page or ""
    root = Node("html", "", None, 0)
    nodes, top, at = [root], root, 0
    while at < len(page):
        found = page.find("<", at)
        if found < 0:
            found = len(page)
        if found > at:
            top.items.append(html.unescape(page[at:found]))
        if found == len(page):
            break
        token = _TOKEN.match(page, found)
        if token is None:  # a lone "<" is text
            top.items.append("<")
            at = found + 1
            continue
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        if not token[0].endswith(">"):
            break
        tag = tag.lower()
        if token[1]:
            if tag == "br":
                top.items.append(" ")
                continue
            node = top
            while node.parent and node.tag != tag:
                if node.tag in BLOCKS and tag not in BLOCKS:
                    node = root
                    break
                node = node.parent
            if node.parent:
                top = node.parent
            elif tag == "p":
                pass
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in nodes[:8]):
            nodes[0].attributes += _attributes(token[3])
            continue
        if tag == "br":
            top.items.append(" ")
            continue
        if tag in BLOCKS:
            node = top
            while node.parent and node.tag != "p" and (node.tag not in BLOCKS):
                node = node.parent
            if node.tag == "p":
                top = node.parent
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            node, last = top, None
            while node.parent and node.tag not in stops:
                if node.tag in ends:
                    last = node
                node = node.parent
            if last is not None:
                top = last.parent
        node = Node(tag, _attributes(token[3]), top, len(nodes))
        nodes.append(node)
        top.items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not token[3].endswith("/"):
            top = node
    return nodes


def _attributes(text: str) -> str:
    """Values of the telling attributes, and the names of bare ones, as one lower-case text."""
    if not text:
        return ""
    return " ".join((v or k).strip("\"'") for k, v in _ATTRIBUTES.findall(text)).lower()


def blocks(nodes: list[Node], kept) -> list[str]:
    """Texts of the blocks that kept nodes make, white space joined, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def close():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(text)

    stack: list = [(nodes[0], 0)]
    while stack:
        node, at = stack.pop()
        if at == 0 and node.tag in BLOCKS:
            close()
        items = node.items
        while at < len(items):
            item = items[at]
            at += 1
            if isinstance(item, str):
                parts.append(item)
            elif kept[item.number]:
                stack.append((node, at))
                stack.append((item, 0))
                break
            elif item.tag in BLOCKS:
                close()
            else:
                parts.append(" ")
        else:
            if node.tag in BLOCKS:
                close()
    close()
    return out
