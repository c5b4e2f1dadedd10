"""A small HTML reader: a tree of elements and texts, with the implied end tags that pages rely on."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul caption".split()
)
#: An open element that a start tag ends, and the elements at which the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
INSIDE_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "option", "optgroup", "legend"}
SCOPE = {"button", "td", "th", "caption", "table", "html", "body"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


RAW_END = {name: re.compile(rf"</{name}[^>]*>?", re.I | re.A) for name in RAW}


#: Elements nested deeper become siblings, as in browsers.
DEEPEST = 512


class Node:
    """An element: its name, attributes as written, and children (elements and texts)."""

    __slots__ = ("children", "depth", "parent", "tag", "written")

    def __init__(self, tag: str, parent: Node | None = None, written: str = ""):
        self.tag, self.parent, self.written = tag, parent, written
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []

    def attributes(self) -> dict[str, str]:
        if not self.written.strip(" /"):
            return {}
        found = ATTRIBUTE.findall(self.written)
        return {k.lower(): entities.unescape(a or b or c) for k, a, b, c in reversed(found)}

    def elements(self) -> Iterator[Node]:
        """This element and those below, in page order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]


def _close(at: Node, names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> Node:
    """The parent of the nearest open element with one of the names, or `at` if there is none."""
    node: Node | None = at
    out = at
    while node is not None and node.tag not in stops:
        if node.tag in names:
            out = node.parent or node
            if len(names) == 1:
                break
        node = node.parent
    return out


def parse(text: str) -> Node:
    """The tree of a page; comments, declarations and the content of raw elements are left out."""
    root = now = Node("#root")
    at = 0
    search = TOKEN.search
    while m := search(text, at):
        if m.start() > at:
            now.children.append(text[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            node: Node | None = now
            inline = name not in BLOCK
            while node is not None and node.tag != name and not (inline and node.tag in BLOCK):
                node = node.parent
            if node is not None and node.tag == name and node.parent is not None:
                now = node.parent
            elif name == "p":
                now.children.append(Node("p", now))
            continue
        if name in CLOSES:
            now = _close(now, *CLOSES[name])
        if name in INSIDE_P:
            now = _close(now, {"p"}, SCOPE)
        node = Node(name, now, m[3])
        now.children.append(node)
        if name in RAW:
            end = RAW_END[name].search(text, at)
            at = end.end() if end else len(text)
        elif name not in VOID and (name in BLOCK or not m[3].rstrip().endswith("/")) and node.depth < DEEPEST:
            now = node
    if at < len(text):
        now.children.append(text[at:])
    return root


#: The references that pages use most; `&amp;` last, so that none is decoded twice.
COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def decode(text: str) -> str:
    """Character references decoded; texts with common ones alone take a short way."""
    left = text.count("&")
    if not left:
        return text
    out = text
    for reference, character in COMMON:
        if n := text.count(reference):
            left -= n
            out = out.replace(reference, character)
    return entities.unescape(text) if left else out


def tidy(text: str) -> str:
    """Character references decoded, white space to one space, trimmed."""
    return " ".join(decode(text).split())
