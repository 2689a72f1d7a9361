"""A small HTML reader: tags to a tree, subtree hashes, blocks of text.

Only what main-text extraction needs: implied end tags of paragraphs, list
items, table parts and options, void elements, raw-text elements, comments.
"""
from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from html import unescape

NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"""[>"']""")
#: Text and the tag after it, where no < or > is inside of quotes.
QUICK = re.compile(r"""([^<]*+)<(/?)([a-zA-Z][^\s/<>"']*+)((?:[^"'<>]++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot
    thead tr ul""".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "option": ({"option"}, {"select", "datalist"})}
CELL = frozenset({"td", "th"})


#: Elements whose open end tags are implied, each group with the elements that bound the search for them.
GROUPS = [(frozenset({"p"}), BLOCK - {"p"}), *((frozenset(ends), frozenset(within)) for ends, within in
                                               (CLOSES[t] for t in ("li", "dt", "tr", "td", "tbody", "option")))]
GROUP = {"li": 1, "dt": 2, "dd": 2, "tr": 3, "td": 4, "th": 4, "tbody": 5, "tfoot": 5, "option": 6}
COUNTED = frozenset().union(*(ends | within for ends, within in GROUPS))


@lru_cache(maxsize=4096)
def opened(tag: str, before: tuple[int, ...]) -> tuple[int, ...]:
    return tuple((0 if tag in within and tag not in ends else n) + (tag in ends) for n, (ends, within) in zip(before, GROUPS))


class Node:
    """``open``: of each group, how many of its elements are open here, up to
    the next element that bounds the search.  ``prose``: is there text of its
    own, not in an element, set with the digests."""
    __slots__ = ("tag", "attributes", "parent", "children", "digest", "open", "values", "prose")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent, self.children, self.digest = tag, attributes, parent, [], None
        self.values = None if attributes else {}
        before = parent.open if parent is not None else (0,) * len(GROUPS)
        self.open = opened(tag, before) if tag in COUNTED else before

    def get(self, name: str) -> str | None:
        if self.values is None:  # of repeated attributes the first counts
            self.values = {}
            for key, value in ATTRIBUTE.findall(self.attributes):
                self.values.setdefault(key.lower(), unescape(value[1:-1] if value[:1] in "\"'" and value else value))
        return self.values.get(name)


class Tags:
    """Reads a page from front to back; no part of it is read again and
    again, however broken the page is."""

    def __init__(self, html: str):
        self.html, self.quotes = html, True

    def end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``: at the next >
        outside of quotes; -1 if there is none at all."""
        html = self.html
        if self.quotes:
            first = html.find(">", at)
            if first < 0 or ("\"" not in (tag := html[at:first]) and "'" not in tag):
                return first
            place = at
            while m := STOP.search(html, place):
                if m[0] == ">":
                    return m.start()
                place = html.find(m[0], m.end()) + 1
                if not place:
                    break
            self.quotes = False  # a quote that never ends: from here on quotes mean nothing
        return html.find(">", at)

    def raw(self, tag: str, place: int) -> tuple[str, int]:
        """The text of a raw element that begins at ``place``, and its end."""
        close = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(self.html, place)
        return self.html[place: close.start()], close.end()

    def __iter__(self):
        """(text, None, "") and (name, closing, attributes)."""
        html, place = self.html, 0
        while place < len(html):
            if quick := QUICK.match(html, place):
                text, slash, tag, attributes = quick.groups()
                if text:
                    yield text, None, ""
                place, tag = quick.end(), tag.lower()
                yield tag, slash, attributes
                if tag in RAW and not slash:
                    text, place = self.raw(tag, place)
                    if text:
                        yield text, None, ""
                continue
            at = html.find("<", place)
            if at < 0:
                yield html[place:], None, ""
                return
            m = NAME.match(html, at)
            if m:
                end = self.end(m.end())
                if end < 0:  # no tag ends any more
                    yield html[place:], None, ""
                    return
            elif html.startswith("<!--", at):
                end = html.find("-->", at + 4) + 2
            elif html.startswith("<![CDATA[", at):
                end = html.find("]]>", at + 9) + 2
            elif html[at + 1: at + 2] in ("!", "?"):
                end = html.find(">", at)
                end = len(html) if end < 0 else end
            else:
                yield html[place: at + 1], None, ""
                place = at + 1
                continue
            if at > place:
                yield html[place:at], None, ""
            place = end + 1 if end > 1 else len(html)
            if m:
                tag, slash = m[1].lower(), html[at + 1: at + 2] == "/"
                yield tag, slash, html[m.end(): end]
                if tag in RAW and not slash:
                    text, place = self.raw(tag, place)
                    if text:
                        yield text, None, ""


def parse(html: str) -> Node:
    root = at = Node("#root", "", None)
    depth: dict[str, int] = {}  # open elements by tag

    def left(node: Node, to: Node) -> Node:
        while node is not to:
            depth[node.tag] -= 1
            node = node.parent
        return to

    raw = None
    for tag, closing, attributes in Tags(html):
        if closing is None:
            (at if raw is None else raw).children.append(tag)
            raw = None
            continue
        raw = None
        if closing:
            if depth.get(tag):  # else: no such element is open
                up = at
                while up.tag != tag:
                    up = up.parent
                at = left(at, up.parent)
            continue
        if tag in BLOCK:
            at = left(at, closed(at, 0))
        if tag in GROUP:
            at = left(at, closed(at, GROUP[tag]))
        node = Node(tag, attributes.rstrip("/"), at)
        at.children.append(node)
        if tag in RAW:
            raw = node
        elif tag not in VOID:
            at = node
            depth[tag] = depth.get(tag, 0) + 1
    return root


def closed(at: Node, group: int) -> Node:
    """Where to go on if the open elements of a group are implied to be over."""
    ends, many = GROUPS[group][0], at.open[group]
    while many:
        many -= at.tag in ends
        at = at.parent
    return at


def inside(node: Node):
    """Elements below ``node``, in page order."""
    stack = [c for c in reversed(node.children) if isinstance(c, Node)]
    while stack:
        x = stack.pop()
        yield x
        stack += [c for c in reversed(x.children) if isinstance(c, Node)]


def hash_subtrees(root: Node) -> None:
    """Set ``digest`` of all elements: 64 bits over tag, class, id and role,
    and the digests and texts below, white space collapsed."""
    order = [root, *inside(root)]
    for node in reversed(order):
        h, node.prose = hashlib.blake2b(digest_size=8), False
        h.update("\x00".join([node.tag, *(node.get(a) or "" for a in ("class", "id", "role"))]).encode())
        for child in node.children:
            if isinstance(child, Node):
                h.update(b"\x01" + child.digest)
            elif text := " ".join(child.split()):
                node.prose = True
                h.update(b"\x02" + text.encode("utf-8", "replace"))
        node.digest = h.digest()


def in_prose(node: Node) -> bool:
    """Is it a word or more of running text, such as a bold one?"""
    return node.tag not in BLOCK and node.parent is not None and node.parent.prose


def number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def blocks(node: Node, skip) -> list[str]:
    """Texts of the blocks below ``node`` in page order, without the
    subtrees for which ``skip(element)`` holds."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if text := " ".join(unescape("".join(line)).split()):
            out.append(text)
        line.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif x is node or not skip(x):
            if x.tag in BLOCK:
                end()
                stack.append(None)
            elif x.tag == "br" or x.tag in CELL:
                line.append(" ")
            stack += reversed(x.children)
    end()
    return out
