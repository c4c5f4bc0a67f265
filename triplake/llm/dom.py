"""Web pages as flat element lists: a tolerant reader of raw HTML that keeps block elements and the text of each block.

The reader follows the usual recovery rules: void elements have no content, a block element ends an open paragraph, list
items and table cells end each other, an end tag without its element is passed over, an inline end tag does not close a
block, and what is open at the end of the page ends there. Elements below 512 open ones are not opened; their text belongs
to the last that is. Work and memory are linear in the page's length. Comments, declarations and the content of elements
that never show as text (scripts, styles, titles, form values and the like) are left out.

Text between two bounds of block elements is one block; it belongs to the innermost open block element.
"""

from __future__ import annotations

import html
import re

MAX_OPEN = 512
_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)\s*+(?:=\s*+(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style title textarea template noscript iframe object select noembed noframes xmp svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var nobr blink picture audio video canvas map button".split())
CONTROLS = frozenset("input button select textarea label option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element's start ends an open one of these, up to the given bounds.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "body": ({"head"}, set())}
PARAGRAPH_BOUNDS = frozenset("table td th caption body".split())


class Pages:
    """Block elements of many pages in page and document order (parents before children), and the pages' blocks."""

    COUNTS = ("chars", "link_chars", "points", "blocks", "inlines", "controls")

    def __init__(self) -> None:
        self.page, self.parent, self.depth, self.place, self.before, self.end = [], [], [], [], [], []
        self.tag, self.attributes = [], []
        self.counts = {c: [] for c in self.COUNTS}
        self.text_page, self.text_node, self.text = [], [], []
        self.n_pages = 0

    def _open(self, tag: str, attributes: str, parent: int, children: dict[int, list[int]]) -> int:
        k = len(self.tag)
        of = children.setdefault(parent, [])
        self.page.append(self.n_pages)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.place.append(len(of))
        self.before.append(of[-1] if of else -1)
        self.end.append(k + 1)
        self.tag.append(tag)
        self.attributes.append(attributes)
        of.append(k)
        for c in self.counts.values():
            c.append(0)
        return k

    def add(self, page: str | None) -> None:
        """Read one page; null counts as empty. Every page has a root element without a tag."""
        page = page or ""
        counts = self.counts
        children: dict[int, list[int]] = {}
        root = self._open("", "", -1, children)
        stack: list[tuple[str, int]] = [("", root)]  # (tag, its element or that of its block)
        open_tags: dict[str, int] = {}
        skipped = links = 0
        parts: list[str] = []

        def flush() -> None:
            if parts:
                words = " ".join(html.unescape("".join(parts)).split())
                parts.clear()
                if words:
                    node = stack[-1][1]
                    counts["chars"][node] += len(words)
                    counts["points"][node] += words.count(".") + words.count(",")
                    counts["blocks"][node] += 1
                    self.text_page.append(self.n_pages)
                    self.text_node.append(node)
                    self.text.append(words)

        def close(depth: int) -> None:
            """Close the open elements above ``depth``."""
            nonlocal links
            flush()
            while len(stack) > depth:
                tag, node = stack.pop()
                open_tags[tag] -= 1
                links -= tag == "a"
                if tag not in INLINE:
                    self.end[node] = len(self.tag)

        def find(tags, bounds) -> int:
            """Depth of the innermost open one of ``tags``; 0 if a bound or nothing is met first."""
            if any(open_tags.get(t) for t in tags):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in tags:
                        return depth
                    if stack[depth][0] in bounds:
                        return 0
            return 0

        def text(raw: str) -> None:
            parts.append(raw)
            if links:
                counts["link_chars"][stack[-1][1]] += len(raw.strip())

        at, n = 0, len(page)
        while at < n:
            m = _TOKEN.search(page, at)
            if m is None:
                text(page[at:])
                break
            if m.start() > at:
                text(page[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in VOID or tag in HIDDEN:
                    continue
                if skipped:
                    skipped -= 1
                    continue
                depth = find({tag}, ())
                if depth and not (tag in INLINE and any(t not in INLINE for t, _ in stack[depth + 1:])):
                    if tag in INLINE:  # inline content of one block goes on
                        while len(stack) > depth:
                            t, _ = stack.pop()
                            open_tags[t] -= 1
                            links -= t == "a"
                    else:
                        close(depth)
                continue
            if tag in CONTROLS:
                counts["controls"][stack[-1][1]] += 1
            if tag in HIDDEN:
                if not (m[3] or "").rstrip().endswith("/"):
                    over = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = over.end() if over else n
                continue
            if tag in VOID:
                if tag == "br":
                    parts.append(" ")
                elif tag == "hr":
                    flush()
                continue
            if tag in INLINE:
                counts["inlines"][stack[-1][1]] += 1
                if len(stack) < MAX_OPEN:
                    stack.append((tag, stack[-1][1]))
                    open_tags[tag] = open_tags.get(tag, 0) + 1
                    links += tag == "a"
                else:
                    skipped += 1
                continue
            flush()
            if depth := find({"p"}, PARAGRAPH_BOUNDS):
                close(depth)
            if tag in ENDS and (depth := find(*ENDS[tag])):
                close(depth)
            if len(stack) >= MAX_OPEN:
                skipped += 1
                continue
            node = self._open(tag, m[3] or "", stack[-1][1], children)
            stack.append((tag, node))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        close(1)
        self.end[root] = len(self.tag)
        self.n_pages += 1


def attributes(raw: str) -> dict[str, str]:
    """Attribute values of a start tag by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out
