"""HTML to a tree of blocks: block elements and the runs of text between them, as columns of numbers for many pages at once.

Inline markup belongs to its run. A small reader for real pages: tags may be left open or closed twice, comments and raw text
may hold anything, and nothing recurses, so depth is no limit.
"""

from __future__ import annotations

import html
import re

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript ol optgroup option p pre search "
    "section select summary table tbody td template tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes".split())
EMPTY = frozenset("hr".split())
#: What an opening tag closes, and the elements that such a search doesn't leave.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
WITHIN_P = frozenset(("button", "label", "select", "option", "optgroup", "iframe", "noscript", "template"))
SCOPES = frozenset(("td", "th", "table", "caption", "button", "template"))
TABLE = frozenset(("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"))

#: Words of class, id, role and the like, by what they say about an element.
SAYS = {
    "advert": "ad ads advert adverts advertisement advertising adsense adsbygoogle adslot sponsor sponsored sponsors promo promotion banner commercial outbrain taboola affiliate",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs tabs toolbar pagination pager toc skip sitemap categories tags links",
    "side": "sidebar side aside rail related recommended recommendations popular trending teaser teasers widget widgets complementary secondary",
    "comment": "comment comments commentlist respond reply replies disqus discussion review reviews guestbook responses thread",
    "notice": "notice notices cookie cookies consent gdpr alert alertdialog warning popup modal overlay paywall disclaimer notification announcement dialog privacy",
    "form": "form search searchbox login signup signin register subscribe subscription newsletter contact field",
    "share": "share sharing social follow facebook twitter like likes print sharebar",
    "edge": "header footer masthead topbar bottom copyright colophon legal branding logo contentinfo foot head top",
    "text": "article articlebody content main post entry story text body blog hentry prose maincontent bodytext",
}
GROUPS = tuple(SAYS)
HIDDEN = len(GROUPS)
WORDS = {word: 1 << k for k, words in enumerate(SAYS.values()) for word in words.split()}
#: Kinds of elements; a run is kind 0.
KINDS = {
    "paragraph": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu dir", "item": "li dt dd", "table": "table thead tbody tfoot tr td th caption",
    "box": "div center body html section fieldset details", "article": "article", "main": "main", "nav": "nav", "header": "header", "footer": "footer address",
    "aside": "aside", "form": "form search", "control": "button label select option optgroup legend summary", "quote": "blockquote pre figure figcaption",
    "dialog": "dialog", "unseen": "head noscript template iframe frameset hr",
}
KIND = {name: k for k, names in enumerate(KINDS.values(), 1) for name in names.split()}
KIND_NAMES = ("run", *KINDS)

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+>?"""
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NAMING = frozenset(("class", "id", "role", "itemprop", "aria-label", "data-testid", "data-component"))
_MEMO: dict[str, int] = {}


def says(attributes: str) -> int:
    """Bits of the groups that the attributes name, and of HIDDEN."""
    bits = _MEMO.get(attributes)
    if bits is None:
        bits = 0
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in _NAMING:
                for part in _PART.findall(value):
                    bits |= WORDS.get(part.lower(), 0)
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                bits |= 1 << HIDDEN
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                bits |= 1 << HIDDEN
        if len(_MEMO) >= 20_000:
            _MEMO.clear()
        if len(attributes) <= 200:
            _MEMO[attributes] = bits
    return bits


class Blocks:
    """Nodes of many pages in page order, so a subtree is the range from a node to its `end`. Columns are lists of equal length."""

    COLUMNS = "parent end kind own_says all_says all_kinds depth nth previous chars links words stops".split()

    def __init__(self) -> None:
        for name in self.COLUMNS:
            setattr(self, name, [])
        self.texts: list[str | None] = []
        self.children: list[int] = []
        self.last_child: list[int] = []
        self.pages: list[int] = []

    def _node(self, parent: int, kind: int, bits: int, text: str | None, links: int = 0) -> int:
        at = len(self.parent)
        top = parent < 0
        self.parent.append(parent)
        self.end.append(at + 1)
        self.kind.append(kind)
        self.own_says.append(bits)
        self.all_says.append(bits if top else bits | self.all_says[parent])
        self.all_kinds.append(1 << kind if top else 1 << kind | self.all_kinds[parent])
        self.depth.append(0 if top else self.depth[parent] + 1)
        self.nth.append(0 if top else self.children[parent])
        self.previous.append(-1 if top else self.last_child[parent])
        if not top:
            self.children[parent] += 1
            self.last_child[parent] = at
        self.children.append(0)
        self.last_child.append(-1)
        self.texts.append(text)
        if text is None:
            counts = (0, 0, 0, 0)
        else:
            counts = (len(text), min(links, len(text)), text.count(" ") + 1, sum(text.count(c) for c in ".!?,;"))
        for column, value in zip((self.chars, self.links, self.words, self.stops), counts):
            column.append(value)
        return at

    def add_page(self, source: str | None) -> None:
        """Appends the nodes of one page; null is a page without text."""
        source = source or ""
        root = self._node(-1, KIND["body"], 0, None)
        self.pages.append(root)
        stack: list[tuple[str, int]] = [("", root)]
        opened: dict[str, int] = {}
        pieces: list[str] = []
        links, link_level = 0, 0

        def flush() -> None:
            nonlocal links
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self._node(stack[-1][1], 0, 0, text, links)
                pieces.clear()
            links = 0

        def pop_to(level: int) -> None:
            nonlocal link_level
            flush()
            while len(stack) > level:
                name, node = stack.pop()
                opened[name] -= 1
                self.end[node] = len(self.parent)
            if len(stack) < link_level:
                link_level = 0

        def close(names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
            if any(opened.get(n) for n in names):
                for level in range(len(stack) - 1, 0, -1):
                    if stack[level][0] in names:
                        return pop_to(level)
                    if stack[level][0] in stops:
                        return None
            return None

        at, last_tag_end = 0, source.rfind(">")
        while at < len(source):
            if at > last_tag_end and source[at] == "<" and source[at + 1 : at + 2].isalpha():
                break  # a tag that never ends
            token = _TOKEN.match(source, at)
            at = token.end()
            closing, name, attributes, loose, loose_attributes = token.groups()
            if loose:
                name, attributes = loose, loose_attributes
            if name:
                name = name.lower()
                if name in RAW:
                    end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                    at = end.end() if end else len(source)
                elif name in BLOCKS:
                    flush()
                    if name in ("html", "body") and opened.get(name):
                        continue
                    if name not in WITHIN_P:
                        close({"p"}, SCOPES)
                    if name in CLOSES:
                        close(*CLOSES[name])
                    elif name in HEADINGS and stack[-1][0] in HEADINGS:
                        pop_to(len(stack) - 1)
                    if name == "body":
                        close({"head"}, frozenset())
                    node = self._node(stack[-1][1], KIND[name], says(attributes), None)
                    if name not in EMPTY:
                        stack.append((name, node))
                        opened[name] = opened.get(name, 0) + 1
                elif name == "br":
                    pieces.append("\n")
                elif name == "a":
                    link_level = len(stack)
            elif closing:
                closing = closing.lower()
                if closing == "a":
                    link_level = 0
                elif closing in HEADINGS:
                    close(HEADINGS, SCOPES)
                elif closing in BLOCKS:
                    close({closing}, frozenset() if closing in TABLE or closing in ("body", "html") else SCOPES)
            else:
                piece = token.group()
                if piece[0] != "<":
                    if "&" in piece:
                        piece = html.unescape(piece)
                    pieces.append(piece)
                    if link_level:
                        links += len(piece)
                elif piece == "<":
                    pieces.append(piece)
                elif piece.startswith("<![CDATA["):
                    pieces.append(piece[9:].removesuffix("]]>"))
        pop_to(1)
        self.end[root] = len(self.parent)
