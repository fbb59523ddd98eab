"""Per-page HTML tree and the selector forms the extraction rules use.

Runs inside the extraction job's Python worker, one page at a time. Only
what the rule kinds need: document-order elements, parents, element
siblings, text nodes (script/style/template bodies kept apart), and a CSS
subset — type, ``.class``, ``#id``, ``[a]``, ``[a=v]``, ``[a*=v]``,
``[a^=v]``, ``[a$=v]``, ``[a~=v]``, ``:nth-of-type(n)``, the combinators
descendant, ``>``, ``~``, ``+`` and ``,`` groups.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TEXT = frozenset(("script", "style", "template"))

# --- fixed values: implicit end tags of the HTML standard (tree-construction rules) ---
# start tags that close an open <p>
P_CLOSERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre section table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# start tag → (open tags it closes, tags that stop the search)
SIBLING_CLOSERS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table", "thead", "tbody", "tfoot"))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
P_SCOPE_STOPS = frozenset(("html", "body", "table", "td", "th", "button", "applet", "object", "template"))


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "kids", "tag_counts", "order", "end", "pos", "type_pos", "_cls")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None", order: int):
        self.tag = tag
        self.attrs = attrs
        self.parent = parent
        self.children: list = []  # Node or str, in document order
        self.kids: list[Node] = []  # element children only
        self.tag_counts: dict[str, int] = {}
        self.order = order
        self.end = order  # order of the last descendant
        self.pos = 0  # index among the parent's element children
        self.type_pos = 0  # 1-based position among same-tag siblings
        self._cls = None

    # --- navigation -------------------------------------------------------
    def elements(self):
        return self.kids

    def classes(self) -> list[str]:
        if self._cls is None:
            self._cls = (self.attrs.get("class") or "").split()
        return self._cls

    def prev_siblings(self):
        """Preceding element siblings, nearest first."""
        if self.parent is None:
            return []
        return self.parent.kids[self.pos - 1 :: -1] if self.pos else []

    def next_siblings(self):
        if self.parent is None:
            return []
        return self.parent.kids[self.pos + 1 :]

    # --- text ---------------------------------------------------------------
    def strings(self):
        """Visible text nodes below this element, in document order."""
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in HIDDEN_TEXT:
                yield from c.strings()

    def raw_text(self) -> str:
        """Text of a ``<script>``/``<style>`` body, or all visible text."""
        if self.tag in HIDDEN_TEXT:
            return "".join(c for c in self.children if isinstance(c, str))
        return "".join(self.strings())

    def text(self, mode: str = "strip") -> str:
        """``strip``: stripped text nodes joined with nothing; ``newline``:
        joined with newlines; ``raw``: all text, outer whitespace stripped;
        ``all``: all text untouched."""
        if mode == "all":
            return "".join(self.strings())
        if mode == "raw":
            return "".join(self.strings()).strip()
        parts = [s.strip() for s in self.strings()]
        parts = [p for p in parts if p]
        return ("\n" if mode == "newline" else "").join(parts)

    def stripped_strings(self) -> list[str]:
        return [s.strip() for s in self.strings() if s.strip()]


class _Builder(HTMLParser):
    def __init__(self, repair: bool = False):
        super().__init__(convert_charrefs=True)
        self.repair = repair
        self.root = Node("#root", {}, None, 0)
        self.nodes = [self.root]
        self.stack = [self.root]

    def _close_from(self, i: int) -> None:
        for n in self.stack[i:]:
            n.end = len(self.nodes) - 1
        del self.stack[i:]

    def _implicit_ends(self, tag: str) -> None:
        """Browser/lxml-style repair: close what a start tag implicitly ends."""
        if tag in P_CLOSERS:
            for i in range(len(self.stack) - 1, 0, -1):
                t = self.stack[i].tag
                if t == "p":
                    self._close_from(i)
                    break
                if t in P_SCOPE_STOPS:
                    break
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self._close_from(len(self.stack) - 1)
        if tag in SIBLING_CLOSERS:
            closes, stops = SIBLING_CLOSERS[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                t = self.stack[i].tag
                if t in closes:
                    self._close_from(i)
                    break
                if t in stops:
                    break

    def _add(self, tag, attrs):
        parent = self.stack[-1]
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, parent, len(self.nodes))
        node.pos = len(parent.kids)
        node.type_pos = parent.tag_counts.get(tag, 0) + 1
        parent.tag_counts[tag] = node.type_pos
        parent.kids.append(node)
        parent.children.append(node)
        self.nodes.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        if self.repair:
            self._implicit_ends(tag)
        node = self._add(tag, attrs)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._close_from(i)
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


class Document:
    """Parsed page: ``nodes`` in document order (``nodes[0]`` is the root).

    ``repair=False`` keeps the stdlib parser's tree (nothing closes
    implicitly); ``repair=True`` applies the HTML standard's implicit end tags
    the way browsers and lxml do (a block start closes an open ``<p>``, a new
    ``<li>`` closes the previous one, a heading closes an open heading)."""

    def __init__(self, html: str, repair: bool = False):
        b = _Builder(repair)
        b.feed(html)
        b.close()
        last = len(b.nodes) - 1
        for n in b.stack:
            n.end = last
        self.nodes: list[Node] = b.nodes
        self.root = b.root

    def select(self, selector: str, scope: Node | None = None) -> list[Node]:
        groups = parse_selector(selector)
        lo, hi = (scope.order + 1, scope.end) if scope is not None else (1, len(self.nodes) - 1)
        out = []
        for n in self.nodes[lo : hi + 1]:
            if any(_match(n, g, len(g) - 1) for g in groups):
                out.append(n)
        return out

    def select_one(self, selector: str, scope: Node | None = None) -> Node | None:
        found = self.select(selector, scope)
        return found[0] if found else None

    def find_next(self, node: Node, tag: str) -> Node | None:
        """First element after ``node`` in document order (its own
        descendants included) with the given tag."""
        for n in self.nodes[node.order + 1 :]:
            if n.tag == tag:
                return n
        return None

    def following(self, node: Node, tag: str) -> list[Node]:
        """XPath ``following::tag`` — after the node's end, not descendants."""
        return [n for n in self.nodes[node.end + 1 :] if n.tag == tag]

    def text(self, mode: str = "all") -> str:
        return self.root.text(mode)


# --------------------------------------------------------------- selectors
_TOKEN = re.compile(
    r"""\s*(?P<comb>[>~+,])\s*|(?P<ws>\s+)|(?P<tag>[a-zA-Z][a-zA-Z0-9-]*|\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<uq>[^\]\s]+)))?\s*\]"""
    r"""|:nth-of-type\(\s*(?P<nth>\d+)\s*\)"""
)
_CACHE: dict[str, list] = {}


def parse_selector(selector: str) -> list[list[tuple[str, dict]]]:
    """``"a b > c, d"`` → groups of ``(combinator, compound)`` steps."""
    if selector in _CACHE:
        return _CACHE[selector]
    groups, steps, comp, comb = [], [], None, " "
    pos, s = 0, selector.strip()
    while pos < len(s):
        m = _TOKEN.match(s, pos)
        if not m or m.end() == pos:
            raise ValueError(f"unsupported selector near {s[pos:]!r}")
        pos = m.end()
        if m.group("comb") or m.group("ws"):
            c = m.group("comb") or " "
            if comp is not None:  # close the compound before this combinator
                steps.append((comb, comp))
                comp = None
            if c == ",":
                groups.append(steps)
                steps, comb = [], " "
            else:
                comb = c  # ">" "~" "+" or " " (descendant)
            continue
        if comp is None:
            comp = {"tag": None, "cls": [], "id": None, "attrs": [], "nth": None}
        if m.group("tag"):
            comp["tag"] = None if m.group("tag") == "*" else m.group("tag").lower()
        elif m.group("cls"):
            comp["cls"].append(m.group("cls"))
        elif m.group("id"):
            comp["id"] = m.group("id")
        elif m.group("attr"):
            val = m.group("dq") if m.group("dq") is not None else m.group("sq") if m.group("sq") is not None else m.group("uq")
            comp["attrs"].append((m.group("attr").lower(), m.group("op"), val))
        elif m.group("nth"):
            comp["nth"] = int(m.group("nth"))
    if comp is not None:
        steps.append((comb, comp))
    groups.append(steps)
    _CACHE[selector] = groups
    return groups


def _compound(n: Node, c: dict) -> bool:
    if n.tag == "#root":
        return False
    if c["tag"] and n.tag != c["tag"]:
        return False
    if c["id"] and n.attrs.get("id") != c["id"]:
        return False
    if c["cls"]:
        have = n.classes()
        if any(k not in have for k in c["cls"]):
            return False
    for name, op, val in c["attrs"]:
        if name not in n.attrs:
            return False
        got = n.attrs[name]
        if op is None:
            continue
        if op == "=" and got != val:
            return False
        if op == "*=" and (not val or val not in got):
            return False
        if op == "^=" and (not val or not got.startswith(val)):
            return False
        if op == "$=" and (not val or not got.endswith(val)):
            return False
        if op == "~=" and val not in got.split():
            return False
        if op == "|=" and not (got == val or got.startswith(val + "-")):
            return False
    if c["nth"] is not None and n.type_pos != c["nth"]:
        return False
    return True


def _match(n: Node, steps, i: int) -> bool:
    comb, comp = steps[i]
    if not _compound(n, comp):
        return False
    if i == 0:
        return True
    if comb == ">":
        return n.parent is not None and _match(n.parent, steps, i - 1)
    if comb == " ":
        p = n.parent
        while p is not None:
            if _match(p, steps, i - 1):
                return True
            p = p.parent
        return False
    if comb == "~":
        return any(_match(s, steps, i - 1) for s in n.prev_siblings())
    if comb == "+":
        prev = n.prev_siblings()
        return bool(prev) and _match(prev[0], steps, i - 1)
    return False
