"""Main text of web pages by composite text density.

Every page becomes a tree. What is never part of an article (menus, footers, adverts, forms, scripts,
comments and the like, by element, role or class name) is cut off. For each remaining node the composite
density is its characters per tag, scaled down by the share of characters and tags that lie in links. The
densities of a node's children are summed; the node with the largest sum leads to the article, and the
least density on its path from the body is the threshold: of every node at or above it, the descendant
with the largest sum is content as well. The smallest subtree that holds all of this content, widened to
the outermost article or main element around it, is the main text.

Null, empty and unparsable pages give an empty text, tags left open are closed where HTML would close them,
repeated rows are treated alike, an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from tokenloom.llm.common import fresh, kept_names, text_slices

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form head iframe input label legend map "
    "menu nav noembed noframes noscript object option script search select style svg template textarea title video xmp".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
P = frozenset(["p"])
CELLS = frozenset("button td th caption table object li dd dt article section".split())
# What a start tag closes, and the elements that it doesn't look beyond.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
BOILERPLATE = frozenset(
    "ad ads adbox advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs cookie cookies "
    "consent disclaimer footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
    "pagination pager paywall popup promo promoted promotion recommended related share sharing sidebar sidebars signup "
    "skip-link social sponsor sponsored sponsors subscribe subscription tagcloud toolbar topbar widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist comment-list disqus replies respond".split())
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PARTS = re.compile(r"[\s_]+")


KEPT = frozenset(["", "in"])
#: Below this the page has hardly any links, and the scale by link shares would blow up.
LEAST_BASE = 2.0


class Node:
    __slots__ = ("chars", "children", "density", "kind", "link_chars", "link_tags", "name", "parent", "total", "tags")

    def __init__(self, name: str, parent: Node | None, kind: str = ""):
        self.name, self.parent, self.kind = name, parent, kind
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _kind(name: str, attributes: str) -> str:
    """``out`` for what is no part of an article, ``in`` for an article's own element.

    ``maybe`` and ``comment`` are names of classes that say ``out``, unless a heading or an article turns out to lie inside.
    """
    found: dict[str, str] = {}
    if attributes.strip():
        for k, a, b, c in _ATTRIBUTE.findall(attributes):
            found.setdefault(k.lower(), a or b or c or "")
    role = found.get("role", "").strip().lower()
    if name in OUTSIDE or role in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return "out"
    if "style" in found and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found["style"], re.I):
        return "out"
    if name not in ("html", "body", "main", "h1"):
        for word in _NAME_PARTS.split(f"{found.get('class', '')} {found.get('id', '')}".lower()):
            parts = {word, *word.split("-")}
            if not COMMENTS.isdisjoint(parts):
                return "comment"
            if name != "article" and not BOILERPLATE.isdisjoint(parts):
                return "maybe"
    own = name in ("article", "main") or role in ("article", "main") or found.get("itemprop", "").lower() == "articlebody"
    return "in" if own else ""


def parse(page: str) -> Node:
    """The tree of a page, with every node's kind. Script, style and the like have no content."""
    root = Node("#root", None)
    here, at, size = root, 0, len(page)
    search, opened = _TOKEN.search, Counter()

    def close(node: Node) -> Node:
        """Close ``node`` and all that is open inside it."""
        inner = here
        while True:
            opened[inner.name] -= 1
            if inner is node:
                return node.parent
            inner = inner.parent

    while at < size:
        m = search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if opened[name]:
                node = here
                while node.name != name and not (name not in BLOCKS and node.name in BLOCKS):
                    node = node.parent
                if node.name == name:  # an inline end tag doesn't close blocks
                    here = close(node)
            continue
        if name in BLOCKS and opened["p"] and (node := _open(here, P, CELLS)):
            here = close(node)
        if name in CLOSES and any(opened[x] for x in CLOSES[name][0]):
            while node := _open(here, *CLOSES[name]):
                here = close(node)
        kind = _kind(name, m[3])
        if name == "header" and not kind and not _inside(here):
            kind = "out"
        node = Node(name, here, kind)
        here.children.append(node)
        if kind != "out" and (name in ("h1", "main", "article") or kind == "in"):
            _spare(here, name)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif name not in VOID:
            here = node
            opened[name] += 1
    return root


def _open(here: Node, names: frozenset[str], stop: frozenset[str]) -> Node | None:
    """The nearest open element with one of ``names``, unless one of ``stop`` is nearer."""
    while here is not None and here.name not in stop:
        if here.name in names:
            return here
        here = here.parent
    return None


def _inside(here: Node | None) -> bool:
    while here is not None and here.kind != "in":
        here = here.parent
    return here is not None


def _spare(here: Node | None, name: str) -> None:
    """A heading or an article lies here: class names of the elements around it are about layout."""
    while here is not None:
        if here.kind == "maybe" or (here.kind == "comment" and name != "article"):
            here.kind = ""
        here = here.parent


def _children(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and c.kind in KEPT]


def _walk(root: Node) -> list[Node]:
    """All nodes that are left, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(_children(node)))
    return out


def measure(nodes: list[Node]) -> None:
    """Characters, tags and link shares of every node, then densities and the sums of their children's."""
    for node in reversed(nodes):
        node.chars += sum(len("".join(unescape(c).split())) for c in node.children if isinstance(c, str))
        for child in _children(node):
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.link_tags += child.link_tags + (child.name == "a")
        if node.name == "a":
            node.link_chars = node.chars
    body_ratio = nodes[0].link_chars / max(1, nodes[0].chars)
    for node in nodes:
        c, lc, t, lt = node.chars, max(1, node.link_chars), max(1, node.tags), max(1, node.link_tags)
        if not c:
            continue
        base = max(LEAST_BASE, log(c / max(1, c - node.link_chars) * node.link_chars + body_ratio * c + e))
        node.density = c / t * max(0.0, log(c / lc * t / lt) / log(base))
    for node in nodes:
        node.total = sum(c.density for c in _children(node))


def main_node(root: Node) -> Node:
    """The smallest subtree that holds the content, or the outermost article or main element around it."""
    nodes = _walk(root)
    measure(nodes)
    best: dict[int, Node] = {}
    for node in reversed(nodes):  # the descendant, or self, with the largest sum; the outer one of equals
        found = node
        for child in _children(node):
            if best[id(child)].total > found.total:
                found = best[id(child)]
        best[id(node)] = found
    lead = best[id(root)]
    path = []
    node = lead
    while node is not None:
        path.append(node)
        node = node.parent
    body = next((n for n in reversed(path) if n.name == "body"), path[-1])
    threshold = min(n.density for n in path[: path.index(body) + 1])
    marked, todo = {id(lead)}, [body]
    content = [lead]
    while todo:
        node = todo.pop()
        for child in _children(node):
            if child.density >= threshold and child.chars:
                if id(best[id(child)]) not in marked:
                    marked.add(id(best[id(child)]))
                    content.append(best[id(child)])
                todo.append(child)
    found = node = _common(content, body)
    while node is not None:
        if node.kind == "in":
            found = node
        node = node.parent
    return found


def _common(nodes: list[Node], body: Node) -> Node:
    """The deepest node that holds all of ``nodes``."""
    shared: list[Node] | None = None
    for node in nodes:
        line = []
        while node is not None:
            line.append(node)
            node = node.parent
        line.reverse()
        if shared is None:
            shared = line
        else:
            n = 0
            while n < min(len(shared), len(line)) and shared[n] is line[n]:
                n += 1
            shared = shared[:n]
    return shared[-1] if shared else body


def blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks of a subtree in page order: references decoded, white space turned into one space."""
    held: list[str] = []

    def flush() -> Iterator[str]:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            yield text

    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            yield from flush()
        elif isinstance(item, str):
            held.append(item)
        elif item.kind not in KEPT:
            if item.name in BLOCKS:
                yield from flush()
        elif item.name == "br":
            held.append(" ")
        else:
            block = item.name in BLOCKS
            if block:
                yield from flush()
                todo.append(None)
            todo.extend(reversed(item.children))
    yield from flush()


def main_text(page: str | None) -> str:
    return "\n\n".join(blocks(main_node(parse(page)))) if page and page.strip() else ""


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``text``, the main text of every whole page (``_text`` if that name is taken); other columns stay."""
    out = fresh(pages, "text")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in text_slices(batches, html_col):
            texts = pa.array([main_text(p) for p in rows.column(html_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*rows.columns, texts], names=[*rows.schema.names, out])

    schema = ", ".join(f"`{c}` {t}" for c, t in pages.dtypes)
    return pages.select(*kept_names(pages)).mapInArrow(run, f"{schema}, `{out}` string")
