"""Main text of web pages by composite text density.

Each page becomes a small tree. Parts that name themselves as something else (menus, forms,
adverts, comments, ...) are cut off: by element, by role, or by a word of their class or id. Words
that articles use too (related, legal, search, ...) count only as a whole name, and neither cut a
paragraph, heading, quotation or cell nor, as part of a longer name, a box of ordinary sentences. Every node then has a density: its characters per tag,
adjusted by how many of them are link text against the page's share; a node's density sum
adds up its children. The node with the largest sum is the core. On the path from the core to
the body, nodes are taken as long as they are dense enough: at least as the thinnest node of the
path, which is the usual threshold, and half as dense as the core, so that sections are gathered
but not a page around them. An article or main element on the path ends it. Inside the chosen
node, lists and boxes of two links or more that are mostly links are left out, but nothing in or
around a paragraph, heading, quotation, table cell or description.

Pages are independent rows; the tree of one page lives only while its row is read.

Cases: null or empty html gives an empty text; open, crossed and missing end tags are
repaired as browsers do in the plain cases; pages without a body element use the whole
document; every row gives one row, repeated ones too; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches

# Element and attribute names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head title script style noscript template nav footer header aside form button select textarea fieldset dialog"
    " menu iframe object svg math canvas audio video map".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split()
)
#: Words of class and id values that name something else, also as a part of a longer name.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu"
    " breadcrumb breadcrumbs pagination masthead footer sidebar aside comment comments discussion disqus replies"
    " cookie cookies gdpr popup modal newsletter".split()
)
#: Words that can as well describe a part of an article.
VAGUE_WORDS = frozenset(
    "promotion pager header banner rail widget related recommended share sharing social reply respond notice consent"
    " overlay subscribe subscription signup login search toolbar skip copyright legal disclaimer hidden".split()
)
#: Characters outside of links from which on a box under a vague name counts as ordinary text.
ORDINARY_CHARS = 80
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hr main menu nav ol p pre section table ul".split()
)
#: A start tag ends an open one of these, up to the given containers.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Blocks that can be a list of links, and those whose text always stays.
LINK_LISTS = frozenset("ul ol dl dir div section".split())
PROSE = frozenset("p td th dd blockquote pre caption figcaption h1 h2 h3 h4 h5 h6".split())
_P_SCOPE = frozenset("table td th button object caption".split())


class Node:
    """An element; `parts` holds its texts and child elements in page order."""

    __slots__ = (
        "chars", "children_sum", "density", "doubted", "dropped", "link_chars", "link_tags", "links", "parent", "parts", "prose",
        "tag", "tags", "vague",
    )

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, doubted: bool = False) -> None:
        self.tag, self.parent, self.dropped, self.doubted = tag, parent, dropped, doubted
        self.parts: list[str | Node] = []
        self.chars = self.link_chars = self.tags = self.link_tags = self.links = 0
        self.prose = self.vague = False
        self.density = self.children_sum = 0.0

    def children(self) -> Iterator[Node]:
        return (part for part in self.parts if isinstance(part, Node) and part.kept)

    @property
    def kept(self) -> bool:
        return not (self.dropped or self.doubted)


def _is_hidden(attributes: list[tuple[str, str | None]]) -> bool:
    """Not shown, or with a role that is none of the text's."""
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and (value or "").strip().lower() in DROPPED_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value or "", re.IGNORECASE):
            return True
    return False


def _names_other(tag: str, attributes: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """(doubted, vague): a class or id says something else than text; vague doubts wait for the text itself."""
    names = [name for key, value in attributes if key in ("class", "id") for name in (value or "").lower().split()]
    parts = {part for name in names for part in re.split(r"[^a-z0-9]+", name)}
    if not DROPPED_WORDS.isdisjoint(names) or (tag not in PROSE and not DROPPED_WORDS.isdisjoint(parts)):
        return True, False
    if tag in PROSE:
        return False, False
    if not VAGUE_WORDS.isdisjoint(names):
        return True, False
    vague = not VAGUE_WORDS.isdisjoint(parts)
    return vague, vague


def _hear_doubts(root: Node) -> None:
    """Boxes under a vague name stay if they hold ordinary text, most of it outside of links."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found += [node] if node.vague and node.doubted else []
        stack.extend(part for part in node.parts if isinstance(part, Node) and not part.dropped)
    for node in found:
        text = linked = 0
        inside = [(node, False)]
        while inside:
            one, in_link = inside.pop()
            in_link = in_link or one.tag == "a"
            for part in one.parts:
                if isinstance(part, Node):
                    if not part.dropped:
                        inside.append((part, in_link))
                elif in_link:
                    linked += len(part.strip())
                else:
                    text += len(part.strip())
        node.doubted = text < ORDINARY_CHARS or linked > text


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)

    def _close(self, names: tuple[str, ...] | frozenset[str], until: tuple[str, ...] | frozenset[str]) -> None:
        """End the nearest open element of `names`, unless one of `until` is nearer."""
        node = self.at
        while node.parent is not None and node.tag not in until:
            if node.tag in names:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._close(("p",), _P_SCOPE)
        if tag in CLOSES:
            names, until = CLOSES[tag]
            for _ in names[1:] or names:
                self._close(names, until)
        if tag == "br":
            self.at.parts.append("\n")
            return
        whole = tag in ("html", "body", "main", "article")
        node = Node(tag, self.at, tag in DROPPED or (not whole and _is_hidden(attrs)))
        if not whole:
            node.doubted, node.vague = _names_other(tag, attrs)
        self.at.parts.append(node)
        if tag in ("main", "article", "h1"):
            self._clear_doubts(node)
        if tag not in VOID:
            self.at = node

    @staticmethod
    def _clear_doubts(node: Node) -> None:
        """What holds the article is no side part, whatever its class says ("with-sidebar")."""
        while node.parent is not None and not node.dropped:
            node.doubted = False
            node = node.parent

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.at.parts.append("\n")
        elif tag in INLINE:
            # An inline end tag does not reach through the block it stands in.
            node = self.at
            while node.parent is not None and node.tag in INLINE and node.tag != tag:
                node = node.parent
            if node.tag == tag and node.parent is not None:
                self.at = node.parent
        else:
            self._close((tag,), ())

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def _postorder(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.children())
    return order[::-1]


def _measure(order: list[Node]) -> None:
    """Characters and tags below each node, own texts included, those inside links, and the links."""
    for node in order:
        own = sum(len(part.strip()) for part in node.parts if isinstance(part, str))
        node.chars = own + sum(child.chars for child in node.children())
        node.tags = sum(child.tags + 1 for child in node.children())
        node.links = (node.tag == "a") + sum(child.links for child in node.children())
        node.prose = node.tag in PROSE or any(child.prose for child in node.children())
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        else:
            node.link_chars = sum(child.link_chars for child in node.children())
            node.link_tags = sum(child.link_tags for child in node.children())


def _weigh(order: list[Node], body: Node) -> None:
    """Composite density: characters per tag, with a logarithm that falls with link text."""
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        if node.chars:
            tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
            plain = max(node.chars - node.link_chars, 1)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            inside = node.chars / links * (tags / link_tags)
            node.density = node.chars / tags * max(math.log(max(inside, 1.0)), 0.0) / base
        node.children_sum = sum(child.density for child in node.children())


def _select(body: Node, order: list[Node]) -> list[Node]:
    """The nodes that hold the main text, in page order."""
    core = max(reversed(order), key=lambda node: node.children_sum)
    if not core.children_sum or core is body:
        return [body]
    path = [core]
    while path[-1] is not body:
        path.append(path[-1].parent)
    for node in path:
        if node.tag in ("article", "main"):
            return [node]
    threshold = max(min(node.density for node in path), core.density / 2)
    top = core
    for node in path[1:-1]:
        if node.density < threshold:
            break
        top = node
    beside = max(threshold, top.density / 2)
    return [child for child in top.parent.children() if child is top or child.density >= beside]


def _link_list(node: Node) -> bool:
    return node.tag in LINK_LISTS and not node.prose and node.links >= 2 and 2 * node.link_chars > node.chars


def _blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks below a node, raw; a None-free walk without recursion."""
    buffer: list[str] = []
    stack: list[tuple[Node, Iterator]] = [(node, iter(node.parts))]
    while stack:
        current, rest = stack[-1]
        part = next(rest, None)
        if part is None:
            stack.pop()
            if current.tag not in INLINE:
                yield "".join(buffer)
                buffer = []
        elif isinstance(part, str):
            buffer.append(part)
        elif part.kept and not (_link_list(part) and not any(above.tag in PROSE for above, _ in stack)):
            if part.tag not in INLINE:
                yield "".join(buffer)
                buffer = []
            stack.append((part, iter(part.parts)))
    yield "".join(buffer)


def main_text(html: str) -> str:
    """The main text of one page: blocks in page order, white space as single blanks."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    _hear_doubts(tree.root)
    body = tree.root
    queue = [tree.root]
    while queue:
        node = queue.pop(0)
        if node.tag == "body":
            body = node
            break
        if node.tag in ("#root", "html"):
            queue.extend(part for part in node.parts if isinstance(part, Node))
    order = _postorder(body)
    _measure(order)
    _weigh(order, body)
    texts = [" ".join(block.split()) for node in _select(body, order) for block in _blocks(node)]
    return " ".join(text for text in texts if text)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html) if html else "" for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars (code points)."""
    bound_batches(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
