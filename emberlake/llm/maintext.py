"""Main text of web pages by scoring the tree.

Paragraphs pass points for their length and commas to the elements around them, less the further away; an
element's points shrink with the share of its text that stands in links. The best element is the article,
together with those siblings that score well too. Menus, adverts, comments and the like are cut off before.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from emberlake.llm.common import slices, table

RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^>"']++)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # a start tag ends the open element of these names, unless one of the others stands between
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("article aside body button caption div html main section table td th li dd blockquote form figure".split())
DROPPED = frozenset(
    "head nav footer aside form noscript template svg math canvas object audio video button select input dialog menu "
    "datalist label".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
# Words in class or id that tell what an element is for.
ALWAYS_ASIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promoted promotion "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login comment comments "
    "commentlist disqus respond reply replies breadcrumb breadcrumbs pagination pager paywall nav navbar navigation "
    "menu share sharing sharebar social related recommended recommendations outbrain taboola".split()
)
OFTEN_ASIDE = frozenset("sidebar header footer banner notice notification alert widget masthead toolbar topbar copyright skip".split())
WHOLE = frozenset("article main content body post entry story text wrapper container page layout".split())
NEVER_DROPPED = frozenset("html body article main".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd h2 h3 h4 h5 h6 figcaption".split())
ARTICLE_BONUS = 25.0
SIBLING_SHARE = 0.2


class Node:
    __slots__ = ("tag", "attributes", "parent", "items", "score", "own", "size", "linked", "aside")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.items: list[Node | str] = []
        self.score = 0.0
        self.size = self.linked = 0
        self.aside = False


class OpenElements:
    """The elements that are open, outermost first, and where in that row each name stands.

    A tag asks for the innermost of some names at once, so its cost doesn't grow with the number of open elements;
    closing takes one step per element, once.
    """

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        for places in self._kept(node.tag):
            places.append(at)

    def cut(self, at: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.nodes) > at:
            for places in self._kept(self.nodes.pop().tag):
                places.pop()

    def _kept(self, tag: str) -> list[list[int]]:
        kept = [self.places.setdefault(tag, [])]
        if tag in BLOCKS:
            kept.append(self.blocks)
        if tag in P_SCOPE:
            kept.append(self.scopes)
        return kept

    def innermost(self, tag: str) -> int:
        """Place of the innermost open element of a name; 0, which is the root's, if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def close(self, tag: str) -> None:
        """An end tag: of a block it closes what is open inside, of anything else not beyond a block."""
        at = self.innermost(tag)
        if at and (tag in BLOCKS or not self.blocks or self.blocks[-1] <= at):
            self.cut(at)

    def make_room(self, tag: str) -> None:
        """A start tag: a block ends an open paragraph, an item the items before it."""
        if tag in BLOCKS:
            paragraph = self.innermost("p")
            if paragraph and (not self.scopes or self.scopes[-1] < paragraph):
                self.cut(paragraph)
        names, fences = CLOSES.get(tag, ((), ()))
        fence = max((self.innermost(name) for name in fences), default=0)
        after = [places[i] for name in names if (i := bisect(places := self.places.get(name, []), fence)) < len(places)]
        if after:
            self.cut(min(after))


def parse(html: str) -> Node:
    """Element tree of any text: missing end tags are supplied, stray ones ignored. Linear in the text's length."""
    root = Node("html", "", None)
    open_, at = OpenElements(root), 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            open_.nodes[-1].items.append(unescape(html[at : m.start()]))
        at = m.end()
        name = m.group(3)
        if name is None:
            continue
        tag = name.lower()
        if m.group(2):
            open_.close(tag)
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in open_.nodes[:2]):
            root.attributes += m.group(4)
            continue
        open_.make_room(tag)
        node = Node(tag, m.group(4), open_.nodes[-1])
        open_.nodes[-1].items.append(node)
        if tag not in VOID and not m.group(4).endswith("/"):
            open_.push(node)
    if at < len(html):
        open_.nodes[-1].items.append(unescape(html[at:]))
    return root


def _is_aside(node: Node, in_article: bool) -> bool:
    tag = node.tag
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not node.attributes or tag in NEVER_DROPPED and tag != "article":
        return False
    words: set[str] = set()
    for m in ATTRIBUTE.finditer(node.attributes):
        name, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value in DROPPED_ROLES:
            return True
        if name in ("class", "id"):
            words.update(re.split(r"[^a-z]+", value))
    if words & ALWAYS_ASIDE:
        return True
    return tag != "article" and bool(words & OFTEN_ASIDE) and not words & WHOLE


def _walk(root: Node) -> list[Node]:
    """All elements, each before those inside it."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def _mark_asides(nodes: list[Node]) -> None:
    holds_article = set()
    for node in reversed(nodes):
        if node.parent is not None and (node.tag in ("article", "main") or id(node) in holds_article):
            if not (node.tag == "article" and _is_aside(node, True)):
                holds_article.add(id(node.parent))
    inside: dict[int, bool] = {}
    for node in nodes:
        up = node.parent
        inside[id(node)] = node.tag in ("article", "main") or (up is not None and inside[id(up)])
        if up is not None and up.aside:
            node.aside = True
        elif id(node) not in holds_article:
            node.aside = _is_aside(node, inside[id(node)])


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        if node.tag in ("article", "main"):
            node.score += ARTICLE_BONUS
    for node in reversed(nodes):
        if node.aside:
            continue
        direct = " ".join("".join(x for x in node.items if isinstance(x, str)).split())
        node.size += len(direct)
        node.linked = node.size if node.tag == "a" else node.linked
        up = node.parent
        if up is not None:
            up.size += node.size
            up.linked += node.linked
    for node in nodes:
        if node.aside or node.tag not in BLOCKS:
            continue
        text = _inline(node)
        if not text:
            continue
        points = 1 + text.count(",") + text.count("，") + text.count("、") + len(text) / 100
        step, up = 1, node.parent if node.tag in PARAGRAPHS else node
        while up is not None and step <= 4:
            up.score += points / step
            step, up = step + 1, up.parent
    for node in nodes:
        node.score *= 1 - node.linked / max(node.size, 1)


def _inline(node: Node) -> str:
    """Text of a block without the blocks inside it."""
    parts: list[str] = []
    todo: list[Node | str] = [*reversed(node.items)]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x.tag == "br":
            parts.append(" ")
        elif not x.aside and x.tag not in BLOCKS:
            todo.extend(reversed(x.items))
    return " ".join("".join(parts).split())


def _text(nodes: list[Node]) -> str:
    """Blocks in page order, white space inside each made one space, joined by one space."""
    parts: list[str] = []
    todo: list[Node | str] = [*reversed(nodes)]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x.tag == "br":
            parts.append(" ")
        elif not x.aside:
            if x.tag in BLOCKS:
                parts.append(" ")
                todo.append(" ")
            todo.extend(reversed(x.items))
    return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    """Text of the article of a page; empty if there is none."""
    if not html:
        return ""
    root = parse(html)
    nodes = _walk(root)
    _mark_asides(nodes)
    _score(nodes)
    open_nodes = [n for n in nodes if not n.aside and n.tag in BLOCKS]
    best = max(open_nodes, key=lambda n: n.score, default=None)
    if best is None or best.score <= 0:
        return _text([root])
    up: Node | None = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None and up.size:
        best = up
    if best.parent is None:
        return _text([best])
    least = max(best.score * SIBLING_SHARE, 10.0)
    kept: list[Node] = []
    for x in best.parent.items:
        if not isinstance(x, Node) or x.aside:
            continue
        density = x.linked / max(x.size, 1)
        prose = x.tag == "p" and x.size > 80 and density < 0.25
        if x is best or (x.tag in BLOCKS and x.score >= least) or prose:
            kept.append(x)
    return _text(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        out = batch.drop_columns(["html"]).append_column("text", pa.array(texts, pa.string()))
        yield out.append_column("n_chars", pa.array([len(t) for t in texts], pa.int64()))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): main text of each page, from its whole html.

    ``pages`` has page_id, url and html; further columns are ignored. Null or empty html, and pages without
    text: empty text, 0 characters. Text without any markup is its own article. Null ids and urls are
    passed on; repeated rows each give a row. Very long pages are read whole, in time that grows with their length
    whatever the markup. Of elements with equal points the first is taken. An empty table gives an empty result.
    """
    narrow = pages.select("page_id", "url", "html")
    kinds = dict(narrow.dtypes)
    return narrow.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages", "page_id", "url", "html"))
