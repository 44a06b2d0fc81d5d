"""Main text of web pages by composite text density.

Each page becomes a tree of elements. Elements that are never content (scripts, styles,
navigation, forms, elements classed as adverts, notices, comments and the like) are cut
first, but none by its class that contains `main` or `article` or most of the body's plain
characters. A class that only has such a word among others (`market-share-table`) cuts an
element of the article, or one beside its paragraphs, only where most of its text is links. For every node i that is left

    density(i) = C/T * log(C/LC * T/LT) / log(ln(C/(C-LC) * LC + LCb/Cb * C + e))

with C characters, T tags, LC characters and LT tags inside links (each 1 at least) and
LCb, Cb those of the body. A node's sum is that of its children's densities. The
subtree of the largest sum is content; so are, in subtrees as dense as the least dense
node on the path from the body to it, the subtrees of the largest sum there. A choice
inside an `article` or `main` element stands for the whole element.

Spark spreads the pages; the tree of one page is all a task holds.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked, text_slices

# Names of HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head script style noscript template nav footer aside form button select option textarea input "
                  "iframe object embed svg canvas map audio video dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
                     "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "thead", "tbody", "tfoot"),
         "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
# Words in a class, id or role that mark what is not the article.
NOISE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                  "complementary consent contentinfo cookie cookies disclaimer disqus footer gdpr header hidden login masthead menu "
                  "modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall "
                  "popup promo promotion recommended related replies responses search share sharing shoutbox sidebar "
                  "signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split())
# Of these, those with hardly another meaning, whatever word stands beside them.
PLAIN_NOISE = frozenset("ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comments disqus gdpr masthead "
                        "navbar newsletter pagination paywall promo shoutbox sidebar signup sponsored topbar".split())
# Words that only say which part of a page or list an element is.
PARTS = frozenset("area article articles author bar block body bottom box button buttons col column container content "
                  "desktop element feed form global group inner item items left link links list main meta mobile outer page "
                  "panel post posts primary reader right row secondary section site slot text thread title top unit user "
                  "wrap wrapper".split())
HEADINGS = frozenset("p h1 h2 h3 h4 h5 h6".split())
# With one of these a class says how the page is set up, not what the element is.
STATES = frozenset("has with without no not disable disabled enable enabled overflow".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "marked", "chars", "tags", "link_chars", "link_tags", "density",
                 "total", "first", "last")

    def __init__(self, tag: str, parent: "Node | None", noise: bool, marked: int = 0):
        self.tag, self.parent, self.noise, self.marked = tag, parent, noise, marked
        self.children: list = []  # nodes and texts in page order


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", None, False)
        self.open = [self.root]
        self.depths: dict[str, list[int]] = {}  # where in `open` each name stands

    def _pop_to(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.depths[node.tag].pop()
        del self.open[depth:]

    def _deepest(self, names) -> int:
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def _close(self, names, stops=()) -> None:
        depth = self._deepest(names)
        if depth > self._deepest(stops):
            self._pop_to(depth)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self._deepest((tag,)):
            return
        if tag not in INLINE and self.open[-1].tag == "head" and tag not in (
                "meta", "title", "link", "style", "script", "base", "noscript", "template"):
            self._pop_to(len(self.open) - 1)
        if tag in CLOSES_P:
            self._close(("p",), ("button", "table", "td", "th", "article", "section", "div", "blockquote", "li"))
        if tag in SAME_ENDS:
            self._close(SAME_ENDS[tag], STOPS[tag])
        inside = self._deepest(("article", "main")) > 0
        node = Node(tag, self.open[-1], _is_noise(tag, attrs, inside), _is_marked(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in ("html", "body"):
            self._close((tag,), () if tag not in INLINE else ("p", "div", "article", "section", "td", "li"))

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _is_noise(tag: str, attrs, inside_article: bool) -> bool:
    if (tag in NEVER and tag != "form") or (tag == "header" and not inside_article):
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    return any(name == "hidden" or (name == "aria-hidden" and value == "true")
               or (name == "style" and value and "display:none" in value.replace(" ", "").lower())
               for name, value in attrs)


def _is_marked(attrs) -> int:
    """How far a class, id or role names what is not the article: 2 if a word of it says
    nothing else, 1 if it names something besides (or a header), 0 if it does not."""
    found = 0
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for word in value.split():
                parts = {p.lower() for p in _PART.findall(word)}
                noise = parts & NOISE
                if noise and not parts & STATES:
                    plain = parts & PLAIN_NOISE or all(p in NOISE or p in PARTS or len(p) < 3 or p.isdigit() for p in parts)
                    found = max(found, 2 if plain and noise != {"header"} else 1)
    return found


def _cut_marked(root: Node, body: Node) -> None:
    """Cuts marked elements and forms, but those that hold the article: a `main` or `article`
    that is not marked itself, or most of the body's plain characters, unless such a `main`
    or `article` beside it has a tenth of its own (an article with many comments). What is
    marked by one word of several stays inside a `main` or `article` and beside paragraphs
    or headings, unless half of its characters or more are links."""
    nodes = _in_order(root)
    plain, chars, articles, holds, inside = {}, {}, {}, {}, {root: False}
    for node in reversed(nodes):
        inner = [c for c in node.children if isinstance(c, Node) and not c.noise]
        named = node.tag in ("main", "article") and node.marked < 2
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        chars[node] = own + sum(chars[c] for c in inner)
        plain[node] = 0 if node.tag == "a" else own + sum(plain[c] for c in inner)
        holds[node] = named or any(holds[c] for c in inner)
        articles[node] = plain[node] if named else sum(articles[c] for c in inner)
    for node in nodes:
        named = node.tag in ("main", "article") and node.marked < 2
        within = inside[node] or named
        beside = any(isinstance(c, Node) and c.tag in HEADINGS for c in node.children)
        for c in node.children:
            if isinstance(c, Node):
                inside[c] = within
                if c.marked == 1 and (within or beside) and 2 * plain.get(c, 0) > chars.get(c, 0):
                    c.marked = 0
        if (node.marked or node.tag == "form") and node.tag not in ("html", "body", "main", "article") and node is not root:
            most = 2 * plain[node] > plain[body] and 10 * (articles[body] - articles[node]) < plain[node]
            node.noise = not (holds[node] or most)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _in_order(root: Node) -> list[Node]:
    """Nodes that may be content, parents first (without recursion: pages can nest deeply)."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        node.first = node.last = len(out)  # of its subtree, in page order
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.noise]
    return out


def _weigh(nodes: list[Node], body: Node) -> None:
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len("".join(c.split()))
            elif not c.noise:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags
                node.last = max(node.last, c.last)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        node.density = _density(node, share)
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.noise)


def _density(node: Node, link_share: float) -> float:
    c, t = node.chars, max(node.tags, 1)
    if not c:
        return 0.0
    lc, lt, plain = max(node.link_chars, 1), max(node.link_tags, 1), max(c - node.link_chars, 1)
    base = math.log(c / plain * node.link_chars + link_share * c + math.e)
    return c / t * max(math.log(c / lc * t / lt), 0.0) / max(math.log(base + math.e - 1), 1e-9)


def _choose(nodes: list[Node], body: Node) -> list[Node]:
    """Content subtrees in page order."""
    inside = nodes[body.first:body.last + 1]
    best = max(inside, key=lambda n: n.total if n.total else n.density * 1e-9)
    if not best.chars:
        return []
    path, node = {best}, best
    while node is not body:
        node = node.parent
        path.add(node)
    least = min(n.density for n in path)
    chosen = _widened(best)
    found, skip = [], -1
    for node in inside:
        if node is chosen:
            found.append(chosen)
            skip = chosen.last
        elif node.first > skip and node not in path and node.chars and node.density >= least:
            inner = max(nodes[node.first:node.last + 1], key=lambda n: n.total)
            found.append(inner if inner.total else node)
            skip = node.last
    return found


def _widened(node: Node) -> Node:
    found, up = node, node
    while up is not None:
        if up.tag in ("article", "main"):
            found = up
        up = up.parent
    return found


def blocks(nodes: list[Node]) -> list[str]:
    out, words = [], []

    def end():
        text = " ".join("".join(words).split())
        if text:
            out.append(text)
        words.clear()

    for top in nodes:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                words.append(item)
            elif not item.noise:
                if item.tag == "br":
                    words.append(" ")
                elif item.tag in INLINE:
                    stack += reversed(item.children)
                else:
                    end()
                    stack.append(None)
                    stack += reversed(item.children)
        end()
    return out


def main_text(html: str | None) -> str:
    """The text of the article: its blocks, one a line; empty if there is none."""
    if not html or not html.strip():
        return ""
    root = parse(html)
    body = next((n for n in _in_order(root) if n.tag == "body"), root)
    _cut_marked(root, body)
    nodes = _in_order(root)
    _weigh(nodes, body)
    return "\n".join(blocks(_choose(nodes, body)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: the id, the url, `text`, `n_chars`. Null and empty pages have an empty text.

    Rows that repeat come back as often; a null id or url stays null. Broken markup is
    read as far as it makes a tree; text outside any tag counts as the body's.
    """
    def texts(batches):
        for frame in batches:
            pages_of = frame["html"].tolist()
            for a, b in text_slices(pages_of):
                found = [main_text(h) for h in pages_of[a:b]]
                yield pd.DataFrame({"id": frame["id"].iloc[a:b].to_numpy(), "url": frame["url"].iloc[a:b].to_numpy(),
                                    "text": found, "n": [len(t) for t in found]})

    rows = picked(pages, id=id_col, url=url_col, html=html_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(texts, f"id {kind}, url string, text string, n bigint").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.col("n").alias("n_chars"))
