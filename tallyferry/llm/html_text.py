"""Main text of web pages by tree scoring.

A page becomes a small tree of elements. Every paragraph-like block earns points for its
length and its commas; they go to its ancestors, less with every level, and each
ancestor's sum is discounted by the share of its text that sits in links. The best
container wins; siblings that read like text are kept with it. Menus, headers, footers,
sidebars, notices, adverts, forms, comments, scripts and styles are cut before. A class or
an id cuts nothing that holds the article: its paragraphs then earn less instead.

Pages are independent rows, so there is no shuffle; a page is held in memory by itself.
Time grows with the length of the page, however its markup is broken or nested: open
elements are found by name, and points go up a fixed number of levels.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Elements whose content is not markup.
RAW = {"script", "style", "noscript", "textarea", "title", "template", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that begin and end a block of text.
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that are never part of the main text.
CUT = {
    "nav", "header", "footer", "aside", "form", "button", "select", "option", "input", "label", "fieldset", "dialog",
    "menu", "head", "svg", "math", "canvas", "audio", "video", "object", "embed", "map", *RAW,
}
CUT_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu",
    "menubar", "form", "note", "status", "toolbar",
}
#: Words of class and id names that mark what is not the article.
CUT_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead",
    "footer", "sidebar", "aside", "comment", "comments", "respond", "disqus", "replies", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "pagination", "pager",
    "toolbar", "widget", "widgets", "skip", "hidden", "copyright", "disclaimer", "form", "search",
}
#: Words beside them in a compound name that do not change what it marks.
NEUTRAL_NAMES = {
    "site", "page", "main", "global", "top", "bottom", "left", "right", "list", "section", "area", "block", "box", "bar",
    "container", "wrapper", "wrap", "inner", "outer", "item", "items", "post", "posts", "primary", "secondary", "link",
    "links", "button", "buttons", "group",
}
#: Names that are never those of a layout: what they mark may outweigh the article beside it.
BESIDE_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "comment", "comments",
    "respond", "disqus", "replies", "cookie", "cookies", "consent", "gdpr", "newsletter",
}
#: Share of their points that paragraphs keep below a name that marks furniture but holds the article.
DOWN = 0.25
#: Ancestors that a paragraph gives points to.
LEVELS = 32
_NO_NAMES: frozenset[str] = frozenset()
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "option": {"select"}}
_PARAGRAPHS = {"p", "pre", "td", "blockquote", "dd", "div", "section", "article", "main", "li", "body", "figcaption"}
_NAME = re.compile(r"[a-z]+|[0-9]+")


class _Node:
    __slots__ = ("tag", "parent", "parts", "cut", "names", "share", "score", "chars", "linked", "depth", "block")

    def __init__(self, tag: str, parent: _Node | None, cut: bool, names: frozenset[str] = _NO_NAMES):
        self.tag, self.parent, self.cut, self.names = tag, parent, cut, names
        self.depth = parent.depth + 1 if parent else 0
        # The nearest block, itself or around it.
        self.block: _Node = self if tag in BLOCK or parent is None else parent.block
        self.share = 1.0
        self.parts: list[_Node | str] = []
        self.score = 0.0
        self.chars = self.linked = 0


def _furniture(token: str) -> set[str]:
    """The names in a class or id that mark it as furniture: a whole token, or a compound with neutral words only."""
    words = set(_NAME.findall(token))
    found = words & CUT_NAMES
    return found if all(w in NEUTRAL_NAMES or w.isdigit() for w in words - found) else set()


def _is_cut(tag: str, attrs: str) -> tuple[bool, frozenset[str]]:
    """Whether an element is furniture by its tag, role or style, and the names of its class and id that say so."""
    if tag in CUT:
        return True, _NO_NAMES
    names = _NO_NAMES
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, names
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, names
        if name == "role" and value in CUT_ROLES:
            return True, names
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, names
        # The id of a heading names its topic.
        if name == "class" or (name == "id" and tag not in _HEADINGS):
            for token in value.split():
                names |= _furniture(token)
    return False, names


def parse(page: str) -> _Node:
    """The tree of a page; broken markup closes what it must."""
    root = _Node("html", None, False)
    node, at, lower = root, 0, None
    last = page.rfind(">") + 1
    # The open elements of each name, from the root on.
    opened: dict[str, list[_Node]] = {}

    def close(outer: _Node) -> _Node:
        """Closes an open element and all open in it; what is open then."""
        inner = node
        while inner is not outer.parent:
            opened[inner.tag].pop()
            inner = inner.parent
        return inner

    def text(piece: str) -> None:
        if piece:
            node.parts.append(entities.unescape(piece) if "&" in piece else piece)

    while True:
        found = _MARKUP.search(page, at, last) if at < last else None
        if found is None:
            text(page[at:])
            return root
        text(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            same = opened.get(tag)
            # An inline element is not closed from inside a block that it holds.
            if same and (tag in BLOCK or same[-1].depth > node.block.depth):
                node = close(same[-1])
            continue
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            ends = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{tag}", at)
            at = len(page) if ends < 0 else ends
            continue
        if tag == "br" or tag == "hr":
            node.parts.append("\n")
            continue
        if tag in VOID or tag == "html":
            continue
        if tag in BLOCK and node.block.tag == "p":
            node = close(node.block)
        if tag in _CLOSES:
            stop = max((opened[t][-1].depth for t in _STOPS[tag] if opened.get(t)), default=0)
            inside = []
            for t in _CLOSES[tag]:
                same = opened.get(t, [])
                inside += same[(k := bisect_right(same, stop, key=lambda n: n.depth)) : k + 1]
            if inside:
                node = close(min(inside, key=lambda n: n.depth))
        attrs = found["attrs"] or found["attrs2"] or ""
        child = _Node(tag, node, *_is_cut(tag, attrs))
        node.parts.append(child)
        if not attrs.rstrip().endswith("/") or tag in BLOCK:
            opened.setdefault(tag, []).append(child)
            node = child


def _measure(root: _Node) -> list[_Node]:
    """Counts characters and linked characters of every node that is not cut; returns them in page order."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append(node)
        linked = linked or node.tag == "a"
        for part in node.parts:
            if isinstance(part, str):
                n = len(part.strip())
                node.chars += n
                node.linked += n if linked else 0
        stack.extend((p, linked) for p in reversed(node.parts) if not isinstance(p, str) and not p.cut)
    for node in reversed(order):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    return order


def _link_density(node: _Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _own_text(node: _Node) -> str:
    """Text of a block itself: its strings and those of inline elements in it."""
    out, stack = [], list(reversed(node.parts))
    while stack:
        now = stack.pop()
        if isinstance(now, str):
            out.append(now)
        elif not now.cut and now.tag not in BLOCK:
            stack.extend(reversed(now.parts))
    return "".join(out)


def _points(node: _Node) -> float:
    """What a block earns for its own text."""
    if node.tag not in _PARAGRAPHS:
        return 0.0
    own = " ".join(_own_text(node).split())
    return 1 + own.count(",") + own.count("，") + min(len(own) / 100, 3) if len(own) >= 25 else 0.0


def _cut_named(root: _Node) -> None:
    """Cuts what class or id mark as furniture, unless the page's article is inside: then that earns less.

    Inside is the article if there is a ``main`` or the only ``article`` with text, or if most of
    the page's points are there. Comments and the like may outweigh the article beside them, so
    for them these hold only when there is nothing else.
    """
    order, stack, named = [], [root], False
    while stack:
        node = stack.pop()
        order.append(node)
        named = named or bool(node.names)
        stack.extend(p for p in reversed(node.parts) if not isinstance(p, str) and not p.cut)
    if not named:
        return
    points = {id(n): _points(n) for n in order}
    # Points of all but comments and the like; whether a main or an article is inside.
    layout, mains, articles = {}, {}, {}
    for node in reversed(order):
        here = id(node)
        below = [id(p) for p in node.parts if not isinstance(p, str) and not p.cut]
        layout[here] = points[here] + sum(layout[p] for p in below) if node.names.isdisjoint(BESIDE_NAMES) else 0.0
        points[here] += sum(points[p] for p in below)
        has_text = points[here] > 0
        mains[here] = has_text and (node.tag == "main" or any(mains[p] for p in below))
        articles[here] = has_text and (node.tag == "article" or any(articles[p] for p in below))
    # Whether an article or main, however short, is where no name marks it.
    stack, elsewhere, own = [(root, False, False)], False, False
    while stack:
        node, article, main = stack.pop()
        if not node.names:
            article, main = article or node.tag == "article", main or node.tag == "main"
            if (article or main) and any(isinstance(p, str) and p.strip() for p in node.parts):
                elsewhere, own = elsewhere or article, True
            stack.extend((p, article, main) for p in node.parts if not isinstance(p, str) and not p.cut)
    # Where there is nothing but comments and the like, they count as the others do.
    weight = layout if layout[id(root)] or own else points
    stack = [root]
    while stack:
        node = stack.pop()
        here = id(node)
        if node.names:
            most = weight[here] > weight[id(root)] / 2
            node.cut = not (mains[here] or most or (articles[here] and weight[here] > 0 and not elsewhere))
            node.share *= DOWN
        if not node.cut:
            for part in node.parts:
                if not isinstance(part, str) and not part.cut:
                    part.share = node.share
                    stack.append(part)


def best_nodes(root: _Node) -> list[_Node]:
    """The best container with the siblings that belong to it, in page order."""
    _cut_named(root)
    order = _measure(root)
    seen: dict[int, _Node] = {}
    for node in order:
        points = _points(node) * node.share
        if not points:
            continue
        node.score += points if node.tag not in ("p", "li") else 0
        above, share = node.parent, 1.0
        level = 1
        while above is not None and level <= LEVELS:
            above.score += points * share
            seen[id(above)] = above
            level += 1
            share = 1 / level if level > 2 else 0.5
            above = above.parent
        seen[id(node)] = node
    candidates = {k: n for k, n in seen.items() if n.tag not in ("p", "li", "html")}
    weights = {"article": 1.5, "main": 1.25}
    value = lambda n: n.score * (1 - _link_density(n)) * weights.get(n.tag, 1.0)
    if not candidates:
        return [root]
    best = max(candidates.values(), key=value)
    # Parts of one article in wrappers of their own belong together.
    above = best.parent
    while above is not None:
        if above.tag in ("article", "main"):
            best = above
        above = above.parent
    if best.parent is None or best.tag in ("article", "main", "body"):
        return [best]
    kept, least = [], 0.2 * value(best)
    for part in best.parent.parts:
        if isinstance(part, str) or part.cut:
            continue
        density = _link_density(part)
        alike = part.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote") and density < 0.25 and part.chars > 0
        if part is best or value(part) >= least or alike:
            kept.append(part)
    return kept


def blocks(nodes: list[_Node]) -> list[str]:
    """Texts of all blocks below, in page order, white space made single."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    stack: list[_Node | str | None] = list(reversed(nodes))
    while stack:
        now = stack.pop()
        if now is None:
            end()
        elif isinstance(now, str):
            line.append(now)
        elif not now.cut:
            if now.tag in BLOCK:
                end()
                stack.append(None)
            stack.extend(reversed(now.parts))
    end()
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by an empty line."""
    if not page:
        return ""
    return "\n\n".join(blocks(best_nodes(parse(page))))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without markup: ``text`` and ``n_chars`` in place of ``html_col``.

    - Null or empty html, or a page without any text: an empty text, 0 characters.
    - Broken markup, ties and repeated rows: each row is read for itself.
    - The whole page is read, whatever its length; nothing is capped.
    - Columns named ``text`` or ``n_chars`` are replaced, others pass through; an
      empty table gives an empty result.
    """
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*[f"`{c}`" for c in kept], f"`{html_col}`")
    schema = StructType([*rows.drop(html_col).schema.fields]).add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch[html_col]]
            yield batch[kept].assign(text=texts, n_chars=[len(t) for t in texts])

    return rows.mapInPandas(run, schema)
