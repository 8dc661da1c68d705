"""Main text of web pages by tree scoring (operator 6).

The page becomes a small tree. Menus, headers and footers of the page, forms, scripts, adverts and
reader comments leave it by tag, role or clear name; an id of several words, as made from a title, is no clear
name. Names that may be part of a subject (notice, related, newsletter) only lower the score inside an article,
or in a page without one: headings, paragraphs and what holds paragraphs of their own stay, lists of links and
what holds a form go. Each paragraph earns points for its length and commas and
passes them to its ancestors, less with each step; a container's points are discounted by its link density.
The best container and those of its siblings that carry text are kept, and their blocks are
written in page order; of equal containers the outer, then the earlier one is best. An `article` or `main` around
the best container stands for it, beside other articles of its parent that earn a fifth of its points. Nothing
else inside the kept elements is dropped: lists of links, short paragraphs and bare text stay.

Free style: one page needs no other, so it is a `mapInArrow` over the scan, without a shuffle, in linear time for a page.

Defined results: a null page is an empty one; an empty page has an empty text; unclosed tags end where their
parent ends, a tag cut off by the end of the page is dropped; each input row gives one row, ids as they came;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signalloom.llm.arrow import map_columns

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template nav footer aside form button select textarea input option iframe object svg canvas dialog menu head title audio video map math".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - {"body", "html", "caption", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "summary", "figcaption"}
SAME_END = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Words in class, id or role that mark what is no main text, and such as may do so.
UNWANTED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsored promo sidebar nav navbar breadcrumb breadcrumbs pagination pager "
    "comment comments disqus masthead complementary contentinfo alertdialog".split())
DOUBTFUL = frozenset(
    "promoted promotion banner banners consent gdpr cookie cookies notice notices popup modal overlay newsletter subscribe subscription signup sponsor sponsors paywall toolbar "
    "login share sharing social related recommended recommendations recommend side menu menus "
    "navigation respond reply replies discussion footer widget widgets search skip hidden alert toc tags".split())
CONTROLS = frozenset("form button select textarea input".split())
WANTED = frozenset("article body content entry main page post story text blog".split())
NAME = re.compile(r"[A-Za-z]+")
LOWER, LEAST = 0.5, 0.25  # what points count under a doubtful name; what any paragraph earns
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CUT_TAG = re.compile(r"<(?:[A-Za-z/!?][^<>]*)?\Z")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "points", "chars", "linked", "commas", "prose", "weight", "form")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.points, self.chars, self.linked, self.commas = 0.0, 0, 0, 0
        self.prose, self.weight = 0.0, 1.0  # points of the best paragraph inside; what the points count here
        self.form = False


class Tree(HTMLParser):
    """Builds the tree; elements whose end tags may be left out end where HTML ends them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("html", {}, None)

    def _close(self, tags, until) -> None:
        n = self.open
        while n is not self.root and n.tag not in until:
            if n.tag in tags:
                self.open = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and not (tag == "body" and self.open is self.root):
            return
        if tag in CLOSES_P:
            self._close({"p"}, {"td", "th", "table", "button", "object"})
        if tag in HEADINGS and self.open.tag in HEADINGS:
            self.open = self.open.parent or self.root
        if tag in SAME_END:
            same, until = SAME_END[tag]
            if tag == "tr":
                self._close({"td", "th"}, until)
                self._close({"tr"}, until)
            else:
                self._close(same, until)
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open.tag == tag and tag in ("path", "circle", "rect", "use", "svg"):
            self.open = self.open.parent or self.root

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        n, blocked = self.open, False
        while n is not self.root:
            if n.tag == tag:
                if not blocked or tag in BLOCKS:
                    self.open = n.parent
                return
            blocked = blocked or n.tag in BLOCKS and n.tag not in ("p", "li", "dd", "dt")
            n = n.parent

    def handle_data(self, data):
        self.open.children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(CUT_TAG.sub("", html))
    tree.close()
    return tree.root


def names(n: Node) -> tuple[set[str], set[str]]:
    """Words of class, role and an id of one word; words of an id of several, which may be made from a title."""
    a = n.attrs
    own = {w.lower() for w in NAME.findall(a.get("id", ""))}
    clear = {w.lower() for w in (*NAME.findall(a.get("class", "")), *NAME.findall(a.get("role", "")))}
    return (clear | own, set()) if len(own) == 1 else (clear, set() if n.tag in HEADINGS else own)


def unwanted(n: Node, in_article: bool) -> bool:
    a = n.attrs
    if n.tag in DROPPED or n.tag == "header" and not in_article:
        return True
    if "hidden" in a or a.get("aria-hidden") == "true" or HIDDEN.search(a.get("style", "")):
        return True
    clear = names(n)[0]
    if n.tag in ("html", "body", "article", "main"):
        return n.tag == "article" and bool(clear & {"comment", "comments"})
    bad = clear & UNWANTED
    return bool(bad) and not (clear & WANTED and n.tag in ("div", "section") and not bad & {"comment", "comments", "ad", "ads", "sidebar", "sponsored", "promo"})


def doubtful(n: Node) -> bool:
    if n.tag in ("html", "body", "article", "main"):
        return False
    clear, other = names(n)
    every = clear | other
    return bool(every & (DOUBTFUL | UNWANTED)) and not (clear & WANTED and n.tag in ("div", "section") and not every & {"related", "notice"})


def prune(root: Node) -> None:
    """Takes unwanted elements out, without recursion: a page may nest as deep as it likes."""
    stack, found, articles = [(root, False)], [], False
    while stack:
        n, inside = stack.pop()
        inside = inside or n.tag in ("article", "main")
        articles = articles or inside
        n.form = any(isinstance(c, Node) and c.tag in CONTROLS for c in n.children)
        n.children = [c for c in n.children if isinstance(c, str) or not unwanted(c, inside)]
        for c in n.children:
            if isinstance(c, Node):
                stack.append((c, inside))
                if doubtful(c):
                    found.append((c, inside))
    if not found:
        return
    for n in reversed(measure(root)):
        n.prose = max(n.prose, paragraph(n))
        if n.parent is not None:
            n.parent.prose = max(n.parent.prose, n.prose)
            n.parent.form = n.parent.form or n.form
    gone = set()
    for n, inside in found:
        text = n.tag in HEADINGS or n.tag == "p" or n.prose * LOWER > LEAST
        if (inside or not articles) and n.chars and text and not n.form and density(n) < 0.33:
            n.weight = LOWER
        else:
            gone.add(n)
    stack = [root]
    while stack:
        n = stack.pop()
        n.children = [c for c in n.children if c not in gone]
        for c in n.children:
            if isinstance(c, Node):
                c.weight = min(c.weight, n.weight)
                stack.append(c)


def measure(root: Node) -> list[Node]:
    """Sets characters, commas and linked characters of each node; returns the nodes in page order, parents first."""
    order, stack = [], [(root, False)]
    while stack:
        n, link = stack.pop()
        link = link or n.tag == "a"
        n.chars = n.linked = n.commas = 0
        order.append(n)
        for c in reversed(n.children):
            if isinstance(c, Node):
                stack.append((c, link))
            else:
                k = len(" ".join(c.split()))
                n.chars += k
                n.linked += k * link
                n.commas += c.count(",") + c.count("、") + c.count("，")
    for n in reversed(order):
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.linked += n.linked
            n.parent.commas += n.commas
    return order


def density(n: Node) -> float:
    return n.linked / n.chars if n.chars else 0.0


def has_blocks(n: Node) -> bool:
    return any(isinstance(c, Node) and c.tag in BLOCKS for c in n.children)


def paragraph(n: Node) -> float:
    """Points of an element as a paragraph, 0 where it is none."""
    if not n.chars or n.tag in HEADINGS or n.tag not in BLOCKS or n.parent is None:
        return 0.0
    if has_blocks(n) and not any(isinstance(c, str) and c.strip() for c in n.children):
        return 0.0
    return (0.25 + n.commas + min(n.chars / 100, 3)) * (1 - density(n))


def best_containers(root: Node) -> list[Node | str]:
    order = measure(root)
    for n in order:
        points = paragraph(n) * n.weight
        if not points:
            continue
        step, up = 1, n if has_blocks(n) else n.parent
        while up is not None and step <= 4:
            up.points += points / (1 if step == 1 else 2 if step == 2 else 3 * step)
            up, step = up.parent, step + 1
    marks = {"article": 1.5, "main": 1.3, "section": 1.1}
    scored = [(n.points * (1 - density(n)) * marks.get(n.tag, 1.0), n) for n in order if n.points > 0]
    if not scored:
        return [root] if root.chars else []
    most, top = max(scored, key=lambda x: x[0])
    up = top
    while up is not None:
        if up.tag in ("article", "main"):
            top = up
            if up.tag == "article":
                break
        up = up.parent
    if top.parent is None:
        return [top]
    return [c for c in top.parent.children if c is top or beside(c, top, most)]


def beside(c: Node | str, top: Node, most: float) -> bool:
    """Whether a sibling of the best container is part of the text."""
    if isinstance(c, str) or not c.chars:
        return isinstance(c, str) and top.tag not in ("article", "main")
    points = c.points * (1 - density(c))
    if c.tag == "article" or top.tag in ("article", "main"):
        return c.tag == top.tag and points >= 0.2 * most or c.tag in ("h1", "h2") and density(c) < 0.5
    if c.tag in ("div", "section"):
        return c.tag == top.tag and points >= max(2.0, 0.2 * most)
    return c.tag in HEADINGS or density(c) < (0.5 if c.tag in BLOCKS else 1.0)


def blocks(kept: list[Node | str]) -> list[str]:
    """Texts of the blocks of some neighbours in page order, white space inside a block as one blank."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = kept[::-1]
    while stack:
        n = stack.pop()
        if n is None:
            flush()
        elif isinstance(n, str):
            held.append(n)
        elif n.tag in ("br", "hr") or n.tag in VOID:
            held.append(" ")
        else:
            block = n.tag in BLOCKS
            if block:
                flush()
                stack.append(None)
            stack.extend(reversed(n.children))
    flush()
    return out


def main_text(html: str | None) -> str:
    root = parse(html or "")
    prune(root)
    return "\n\n".join(blocks(best_containers(root)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    def make(batch: pa.RecordBatch) -> Iterator[list]:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield [batch.column("page_id"), batch.column("url"), texts, [len(t) for t in texts]]

    typed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_columns(typed, "page_id long, url string, text string, n_chars long", make)
