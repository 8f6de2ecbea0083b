"""Main text of web pages by the text that each tag path carries."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)")
PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：]")

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "button", "cite", "code", "data", "del", "dfn", "em",
          "font", "i", "img", "ins", "kbd", "label", "mark", "math", "meter", "object", "output", "progress", "q", "rp", "rt",
          "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}  # no tags inside
NO_TEXT = {"noscript", "select", "svg", "canvas", "template", "head", "audio", "video"} | RAW
APART = {"nav", "footer", "aside", "dialog", "menu"}
# A start tag closes an open element of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BOUNDARY = {"table", "ul", "ol", "dl", "td", "th", "div", "section", "article", "main", "body", "html", "blockquote"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HOLDERS = {"html", "body", "main", "article", "section", "div", "table", "tbody", "tr", "td", "center", "span"}
# Words of class, id and role of what stands beside an article.
BESIDE = set("""ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promos promotion
    banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget widgets footer foot comment comments
    commentlist disqus reply replies respond notice notices notification cookie cookies consent gdpr popup modal overlay
    newsletter subscribe subscription signup login register share sharing social related recommended recommendations pagination
    pager toolbar masthead alert copyright form search complementary contentinfo dialog feedback outbrain
    taboola teaser teasers skip""".split())
ABOVE = {"header", "banner", "masthead", "topbar"}  # beside the article where they stand outside of it
# Words that a name can end in and still mean what stands before them.
PLACES = set("""left right top bottom main wrapper wrap container box area section block inner outer list item items link links
    bar panel column col row""".split())
# Weights of a path for each of its elements: marked as beside an article, or an article itself.
OF_BESIDE, OF_ARTICLE = 0.05, 2.0


@dataclass
class Element:
    tag: str
    path: int
    parent: Element | None
    apart: bool  # without text of a reader
    article: bool  # in an article
    block: bool
    beside: bool = False  # by its words, or a form
    first: int = 0  # its blocks: from this one to the one before ``last``
    last: int = 0
    weight: float = 1.0
    marked: bool = False  # it or an element around it counts as beside


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    holder: Element
    score: float = 0.0


def _words(attributes: str) -> tuple[list[str], bool, bool]:
    """Words of class, id and role; whether a name among them means something beside an article; whether it is hidden."""
    words, beside, hidden = [], False, False
    for name, a, b, c, bare in ATTRIBUTE.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name in ("class", "id", "role"):
            for part in value.split():
                split = [w for w in re.split(r"[^a-z]+", part) if w]
                words += split
                while len(split) > 1 and split[-1] in PLACES:
                    split.pop()
                beside |= bool(split) and split[-1] in BESIDE and not {"has", "with", "no", "without"} & set(split)
        hidden |= bool(bare) or name == "aria-hidden" and value == "true"
        hidden |= name == "style" and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
    return words, beside, hidden


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks of text of a page in order, and its elements, outer ones first. Equal paths of tags have equal numbers."""
    root = Element("html", 0, None, False, False, True)
    node, blocks, elements = root, [], [root]
    paths: dict[tuple[int, str], int] = {}
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            blocks.append(Block(text, linked, holder()))
        linked = 0

    def leave(upto: Element) -> Element:
        """Closes what is open inside of ``upto``."""
        at = node
        while at is not upto:
            at.last, at = len(blocks), at.parent
        return upto

    def holder() -> Element:
        at = node
        while not at.block and at.parent:
            at = at.parent
        return at

    def add(text: str) -> None:
        nonlocal linked
        if text and not node.apart:
            parts.append(text)
            if in_link:
                linked += len("".join(text.split()))

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        ending, attributes = found["end"] or found["end2"], found["attrs"] or found["attrs2"] or ""
        if name == "a":
            in_link = 0 if ending else 1
        if name == "br":
            add(" ")
        block = name not in INLINE
        if block and (not ending or name != "html"):
            flush()
        if ending:
            closing = node
            while closing.parent and closing.tag != name and not (name in INLINE and closing.block) \
                    and not (name in ("p", "li") and closing.tag in BOUNDARY and closing.tag != name):
                closing = closing.parent
            if closing.tag == name and closing.parent:
                node = leave(closing.parent)
            continue
        if name in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in VOID or attributes.endswith("/") and name not in HOLDERS | {"p", "a"}:
            continue
        if block and not node.apart:  # a block closes an open paragraph
            inner = node
            while inner.parent and inner.tag not in BOUNDARY and inner.tag != "p" and inner.tag not in CLOSES.get(name, ()):
                inner = inner.parent
            if inner.parent and (inner.tag == "p" or inner.tag in CLOSES.get(name, ())):
                node = leave(inner.parent)
        words, beside, hidden = _words(attributes) if attributes else ([], False, False)
        if not block and not hidden:
            continue
        article = name in ("article", "main")
        above = not (node.article or article) and (name == "header" or bool(ABOVE & set(words)))
        label = ".".join([name, *words[:2]])
        node = Element(name, paths.setdefault((node.path, label), len(paths) + 1), node,
                       bool(node.apart or hidden or name in NO_TEXT), node.article or article, block,
                       (beside or name == "form" or above) and name not in ("html", "body", "article", "main"), len(blocks))
        elements.append(node)
    flush()
    leave(root)
    root.last = len(blocks)
    return blocks, elements


def weigh(blocks: list[Block], elements: list[Element]) -> None:
    """Weights by tags and words. A word says nothing of an element that holds most of the page's text."""
    upto = np.concatenate([[0], np.cumsum([len(b.text) - min(b.links, len(b.text)) for b in blocks])])
    for e in elements:
        around = e.parent or e
        marks = e.beside and 2 * (upto[e.last] - upto[e.first]) < upto[-1]
        e.marked = around.marked or e.tag in APART or bool(marks)
        own = OF_ARTICLE if e.tag in ("article", "main") and not around.article else 1.0
        e.weight = OF_BESIDE if e.marked else min(around.weight * own, OF_ARTICLE)


def score(blocks: list[Block], radius: int = 2) -> None:
    """Gives each block its path's ratio of text and of punctuation to nodes, fused, smoothed over the page's order and
    weighed by the marks on the path."""
    chars, marks, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in blocks:
        chars[b.holder.path] += len(b.text) - min(b.links, len(b.text))
        marks[b.holder.path] += len(PUNCTUATION.findall(b.text))
        nodes[b.holder.path] += 1
    raw = np.array([chars[p] / nodes[p] * (1 + marks[p] / nodes[p]) for p in (b.holder.path for b in blocks)])
    window = np.exp(-0.5 * np.arange(-radius, radius + 1) ** 2)
    smooth = np.convolve(np.pad(raw, radius), window / window.sum(), "valid")
    for b, own, around in zip(blocks, raw, smooth):
        b.score = float(np.sqrt(max(own, 0) * max(around, 0))) * b.holder.weight


def content_paths(blocks: list[Block]) -> set[int]:
    """Paths whose blocks' mean score reaches the deviation of scores over the page."""
    by_path = defaultdict(list)
    for b in blocks:
        by_path[b.holder.path].append(b.score)
    threshold = min(float(np.std([b.score for b in blocks])), max(b.score for b in blocks))
    return {p for p, s in by_path.items() if np.mean(s) >= threshold and max(s) > 0}


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, one to a line."""
    blocks, elements = blocks_of(page or "")
    if not blocks:
        return ""
    weigh(blocks, elements)
    score(blocks)
    content = content_paths(blocks) or {b.holder.path for b in blocks if not b.holder.marked}
    chosen = [i for i, b in enumerate(blocks) if b.holder.path in content]
    if not chosen:
        return ""
    place = _place(blocks, chosen)
    return "\n".join(b.text for b in blocks[place.first:place.last] if not b.holder.marked or b.holder.path in content)


def _place(blocks: list[Block], chosen: list[int]) -> Element:
    """The innermost element that holds every chosen block; from there to the edge of an article around it, or out to where
    only headings are added."""
    at = blocks[chosen[0]].holder
    while at.parent and (at.first > chosen[0] or at.last <= chosen[-1] or at.tag not in HOLDERS):
        at = at.parent
    while at.parent:
        added = [*blocks[at.parent.first:at.first], *blocks[at.last:at.parent.last]]
        inside = at.parent.article and at.parent.weight >= OF_ARTICLE
        if not inside and any(not (b.holder.tag in HEADINGS or b.holder.marked) for b in added):
            break
        at = at.parent
    return at


def extract(page: Column) -> Column:
    """The main text of each page.

    Text is gathered in blocks, each with its path of tags from the root (with the first words of class and id). What is
    no text of a page (comments, scripts, styles, the head, hidden elements) is left out. Each path gets its text per block
    times one more than its punctuation per block; the value is smoothed over the blocks' order, joined with the path's own, and
    weighed: low where tags or the words of class, id and role mark an element as a menu, header, footer, sidebar,
    notice, advert, form or readers' comments (words: unless it holds most of the page's text), and high inside an article element.
    Paths whose mean reaches the page's standard deviation are content. The result is the innermost element that holds
    every block of content, with the rest of an article element around it or the headings before it: its blocks in order,
    one to a line, without marked ones that are not content themselves; references are decoded and white space is turned
    into one space. A line break element counts as white space. Null, empty and textless pages give an empty text.
    """

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return of(page)
