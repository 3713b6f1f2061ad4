"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>\"']*)")
MARK = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
WORDS = re.compile(r"[a-z]+")

# Elements of the markup language, by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
ASIDE = frozenset("nav footer aside form script style textarea title noscript xmp iframe noembed noframes template button select "
                  "svg dialog menu head object canvas fieldset".split())
ROOTS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
#: Words of classes, ids and roles that name parts beside the text.
BESIDE = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies disclaimer discussion disqus feedback footer gdpr header hidden login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion reactions related "
    "recommended replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar "
    "tooltip warning widget".split())
#: Words that with one of the above name a box of it, and words before one that tell of the layout instead.
BOXES = frozenset("area bar block box container form holder inner item items list message panel slot slots text unit wrap wrapper zone".split())
LAYOUT = frozenset("free has no not show with without".split())
#: Of the words beside the text, those that keep their meaning behind any other.
ALWAYS = frozenset("ad ads adsense advert advertisement comment comments disqus newsletter sidebar sponsored".split())
#: Elements deeper than this count as neighbours of the one at this depth; browsers do so, too, at a greater one.
DEPTH = 200
#: Share of the threshold path ratio's spread; weights of the smoothing.
SPREAD, NEAR = 0.5, (0.25, 0.5, 0.25)
#: Factor of the ratio of paths with an element whose name is in part one beside the text.
NAMED = 0.5


class Node:
    """A run of text within one block: its path, its open elements and its text."""

    __slots__ = ("chain", "linked", "main", "parts", "path", "text")

    def __init__(self, path: str, chain: tuple[int, ...], main: int) -> None:
        self.path, self.chain, self.main = path, chain, main
        self.parts: list[tuple[str, bool, tuple[int, ...]]] = []  # text, whether in a link, elements named as beside the text

    def settle(self, gone: set[int]) -> None:
        """Put the text together, without the elements whose names count."""
        parts = [(t, link) for t, link, named in self.parts if not gone.intersection(named)]
        self.text = " ".join("".join(t for t, _ in parts).split())
        self.linked = sum(len(t.strip()) for t, link in parts if link)


def beside(tag: str, attributes: str) -> tuple[bool, int]:
    """Whether an element is no text to read, and what its names say, as in ``names_beside``."""
    if tag in ASIDE:
        return True, 0
    if tag in ROOTS or not attributes:
        return False, 0
    named = 0
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and UNSEEN.search(value):
            return True, 0
        for one in value.split() if name in ("class", "id", "role") else ():
            named = max(named, names_beside(WORDS.findall(one)))
    return False, named


def names_beside(words: list[str]) -> int:
    """What a class, id or role says: 3 always beside the text, 2 beside it, 1 so in part, 0 nothing."""
    known = [w in BESIDE for w in words]
    if not any(known):
        return 0
    whole = all(k or w in BOXES for k, w in zip(known, words))
    if words[-1] in ALWAYS and not LAYOUT.intersection(words) or whole and ALWAYS.intersection(words):
        return 3
    return 2 if whole else 1


class Element(NamedTuple):
    """An open element and what it hands on to those in it."""

    tag: str
    hidden: bool  # no text to read
    linked: bool
    within: tuple[int, ...]  # numbers of the named elements
    path: str
    chain: tuple[int, ...]  # numbers of the blocks
    main: int  # number of the outermost article or main


OUTSIDE = Element("", False, False, (), "", (), 0)


class Tags:
    """The tags of a page in order; the work grows with its length, whatever quotes and brackets stay open."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.broken: set[int] = set()  # marks from which no end is found

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next tag or comment, ``/`` for end tags, the name (none for comments), the attributes."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "", "", ""
            if at < self.last[">"]:
                if page[at + 1] in "!?":
                    return at, page.find(">", at) + 1, "", "", ""
                if m := NAME.match(page, at + 1):
                    end = self.end(m.end())
                    return at, end + 1, m[1], m[2].lower(), page[m.end() : end]
            at += 1
        return None

    def end(self, at: int) -> int:
        """The bracket that ends a tag; those in quotes don't, unless a quote stays open."""
        passed, here = [], at
        while (m := MARK.search(self.page, here)) and m.start() not in self.broken:
            passed.append(m.start())
            if m[0] == ">":
                return m.start()
            if m.start() == self.last[m[0]]:
                break
            here = self.page.find(m[0], m.end()) + 1
        self.broken.update(passed)
        return self.page.find(">", at)


def text_nodes(page: str) -> list[Node]:
    """Text of a page by block, without what lies in elements beside the text.

    A name tells so, whatever the element's size, unless it holds an article, all of the text, or, but for names
    that are always beside it, all paths with content (of articles, if there are any). A name in part marks the path.
    """
    nodes: list[Node] = []
    stack: list[Element] = []
    tags = Tags(page)
    current: Node | None = None
    at = count = 0
    firm: set[int] = set()  # named elements that are always beside the text
    spared: set[int] = set()  # named elements with an article in them

    def add(raw: str) -> None:
        nonlocal current
        inner = stack[-1] if stack else OUTSIDE
        if inner.hidden:
            return
        if current is None:
            current = Node(inner.path, inner.chain, inner.main)
            nodes.append(current)
        current.parts.append((html.unescape(raw), inner.linked, inner.within))

    def close(tag: str) -> None:
        nonlocal current
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag == tag:
                if any(x.tag not in INLINE for x in stack[k:]):
                    current = None
                del stack[k:]
                return
            if tag in INLINE and stack[k].tag not in INLINE:
                return  # an inline end tag doesn't close blocks

    lower = None
    while (found := tags.after(at)) is not None:
        start, end, slash, tag, attributes = found
        if start > at:
            add(page[at:start])
        at = end
        if not tag:
            continue
        if slash:
            close(tag)
            continue
        if tag == "br":
            add(" ")
            continue
        for k in range(len(stack) - 1, -1, -1):
            if tag in CLOSED_BY.get(stack[k].tag, ()):
                close(stack[k].tag)
                break
            if stack[k].tag not in INLINE and stack[k].tag not in CLOSED_BY:
                break
        if tag not in INLINE:
            current = None
        if tag in VOID or attributes.endswith("/") and tag not in RAW:
            continue
        count += 1
        if len(stack) == DEPTH:
            stack.pop()
        outer = stack[-1] if stack else OUTSIDE
        unread, named = beside(tag, attributes)
        named = min(named, 1) if tag in HEADINGS else named
        if tag in ("article", "main"):
            spared.update(outer.within)
        if named == 3:
            firm.add(count)
        path, chain, main = outer.path, outer.chain, outer.main
        if tag not in INLINE:
            path = f"{path}/{tag}{'~' if named == 1 else ''}".lstrip("/")
            chain, main = (*chain, count), main or (count if tag in ("article", "main") else 0)
        stack.append(Element(
            tag, outer.hidden or unread or tag == "header" and not outer.main, outer.linked or tag == "a",
            (*outer.within, count) if named > 1 else outer.within, path, chain, main))
        if tag in RAW:
            lower = lower if lower is not None else page.lower()
            end = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{tag}", at)
            at = end if end >= 0 else len(page)
    if at < len(page):
        add(page[at:])
    gone = {element for node in nodes for _, _, named in node.parts for element in named} - spared
    if gone:
        for node in nodes:
            node.settle(set())
        whole = held_by_all([node for node in nodes if node.text], set())
        first = (gone & firm) - whole
        for node in nodes:
            node.settle(first)
        seen = [node for node in nodes if node.text]
        read = [node for node in seen if node.main] or seen
        content = content_paths(read)
        gone = first | gone - firm - whole - held_by_all([node for node in read if node.path in content], first)
    for node in nodes:
        node.settle(gone)
    return nodes


def held_by_all(nodes: list[Node], gone: set[int]) -> set[int]:
    """Named elements that all text of the nodes lies in, but for text in elements that are gone."""
    parts = {named for node in nodes for text, _, named in node.parts if text.strip()}
    holders = [set(named) for named in parts if not gone.intersection(named)]
    return set.intersection(*holders) if holders else set()


PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡\"'()«»„“”-]")


def content_paths(nodes: list[Node]) -> set[str]:
    """Paths whose fused ratio reaches the mean less a share of the spread."""
    if not nodes:
        return set()
    sums: dict[str, list[float]] = {}
    for node in nodes:
        part = sums.setdefault(node.path, [0, 0, 0, 0])
        size = len(node.text)
        for k, x in enumerate((size, len(PUNCTUATION.findall(node.text)), min(node.linked, size), 1)):
            part[k] += x
    ratio = {
        p: math.log1p(length / n * (1 + mark / n) * (1 - linked / length) * (NAMED if "~" in p else 1))
        for p, (length, mark, linked, n) in sums.items()}
    raw = [ratio[node.path] for node in nodes]
    padded = [raw[0], *raw, raw[-1]]
    smooth = [sum(w * x for w, x in zip(NEAR, padded[i : i + 3])) for i in range(len(raw))]
    boxes: dict[int, list[float]] = {}
    for node, value in zip(nodes, smooth):
        box = boxes.setdefault(node.chain[-2] if len(node.chain) > 1 else 0, [0.0, 0.0])
        box[0] += value * len(node.text)
        box[1] += len(node.text)
    fused = []
    for node, value in zip(nodes, smooth):
        total, length = boxes[node.chain[-2] if len(node.chain) > 1 else 0]
        fused.append((value + total / length) / 2)
    weights = [len(node.text) for node in nodes]
    mean = sum(f * w for f, w in zip(fused, weights)) / sum(weights)
    spread = math.sqrt(sum(w * (f - mean) ** 2 for f, w in zip(fused, weights)) / sum(weights))
    by_path: dict[str, list[float]] = {}
    for node, value, weight in zip(nodes, fused, weights):
        part = by_path.setdefault(node.path, [0.0, 0.0])
        part[0] += value * weight
        part[1] += weight
    return {p for p, (value, weight) in by_path.items() if value / weight >= mean - SPREAD * spread - 1e-9}


def main_text(page: str) -> str:
    """Text of the page's article, blocks in page order joined by a space.

    Per tag path the text length and the punctuation per node are multiplied, less what is in links; the
    logs are smoothed over neighbouring nodes and fused with the mean of the nodes in the same container.
    Paths whose fused ratio reaches the mean less a share of the spread hold content; the deepest element that
    holds all of them, but none within an article or main, is the container, and all its blocks but mere lists
    of links are the text. If it is the page itself, blocks below the threshold need content beside them.
    """
    nodes = [(n, n.text) for n in text_nodes(page) if n.text]
    if not nodes:
        return ""
    content = content_paths([node for node, _ in nodes])
    chains = [node.chain for node, _ in nodes if node.path in content]
    common = list(chains[0])
    for chain in chains:
        while common and tuple(common) != chain[: len(common)]:
            common.pop()
    # A single paragraph is not the article, only what holds paragraphs is.
    leaf = {node.chain[-1] for node, _ in nodes if node.chain} - {e for node, _ in nodes for e in node.chain[:-1]}
    while common and common[-1] in leaf:
        common.pop()
    mains = {node.main for node, _ in nodes if node.path in content} - {0}
    outer = [e for e in common if e in mains]
    article = outer[0] if outer else common[-1] if common else None
    pages = {n for node, _ in nodes for t, n in zip(node.path.split("/"), node.chain) if t in ("html", "body")}
    with_content = {node.chain[-2] if len(node.chain) > 1 else 0 for node, _ in nodes if node.path in content}
    kept = []
    for node, text in nodes:
        if article is not None and article not in node.chain:
            continue
        if (article is None or article in pages) and node.path not in content and node.main not in mains:
            if (node.chain[-2] if len(node.chain) > 1 else 0) not in with_content:
                continue
        if node.linked >= 0.8 * len(text) and not text.endswith((".", "!", "?")) and node.path not in content:
            continue
        kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, ``text``, ``n_chars``.

    Null, empty and text-free pages give an empty text; broken markup is read as far as it goes. Rows that
    repeat or lack an id are handled like others; an empty table gives no rows; other columns play no part.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) if p else "" for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]
    found = rows.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
