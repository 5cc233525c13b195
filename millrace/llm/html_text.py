"""Main text of web pages by tag-path ratios.

A page is read into text nodes, each with its root-to-leaf tag path. Per path, text length and punctuation are summed
and divided by the path's nodes; both ratios are laid back on the nodes in page order, smoothed with their neighbours
and fused. Nodes whose fused ratio reaches the threshold (a part of the mean over the page) are content nodes. The
article is the ``article`` and ``main`` elements with content where they hold most of its text, else the smallest
element that holds nearly all of it. Every node of the article counts, short ones too, but for parts that are marked as
menu, header, footer, sidebar, notice, advert, form or reader comments by tag, role, class or id. A name with other words
too (an id ``social-impact``; inside the article also such a class) only marks a part whose text the ratios do not
choose. Ids do not mark headings and paragraphs, and neither ids nor such classes mark parts of the article that start
with a heading. Content nodes outside it count too, with the inline nodes of their blocks and the headings before them. If no element below the body holds
the content together, that and the headings among it are the text.

Null html gives empty text. Unclosed, crossed and unknown tags, unterminated comments and half character references
are read as browsers read them. Pages are handled one by one: repeated rows, null ids and urls and extra columns have
no effect.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from itertools import takewhile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Piece, map_pieces

PART_OF_MEAN = 0.5
HELD = 0.95
MOST_OF_PAGE = 2 / 3

# Tags and marks of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select option".split())
OPEN_ENDED = frozenset("svg select option".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody
td tfoot th thead tr ul""".split())
SKIPPED = frozenset("""head nav footer aside form menu button label fieldset dialog canvas audio video object
annotation annotation-xml""".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
SKIPPED_MARKS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice
notices pager pagination paywall popup promo promoted related reply replies respond responses share sharing sidebar
signup skip social sponsor sponsored subscribe toolbar topbar widget""".split())
LAYOUT = frozenset("area block box bar button buttons container icons inner items link links list panel posts section wrap wrapper".split())
HOLDING = frozenset("with has no without main content article post body wrapper page".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset(["", *"html body div section main article center table tbody tr td".split()])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>""")
_MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# What ends a raw element; group 1: a block that ends one of OPEN_ENDED, which its own end tag is missing for.
_ANY_BLOCK = "|".join(sorted(BLOCK - {"hr"}))
_END_OF = {t: re.compile(rf"</{t}\b[^>]*>" + (rf"|(</?(?:{_ANY_BLOCK})(?=[\s/>]))" if t in OPEN_ENDED else ""), re.I) for t in RAW}
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")


@dataclass
class Element:
    tag: str
    parent: int
    path: str
    skipped: bool = False  # for good, by tag or role
    marked: bool = False  # by class or id; void if the element turns out to hold the article
    slug: bool = False  # marked by names of further words only, which the ratios must confirm
    loose: bool = False  # marked by an id or a slug only; void for a part of the article that starts with a heading
    block: int = 0


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, "")])
    nodes: list[tuple[int, int, str]] = field(default_factory=list)  # element, block, text


def _marks(name: str) -> bool:
    """A class or id names an unwanted part: as its first or last word, unless it speaks of having or holding one."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return bool(words) and HOLDING.isdisjoint(words) and not SKIPPED_MARKS.isdisjoint((words[0], words[-1]))


def _only(names: list[str], known: frozenset[str]) -> bool:
    return all(w in known for n in names for w in re.split(r"[^a-z]+", n) if w)


def _skips(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool, bool, bool]:
    """skipped, marked, slug, loose of an element."""
    skipped, by_class, by_word, by_slug = tag in SKIPPED or tag == "header" and not inside_article, False, False, False
    if "=" in attributes:
        for name, a, b, c in _MARK.findall(attributes):
            names = (a or b or c).lower().split()
            if name.lower() == "role":
                skipped |= not SKIPPED_ROLES.isdisjoint(names)
            elif tag in ("html", "body", "article", "main") or not any(map(_marks, names)):
                continue
            elif name.lower() == "class":
                firm = not inside_article or _only(names, SKIPPED_MARKS | LAYOUT)
                by_class, by_slug = by_class or firm, by_slug or not firm
            elif tag != "p" and tag not in HEADINGS:
                only = _only(names, SKIPPED_MARKS)
                by_word, by_slug = by_word or only, by_slug or not only
    marked = by_class or by_word or by_slug
    return skipped, marked, marked and not by_class and not by_word, marked and not by_class


def read(html: str) -> Page:
    page = Page()
    elements, nodes = page.elements, page.nodes
    stack, block, at = [0], 0, 0
    unclosed: set[str] = set()  # tags of OPEN_ENDED that nothing ends from here on

    def text_to(end: int) -> None:
        if end > at:
            nodes.append((stack[-1], block, html[at:end]))

    def close(depth: int) -> None:
        nonlocal block
        if any(elements[e].tag in BLOCK for e in stack[depth:]):
            block += 1
        del stack[depth:]

    while (m := _TOKEN.search(html, at)) is not None:
        text_to(m.start())
        at = m.end()
        if m[2] is None:
            if m[0] == "<!--":
                end = html.find("-->", at)
                at = len(html) if end < 0 else end + 3
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = None if tag in unclosed else _END_OF[tag].search(html, at)
                if tag not in OPEN_ENDED:
                    at = end.end() if end else len(html)
                elif end is None:
                    unclosed.add(tag)
                else:  # a block ends it as well, and is read
                    at = end.start() if end[1] else end.end()
            continue
        if tag in VOID:
            if tag == "hr":
                block += 1
            elif tag == "br":
                nodes.append((stack[-1], block, " "))
            continue
        if tag in BLOCK:
            block += 1
            open_p = next((d for d in range(len(stack) - 1, 0, -1) if elements[stack[d]].tag == "p"), 0)
            if open_p and not any(elements[e].tag in ("td", "th", "li") for e in stack[open_p:]):
                close(open_p)
        for depth in range(len(stack) - 1, 0, -1):
            inner = elements[stack[depth]].tag
            if inner in CLOSED_BY.get(tag, ()):
                close(depth)
                break
            if inner in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot"):
                break
        above = elements[stack[-1]]
        inside = any(elements[e].tag in ("article", "main") for e in stack)
        skipped, marked, slug, loose = _skips(tag, m[3], inside)
        if tag in HEADINGS and above.loose and inside and stack[-1] == len(elements) - 1 and \
                all(t.isspace() for _, _, t in takewhile(lambda n: n[0] == stack[-1], reversed(nodes))):
            above.marked = False
        if tag in ("article", "main"):
            for e in stack:
                elements[e].marked = False
        elements.append(Element(tag, stack[-1], f"{above.path}/{tag}", skipped, marked, slug, loose))
        stack.append(len(elements) - 1)
    text_to(len(html))
    return page


def _punctuation(text: str) -> int:
    return len(_PUNCTUATION.findall(text))


def fused_ratios(paths: list[str], sizes: list[int], marks: list[int]) -> np.ndarray:
    """Ratio of every node: per path length and punctuation by node, smoothed over neighbours, multiplied."""
    names, inverse = np.unique(np.array(paths), return_inverse=True)
    count = np.bincount(inverse)
    kernel = np.array([0.25, 0.5, 0.25])
    out = np.ones(len(paths))
    for values in (sizes, [1 + m for m in marks]):
        ratio = np.log1p((np.bincount(inverse, weights=values) / count)[inverse])
        padded = np.concatenate([ratio[:1], ratio, ratio[-1:]])
        out *= np.maximum(ratio, np.convolve(padded, kernel, mode="valid"))
    return out


def _chosen(page: Page) -> tuple[list[tuple[int, int, str]], list[int], list[str], list[int], np.ndarray]:
    """Unskipped nodes; numbers, paths and sizes of those with text, and which of them the ratios choose."""
    elements = page.elements
    nodes = [(e, b, t) for e, b, t in page.nodes if not elements[e].skipped]
    solid = [i for i, (_, _, t) in enumerate(nodes) if not t.isspace()]
    if not solid:
        return nodes, [], [], [], np.zeros(0, bool)
    paths, sizes = [elements[nodes[i][0]].path for i in solid], [len(nodes[i][2].strip()) for i in solid]
    ratio = fused_ratios(paths, sizes, [_punctuation(nodes[i][2]) for i in solid])
    return nodes, solid, paths, sizes, ratio >= PART_OF_MEAN * np.average(ratio, weights=sizes)


def main_text(html: str | None) -> str:
    page = read(html or "")
    elements = page.elements
    size_of = np.zeros(len(elements))
    for e, _, t in page.nodes:
        size_of[e] += len(t.strip())
    for e in range(len(elements) - 1, 0, -1):
        size_of[elements[e].parent] += size_of[e]
    for e, x in enumerate(elements):
        x.marked &= size_of[e] < MOST_OF_PAGE * size_of[0]
    for e in elements[1:]:  # parents come first
        e.skipped |= e.marked and not e.slug or elements[e.parent].skipped
    nodes, solid, paths, sizes, chosen = _chosen(page)
    if any(e.marked and e.slug and not e.skipped for e in elements):
        size_of[:] = 0
        high = np.zeros(len(elements))
        for i, size, ok in zip(solid, sizes, chosen.tolist()):
            size_of[nodes[i][0]] += size
            high[nodes[i][0]] += size * ok
        for e in range(len(elements) - 1, 0, -1):
            size_of[elements[e].parent] += size_of[e]
            high[elements[e].parent] += high[e]
        for e, x in enumerate(elements[1:], 1):
            x.skipped |= x.marked and x.slug and high[e] < 0.5 * size_of[e] or elements[x.parent].skipped
        nodes, solid, paths, sizes, chosen = _chosen(page)
    if not solid:
        return ""
    held = np.zeros(len(elements))
    for i, size, ok in zip(solid, sizes, chosen.tolist()):
        held[nodes[i][0]] += size * ok
    for e in range(len(elements) - 1, 0, -1):
        held[elements[e].parent] += held[e]
    # the article elements, if they hold most of the content; else the smallest element that holds nearly all of it
    roots = {e for e, x in enumerate(elements) if x.tag in ("article", "main") and held[e] > 0}
    within = [False] * len(elements)
    for e, x in enumerate(elements):
        within[e] = x.parent >= 0 and (within[x.parent] or x.parent in roots)
    if sum(held[e] for e in roots if not within[e]) <= 0.5 * held[0]:
        root = max((e for e, x in enumerate(elements) if x.tag in HOLDERS and held[e] >= HELD * held[0]), default=0)
        roots = {root}
    inside = [False] * len(elements)
    for e, x in enumerate(elements):
        inside[e] = e in roots or x.parent >= 0 and inside[x.parent]
    whole = all(elements[e].tag not in ("", "html", "body") for e in roots)
    content = {p for p, ok in zip(paths, chosen.tolist()) if ok}
    heading = [False] * len(elements)
    for e, x in enumerate(elements):
        heading[e] = x.tag in HEADINGS or x.parent >= 0 and heading[x.parent]
    blocks = {nodes[i][1] for i, p, ok in zip(solid, paths, chosen.tolist()) if ok or p in content}
    follows = False  # the next text that is no heading is content outside the article
    for i in reversed(solid):
        e, b, _ = nodes[i]
        if not heading[e]:
            follows = b in blocks and not inside[e]
        elif follows or inside[e]:
            blocks.add(b)
    kept: dict[int, list[str]] = {}
    for e, b, t in nodes:
        if b in blocks or whole and inside[e]:
            kept.setdefault(b, []).append(t)
    lines = (" ".join(unescape("".join(parts)).split()) for parts in kept.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def start():
        def work(piece: Piece) -> Piece:
            texts = [main_text(h) for h in piece["html"]]
            return {"page_id": piece["page_id"], "url": piece["url"], "text": texts, "n_chars": list(map(len, texts))}
        return work

    return map_pieces(pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                                   F.col(html).cast("string").alias("html")),
                      "page_id long, url string, text string, n_chars long", start)
