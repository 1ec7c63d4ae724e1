"""Main text of web pages by tag-path ratios.

A page's text nodes are its blocks: runs of text between the tags of block elements
(tags inside a line, such as ``b`` or ``a``, belong to the block's text). Each has a
tag path from the root to its leaf element, a step being the tag with its first class
name (lists, rows and the like, which only hold their items, are no steps). Text outside links and punctuation marks are summed per path, and give its
ratios: characters and marks per node. A path's ratios are smoothed by those of
similar paths (fewer unshared steps, more weight) and fused with its share of link text.
The paths that reach a share of the page's mean are the main text; inside ``article``
and ``main``, where a page has them, a tenth of it will do, outside ten times it is asked. Elements that are never main text by their tag or by a word of their class,
id or role (menus, sidebars, adverts, forms, scripts, comments and the like) count nothing.

Every page is judged by itself, in the task that reads it. Null, empty and textless
pages give an empty text. Long pages take time in proportion to their length times the
number of distinct paths; repeated rows are judged each; unclosed, crossed and cut off
tags are closed as browsers do in simple cases; an empty table gives an empty one.
Columns other than ``text`` and ``n_chars``, which are replaced, pass through.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from candlewick.llm.common import with_lists

#: A comment, a declaration, or a tag with its attributes.
MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
#: What attributes are read for.
TELLING = re.compile(r"\b(?:class|id|role|hidden|aria-hidden|style)\b", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Elements that only hold others of their kind: no steps of a path.
HOLDERS = frozenset("html ul ol dl thead tbody tfoot tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags that end an open element of the kinds listed, up to one of the scope.
ENDS = {
    "li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tr td th thead tbody", "table"), "body": ("head", "html"),
}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}
P_SCOPE = frozenset("table td th caption button object template".split())

#: Elements whose text is never main text; ``header`` is one outside articles.
NEVER = frozenset("nav aside footer form button select fieldset dialog svg math object menu head".split())
MAIN = frozenset(("article", "main"))
#: Words of a class, id or role that say the same.
SAID = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login search nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social comment comments respond "
    "disqus reply replies discussion footer copyright pagination pager toolbar rail teaser complementary contentinfo paywall "
    "skip skiplink tags byline meta".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
#: First words of class names that only tell of other elements.
TELLS = frozenset("has with no without".split())

MARKS = re.compile(r"[.,;:!?…、。，！？]")
#: Width of the kernel over unshared steps of paths.
WIDTH = 0.75
#: What a path inside or outside article and main counts, where a page has one.
INSIDE, OUTSIDE = 10.0, 0.1
#: Share of the mean from which paths are main text.
SHARE = 0.25


def attributes(text: str) -> dict[str, str]:
    """Names in small letters with their values, of the first of equal names."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape((m[2] or "").strip("\"'")))
    return out


def never(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether an element's text is never main text."""
    if tag in NEVER or (tag == "header" and not in_main):
        return True
    if tag in ("html", "body", *MAIN):
        return tag == "article" and any(w in ("comment", "reply") for w in words_of(attrs))
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    words = set(words_of(attrs))
    return bool(words & SAID) or (bool(words & HEADER_WORDS) and not in_main and tag not in HEADINGS)


def words_of(attrs: dict[str, str]) -> list[str]:
    """Words of the class names, the id and the role that tell of the element itself."""
    out = []
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".split():
        words = [w.lower() for w in NAME_WORDS.findall(name)]
        if words and words[0] not in TELLS:
            out += words
    return out


@dataclass
class Element:
    tag: str
    step: str
    dropped: bool  # by itself or by one around it
    in_main: bool
    form: bool  # dropped for a form only
    around: list[str]  # tags inside a line that were open before it


@dataclass
class Node:
    """A block of text with its path."""

    path: tuple[str, ...]
    in_main: bool
    dropped: bool
    form: bool
    pieces: list[str] = field(default_factory=list)
    links: int = 0  # characters in links

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


class Reader:
    """The text nodes of a page, in page order."""

    def __init__(self) -> None:
        self.open: list[Element] = [Element("", "", False, False, False, [])]
        self.nodes: list[Node] = []
        self.node: Node | None = None
        self.inline: list[str] = []

    def text(self, text: str) -> None:
        if not text:
            return
        if self.node is None:
            if text.isspace():
                return
            top = self.open[-1]
            self.node = Node(tuple(e.step for e in self.open[1:] if e.tag not in HOLDERS), top.in_main, top.dropped, top.form)
            self.nodes.append(self.node)
        text = html.unescape(text)
        self.node.pieces.append(text)
        if "a" in self.inline:
            self.node.links += len("".join(text.split()))

    def close_to(self, at: int) -> None:
        """End the open elements from a place on; tags inside lines end with them."""
        self.inline = self.open[at].around
        del self.open[at:]

    def close_open(self, tags: frozenset[str], scope: frozenset[str]) -> None:
        found = None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in scope:
                break
            if self.open[at].tag in tags:
                found = at
        if found:
            self.close_to(found)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        said = bool(attrs) and never(tag, attrs, self.open[-1].in_main)
        if tag in INLINE and not said:
            self.inline.append(tag)
            return
        self.node = None
        if tag not in INLINE:
            self.close_open(frozenset(("p",)), P_SCOPE)
        if tag in ENDS:
            self.close_open(*ENDS[tag])
        top = self.open[-1]
        said = said or never(tag, attrs, top.in_main)
        name = attrs.get("class", "").split()
        step = f"{tag}.{name[0]}" if name else tag
        form = (top.form if top.dropped else True) and tag == "form" or (top.form and not said)
        self.open.append(Element(tag, step, top.dropped or said, top.in_main or tag in MAIN, form, self.inline))
        self.inline = []

    def end(self, tag: str) -> None:
        if tag in self.inline:
            del self.inline[len(self.inline) - 1 - self.inline[::-1].index(tag)]
            return
        if tag not in INLINE:
            self.node = None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self.node = None
                self.close_to(at)
                return
            if tag in INLINE:
                return


def read(page: str) -> list[Node]:
    """The text nodes of a page; raw text, as of scripts, is left out."""
    out, at = Reader(), 0
    while m := MARKUP.search(page, at):
        out.text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            out.end(tag)
        elif tag in RAW:
            done = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = done.end() if done else len(page)
        elif tag == "br":
            out.text(" ")
        elif tag not in VOID:
            out.start(tag, attributes(m[3]) if TELLING.search(m[3]) else {})
        elif tag == "hr":
            out.node = None
    out.text(page[at:])
    return out.nodes


@dataclass
class Ratios:
    """Sums of the nodes of a path."""

    nodes: int = 0
    chars: int = 0
    links: int = 0
    marks: int = 0
    in_main: bool = False

    def score(self) -> float:
        """Characters per node outside links, more with marks per node."""
        own = max(self.chars - self.links, 0)
        return own / self.nodes * math.log(math.e + self.marks / self.nodes) * (own / max(self.chars, 1))


def unshared(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """Steps of two paths after their common beginning; leaves of one element below
    the body, as a heading and its paragraphs, are one apart, and a path is one more
    from those that go on from it."""
    common = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        common += 1
    apart = len(a) + len(b) - 2 * common
    if common == min(len(a), len(b)):
        return apart + (apart > 0)
    return 1 if len(a) == len(b) == common + 1 and common > 1 else apart


def content_paths(nodes: list[tuple[Node, str]], width: float = WIDTH, share: float = SHARE) -> set[tuple[str, ...]]:
    """The paths of the nodes, given with their texts, that hold main text."""
    paths: dict[tuple[str, ...], Ratios] = {}
    for node, text in nodes:
        r = paths.setdefault(node.path, Ratios())
        r.nodes += 1
        r.chars += sum(map(len, text.split()))
        r.links += node.links
        r.marks += len(MARKS.findall(text))
        r.in_main |= node.in_main
    has_main = any(r.in_main and r.chars > r.links for r in paths.values())
    plain = {p: r.score() for p, r in paths.items()}
    fused = {}
    for p, r in paths.items():
        weight = {q: paths[q].chars * math.exp(-(unshared(p, q) ** 2) / (2 * width**2)) for q in paths if near_by(p, q)}
        smooth = sum(w * plain[q] for q, w in weight.items()) / max(sum(weight.values()), 1e-9)
        fused[p] = smooth * max(r.chars - r.links, 0) / max(r.chars, 1)
    total = sum(r.chars for r in paths.values())
    mean = sum(fused[p] * r.chars for p, r in paths.items()) / max(total, 1)
    place = {p: (INSIDE if r.in_main else OUTSIDE) if has_main else 1.0 for p, r in paths.items()}
    return {p for p in paths if 0 < fused[p] >= share * mean / place[p]}


def near_by(p: tuple[str, ...], q: tuple[str, ...]) -> bool:
    """Paths farther apart than this weigh next to nothing."""
    return abs(len(p) - len(q)) <= 3 and unshared(p, q) <= 3


def main_text(page: str | None) -> str:
    """The blocks of the main text, joined by a space."""
    nodes = [(n, n.text()) for n in read(page or "")]
    nodes = [(n, t) for n, t in nodes if t]
    kept = [(n, t) for n, t in nodes if not n.dropped]
    if not kept:  # all of the page may stand in one form
        kept = [(n, t) for n, t in nodes if n.form]
    chosen = content_paths(kept)
    return " ".join(t for n, t in kept if n.path in chosen)


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All rows with ``text``, the main text, and ``n_chars``, its code points."""

    def made() -> Callable[[list], tuple]:
        def of(found: list) -> tuple:
            texts = [main_text(page) for page in found]
            return texts, [len(t) for t in texts]

        return of

    return with_lists(pages, [html_col], {"text": T.StringType(), "n_chars": T.LongType()}, made)
