"""Blocks of a web page: its texts with the path of elements they stand in.

Words of a class or id rule an element out, but not `PAGE_TAGS` (unless it is an article nested in
another one), and outside a marked article only if that leaves the page its article: while no marked
article is left, the outermost such elements around one count again; in a page without a marked article
those that hold most of its text do, or, if nothing at all is left, those that hold nearly as much as the
largest.
A form is ruled out unless it is wrapped around (nearly) all the text.

Elements inside a line of text (`span`, `button`, ...) that are ruled out leave the block they stand in whole:
their text goes, the text before and after them is one block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import groupby

# Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = "script|style|noscript|template|textarea|iframe|object|svg|canvas|math|noembed|noframes|xmp"
# An opening tag ends open elements of the second kind, up to the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
# Elements, roles and words of class or id that mark what is not the article.
NOISE_TAGS = frozenset("nav aside footer button select datalist dialog menu head title search".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notification popup modal overlay newsletter subscribe subscription signup sidebar widget widgets "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar social share sharing related "
    "recommended recommendations comment comments commentlist disqus reply replies respond pagination pager login search "
    "skip tagcloud copyright paywall alert announcement discussion".split()
)
OUTER_WORDS = frozenset("header top bottom banner".split())  # noise outside the article only
PAGE_TAGS = frozenset(("html", "body", "main", "article"))  # not ruled out by a name
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset(("articlebody", "main"))

MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
# Block elements nested deeper are one node of the tree with their ancestor at this depth.
DEEPEST = 64
AROUND = 0.9  # share of a page's text that a form holds at least to be no form but its wrapper
NEARLY = 0.8  # where names leave nothing, the elements count again that hold so much of the largest one's text
REFERENCE = re.compile(r"&#?\w+;?")
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@dataclass
class Element:
    tag: str
    step: str  # tag and classes, as one step of a path
    noise: bool  # it or an element around it is not the article
    main: bool  # it is, or stands in, the article
    named: tuple[int, ...] = ()  # numbers of the elements around it, and its own, that a name may rule out
    article: bool = False  # it is or stands in an element `article`
    path: str = ""  # steps of the block elements down to it
    depth: int = 0
    children: list[str] = field(default_factory=list)


@dataclass
class Run:
    """Text of a block inside the same elements that may be ruled out."""

    text: str
    main: bool
    named: tuple[int, ...]
    linked: int  # characters inside links
    links: int  # links that begin in it
    bare: bool  # a letter or digit stands outside links


@dataclass
class Block:
    path: str
    main: bool
    prose: bool  # its element is a paragraph, a heading or the like
    runs: list[Run]
    text: str = ""  # of the runs that stay; empty if none does
    linked: int = 0
    links: int = 0
    bare: bool = False


def kind_of(tag: str, attributes: str, around: Element, number: int) -> Element:
    noise, main, named = around.noise, around.main, around.named
    step, words = tag, set()
    if attributes.strip():
        found = {}
        for name, a, b, c, flag in ATTRIBUTE.findall(attributes):
            found[(name or flag).lower()] = a or b or c
        names = f"{found.get('class', '')} {found.get('id', '')}"
        words = {w.lower() for w in WORD.findall(names)} | set(re.findall("[a-z]+", names.lower()))
        role = found.get("role", "").lower()
        main = main or role == "main" or found.get("itemprop", "").lower() == "articlebody"
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I)
        noise = noise or bool(hidden) or role in NOISE_ROLES
        if names.strip():
            step += "." + ".".join(re.sub(r"\d+", "0", n) for n in sorted(set(names.split())))
    main = main or tag in MAIN_TAGS
    noise = noise or tag in NOISE_TAGS or not main and tag == "header"
    inside = tag == "article" and around.article
    if (tag not in PAGE_TAGS or inside) and (words & NOISE_WORDS or not main and words & OUTER_WORDS):
        if around.main:
            noise = True
        else:
            named = (*named, number)
    elif tag == "form":
        named = (*named, number)
    return Element(tag, step, noise, main, named, around.article or tag == "article")


def settle(found: list[Block], forms: set[int]) -> list[Block]:
    """The blocks that names and forms leave, with their texts."""
    still: set[int] = set()

    def outermost(r: Run) -> int | None:
        return next((n for n in r.named if n not in still), None)

    runs = [r for b in found for r in b.runs]
    if any(r.named for r in runs):
        sizes = [len(r.text.strip()) for r in runs]
        plain = [(r, n) for r, n in zip(runs, sizes, strict=True) if forms.issuperset(r.named)]
        inside: Counter[int] = Counter()
        for r, n in plain:
            inside.update(dict.fromkeys(r.named, n))
        around = AROUND * sum(n for _, n in plain)
        still |= {f for f, n in inside.items() if n and n >= around}
        marked = [r for r in runs if r.main and r.text.strip()]
        while marked and all(outermost(r) is not None for r in marked):
            still.update({outermost(r) for r in marked})
        total = sum(sizes)
        while not marked:
            held: Counter[int | None] = Counter()
            for r, n in zip(runs, sizes, strict=True):
                held[outermost(r)] += n
            left = held.pop(None, 0)
            largest = max(held.values(), default=0)
            if left:
                most = {i for i, n in held.items() if n > (AROUND if i in forms else 0.5) * total}
            else:
                most = {i for i, n in held.items() if n and n >= NEARLY * largest}
            if not most:
                break
            still |= most
    kept = []
    for b in found:
        own = [r for r in b.runs if outermost(r) is None]
        b.text = " ".join("".join(r.text for r in own).split())
        if b.text:
            b.linked, b.links = sum(r.linked for r in own), sum(r.links for r in own)
            b.bare = any(r.bare for r in own)
            kept.append(b)
    return kept


def differ(a: Element, b: Element) -> bool:
    return (a.noise, a.main, a.named) != (b.noise, b.main, b.named)


def blocks(page: str | None) -> tuple[list[Block], list[tuple[str, str]]]:
    """The texts of a page that nothing rules out, in order, and its elements as (path, steps of the elements right inside)."""
    found: list[Block] = []
    elements: list[tuple[str, str]] = []
    stack: list[Element] = [Element("", "", False, False)]
    open_tags: Counter[str] = Counter()
    forms: set[int] = set()
    runs: list[Run] = []
    held: list[str] = []
    linked, begun, links, bare = 0, 0, 0, False

    def turn() -> None:
        """End the run that was read."""
        nonlocal linked, begun, bare
        top = stack[-1]
        if held and not top.noise:
            runs.append(Run(html.unescape("".join(held)), top.main, top.named, linked, begun, bare))
        held.clear()
        linked, begun, bare = 0, 0, False

    def flush() -> None:
        """End the block that was read."""
        turn()
        if runs:
            tag = next((e.tag for e in reversed(stack) if e.tag in BLOCK), "")
            found.extend(Block(stack[-1].path, main, tag in PROSE, list(own)) for main, own in groupby(runs, lambda r: r.main))
            runs.clear()

    def read(piece: str) -> None:
        nonlocal linked, bare
        held.append(piece)
        if links:
            linked += len(piece)
        elif not bare:
            bare = any(map(str.isalnum, REFERENCE.sub("", piece)))

    def close() -> None:
        top = stack[-1]
        if top.tag in BLOCK:
            flush()
            elements.append((top.path, " ".join(top.children)))
        elif differ(top, stack[-2]):
            turn()
        open_tags[stack.pop().tag] -= 1

    def close_to(tags: set[str], within: set[str]) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    close()
                return
            if stack[i].tag in within:
                return

    source, at = page or "", 0
    for m in MARKUP.finditer(source):
        if m.start() > at:
            read(source[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        if m[2] or m[5]:
            if tag == "a":
                links = max(0, links - 1)
            if not open_tags[tag]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    while len(stack) > i:
                        close()
                    break
                if stack[i].tag in MAIN_TAGS and tag not in BLOCK:
                    break
            continue
        if tag in BLOCK:
            flush()
            close_to({"p"}, {"table", "button", "object"} if tag != "p" else {"table", "button"})
        if tag in CLOSES:
            close_to(*CLOSES[tag])
        if tag in VOID:
            held.append(" ")
            continue
        element = kind_of(tag, m[4] or m[7] or "", stack[-1], m.start())
        element.path, element.depth = stack[-1].path, stack[-1].depth
        element.children = stack[-1].children
        if tag in BLOCK:
            stack[-1].children.append(element.step)
            element.children = []
            element.depth += 1
            if element.depth <= DEEPEST:
                element.path = f"{element.path}/{element.step}" if element.path else element.step
        if not (m[4] or m[7] or "").rstrip().endswith("/") or tag in BLOCK:
            if differ(element, stack[-1]):
                turn()
            if tag == "a":
                links += 1
                begun += 1
            if tag == "form":
                forms.add(m.start())
            open_tags[tag] += 1
            stack.append(element)
    if at < len(source):
        read(source[at:])
    while len(stack) > 1:
        close()
    flush()
    return settle(found, forms), elements
