"""Flat text blocks of a page, and what a classifier may know of each: shape of the text, of its neighbours, and context."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np

# Element names and words of the HTML standard and of common class names.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark nobr q ruby rt rp s samp small span strike strong sub sup time tt u var wbr math svg object audio video canvas "
    "mi mo mn ms mtext mspace mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle semantics g path circle rect line polygon polyline ellipse text tspan use defs".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe select".split())
ASIDE = frozenset("nav footer aside form menu dialog button header".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget "
    "related recommended footer masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search "
    "share sharing social comment comments reply replies discussion disqus respond copyright toolbar pagination pager header".split()
)
ASIDE_ENDINGS = ("nav", "menu", "footer", "sidebar", "comments", "banner", "advert", "cookie", "crumbs")
MAIN = frozenset("article main".split())
MAIN_WORDS = frozenset("article content post entry story main body text".split())
FEATURES = ("aside", "main", "page_has_main", "heading", "words", "link_density", "words_before", "links_before", "words_after", "links_after")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
ANY_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
#: In a class such as has-sidebar or post-with-comments, what follows one of these words tells of the page, not of the element.
STATE = re.compile(r"(?<![a-z0-9])(?:has|with|no|without)(?![a-z0-9]).*", re.S)
PART = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    aside: bool
    main: bool
    heading: bool
    words: int
    link_words: int


def _hidden(attributes: str) -> bool:
    """By the attribute of that name or the style; other attributes' values hide nothing."""
    return any(k.lower() == "hidden" or k.lower() == "style" and NOT_SHOWN.search(html.unescape(v)) for k, v in ANY_ATTRIBUTE.findall(attributes))


def _context(name: str, attributes: str, in_main: bool, wrapper: bool = False) -> tuple[bool, bool, bool]:
    """(is set aside, by words of class and id alone, is main) by the element itself; the words set no ``wrapper`` aside."""
    words: set[str] = set()
    aside, main = name in ASIDE and not (name == "header" and in_main), name in MAIN
    for kind, *values in ATTRIBUTE.findall(attributes):
        value = html.unescape(next((v for v in values if v), ""))
        if kind.lower() == "role":
            aside |= value.strip().lower() in ASIDE_ROLES
            main |= value.strip().lower() in MAIN
        else:
            for one in value.split():
                words.update(PART.findall(STATE.sub("", CAMEL.sub(" ", one).lower())))
    if in_main:
        words.discard("header")
    aside |= _hidden(attributes)
    by_words = not aside and not wrapper and name not in ("html", "body") and (bool(words & ASIDE_WORDS) or any(w.endswith(ASIDE_ENDINGS) for w in words))
    aside |= by_words
    return aside, by_words, main or (not aside and name != "body" and bool(words & MAIN_WORDS))


def blocks(page: str) -> list[Block]:
    """Text between block-level tags in page order, white space made one space, references decoded. Tolerates bad markup.

    An element whose class or id has a word of a side part, but that holds the page's article or main element, is a wrapper
    and no side part. Where the page has a main part outside of all side parts, articles in side parts are teasers and the like.
    """
    out, wrappers = _parse(page, frozenset())
    return _parse(page, wrappers)[0] if wrappers else out


def _parse(page: str, wrappers: frozenset[int]) -> tuple[list[Block], frozenset[int]]:
    """The blocks, and where the start tags end that are wrappers, unless given. Takes time in proportion to the page."""
    out: list[Block] = []
    held: list[tuple[bool, int]] = []  # of each article or main element: is main, the innermost element set aside by words around it
    around: dict[int, tuple[int, int]] = {}  # of each element set aside by words: the next such one outwards (-1: none), how many with itself
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool, int, int]] = []  # name, set aside, main, heading, innermost place by words, elements set aside by themselves
    places: dict[str, list[int]] = {}  # of each name: where it is open in the stack
    unclosed: set[str] = set()  # names of which no end tag follows
    depth_a = 0
    context = (False, False, False)

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, *context, len(text.split()), len(html.unescape("".join(linked)).split())))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            linked.append(text if depth_a else " ")

    def leave(k: int) -> tuple[bool, bool, bool]:
        for left in stack[k:]:
            places[left[0]].pop()
        del stack[k:]
        return stack[-1][1:4] if stack else (False, False, False)

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # an end tag: leave everything up to its start, if it was opened
            if name == "a" and depth_a:
                depth_a -= 1
            if name not in INLINE:
                close()
            if open_at := places.get(name):
                k = open_at[-1]
                if any(s[0] not in INLINE or s[1] for s in stack[k:]):
                    close()
                context = leave(k)
            continue
        if name in RAW and not m[0].endswith("/>"):
            end = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end is None:
                unclosed.add(name)
            at = end.end() if end else n if name in ("script", "style") else at
            if name not in INLINE:
                close()
            continue
        if name not in INLINE:
            close()
            if name != "br" and (open_at := places.get("p")):  # a paragraph ends where a block begins, so only inline ones are open in it
                context = leave(open_at[-1])
        if name in VOID:
            continue
        aside, by_words, main = _context(name, m[3], context[1], at in wrappers)
        innermost, by_itself = stack[-1][4:] if stack else (-1, 0)
        if name in MAIN and not aside and not by_itself:
            held.append((name == "main", innermost))
        if by_words:
            around[at] = innermost, 1 + (around[innermost][1] if innermost >= 0 else 0)
            innermost = at
        if aside:
            close()
        if name == "a":
            depth_a += 1
        context = (context[0] or aside, context[1] or main, context[2] or bool(re.fullmatch("h[1-6]", name)))
        places.setdefault(name, []).append(len(stack))
        stack.append((name, *context, innermost, by_itself + (aside and not by_words)))
    close()
    if any(innermost < 0 for _, innermost in held) or any(b.main and not b.aside and not b.heading for b in out):
        return out, frozenset()
    mains = [innermost for is_main, innermost in held if is_main] or [innermost for _, innermost in held]
    least = min((around[i][1] for i in mains), default=0)
    found: set[int] = set()
    for one in {i for i in mains if around[i][1] == least}:
        while one >= 0 and one not in found:
            found.add(one)
            one = around[one][0]
    return out, frozenset(found)


def features(found: list[Block]) -> np.ndarray:
    """(blocks, FEATURES). Neighbours are the blocks before and after; at the ends they have no words."""
    n = len(found)
    own = np.zeros((n + 2, 2))
    for i, b in enumerate(found, 1):
        own[i] = b.words, b.link_words / max(1, b.words)
    out = np.zeros((n, len(FEATURES)))
    has_main = any(b.main and not b.aside for b in found)
    for i, b in enumerate(found):
        out[i, :4] = b.aside, b.main, has_main, b.heading
    out[:, 4:6], out[:, 6:8], out[:, 8:10] = own[1:-1], own[:-2], own[2:]
    return out
