"""Leaf blocks of a page: runs of text between block elements, with the elements around them."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from typing import NamedTuple

_MARKUP = re.compile(
    r"<(?:!--(?:>|->|.*?--!?>|.*\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|[!?/][^>]*+>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|(?<=[\s"'/]))(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup and no text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav noscript ol optgroup option p pre search section"
    " select summary table tbody td template tfoot th thead tr ul".split()
)
_ENDS_P = BLOCK - frozenset("body caption head html legend noscript optgroup option select tbody td template tfoot th thead tr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELLS = frozenset("td th caption".split())
#: An element that begins ends an open one of these, unless one of the others stands between.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "tbody": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
    "thead": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
}


class Element(NamedTuple):
    tag: str
    names: tuple[str, ...] = ()  # words of its class, id and role


class Block(NamedTuple):
    text: str
    path: tuple[Element, ...]
    linked: int  # characters of the text inside links


@lru_cache(maxsize=1 << 12)
def _element(tag: str, attributes: str) -> Element:
    names = []
    for m in _ATTRIBUTE.finditer(attributes):
        names += [w.lower() for w in _NAME.findall(unescape(m[2] or m[3] or m[4] or ""))]
    return Element(tag, tuple(dict.fromkeys(names)))


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I)


def _cut(path: list[Element], ended: tuple[str, ...], walls: tuple[str, ...]) -> None:
    """Close what ``ended`` names, down to the first of ``walls``."""
    for place in range(len(path) - 1, -1, -1):
        if path[place].tag in walls:
            break
        if path[place].tag in ended:
            del path[place:]
            if len(ended) == 1:
                break


def leaf_blocks(html: str) -> list[Block]:
    """The page's blocks in order. White space in a block is one space; blocks without text are none.

    Character references are decoded once. Missing end tags are put in as browsers do for
    paragraphs, list items, cells and options; end tags of nothing open count for nothing.
    """
    blocks: list[Block] = []
    path: list[Element] = []
    words: list[str] = []
    around: tuple[Element, ...] = ()
    linked = links = at = 0

    def close() -> None:
        nonlocal linked, words
        if words:
            text = " ".join("".join(words).split())
            if text:
                blocks.append(Block(text, around, min(linked, len(text))))
            words, linked = [], 0

    def say(text: str) -> None:
        nonlocal around, linked
        if "&" in text:
            text = unescape(text)
        if not words:
            if not text or text.isspace():
                return
            around = tuple(e for e in path if e.tag in BLOCK or e.names)
        words.append(text)
        if links:
            linked += len(" ".join(text.split()))

    where = _MARKUP.search(html)
    while where:
        if where.start() > at:
            say(html[at : where.start()])
        at = where.end()
        tag = where[2]
        if tag:
            tag = tag.lower()
            if where[1]:
                if tag in BLOCK:
                    close()
                    _end(path, tag)
                else:
                    for place in range(len(path) - 1, -1, -1):
                        if path[place].tag == tag:
                            del path[place]
                            break
                links = sum(e.tag == "a" for e in path) if path else 0
            elif tag in RAW:
                ended = _raw_end(tag).search(html, at)
                at = ended.end() if ended else len(html)
            else:
                if tag in BLOCK:
                    close()
                    _begin(path, tag)
                    links = sum(e.tag == "a" for e in path) if path else 0
                elif tag == "br":
                    say("\n")
                if tag not in VOID:
                    path.append(_element(tag, where[3]))
                    links += tag == "a"
        where = _MARKUP.search(html, at)
    if at < len(html):
        say(html[at:])
    close()
    return blocks


def _begin(path: list[Element], tag: str) -> None:
    if tag in _ENDS_P:
        _cut(path, ("p",), ("td", "th", "caption", "button", "table"))
    if tag in _ENDS:
        _cut(path, *_ENDS[tag])
    elif tag in _HEADINGS and path and path[-1].tag in _HEADINGS:
        path.pop()


def _end(path: list[Element], tag: str) -> None:
    for place in range(len(path) - 1, -1, -1):
        if path[place].tag == tag or (tag in _HEADINGS and path[place].tag in _HEADINGS):
            del path[place:]
            return
        if path[place].tag in _CELLS and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
            return
