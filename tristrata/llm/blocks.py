"""Leaf text blocks of a web page with their tag paths."""

from __future__ import annotations

import re
from html import unescape

#: Fixed names from the HTML standard.
RAW_TEXT = frozenset("script style noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html label "
    "legend li main menu nav ol option p pre section select summary table tbody td textarea "
    "tfoot th thead title tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - frozenset("button label option".split())
#: Elements that end an open one of the same kind, up to the list or table they are in.
SIBLINGS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table",
            "th": "tr table", "option": "select"}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")


def _label(tag: str, attributes: str) -> str:
    """The element as one word of a path: its tag, then the words of class, id and role."""
    if not attributes or "=" not in attributes:
        return tag
    words = []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        split = re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(values)).lower()
        words += [w for w in _NAME.findall(split) if len(w) > 1][:8]
    return ".".join([tag, *words]) if words else tag


def leaf_blocks(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """Text, tag path and share of link text of each block, in page order.

    A block is the text between two tags of block elements, with inline tags dropped,
    character references decoded and white space as single spaces.  Content of scripts,
    styles and the like is no text.  Missing end tags are read as browsers do for
    paragraphs, list items and cells; other unclosed elements end with their parents.
    """
    out: list[tuple[str, tuple[str, ...], float]] = []
    path: list[tuple[str, str]] = []
    parts: list[str] = []
    links = in_link = at = 0

    def close_block() -> None:
        nonlocal links
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((text, tuple(label for _, label in path), min(1.0, links / len(text))))
        parts.clear()
        links = 0

    def pop_to(depth: int) -> None:
        nonlocal in_link
        for tag, _ in path[depth:]:
            in_link -= tag == "a"
        del path[depth:]

    def find(tag: str, stop: str = "") -> int:
        stops = stop.split()
        for depth in range(len(path) - 1, -1, -1):
            if path[depth][0] == tag:
                return depth
            if path[depth][0] in stops:
                return -1
        return -1

    def add(text: str) -> None:
        nonlocal links
        if text:
            parts.append(text)
            if in_link:
                links += len(text.strip())

    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        ends, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if ends:
            if tag in BLOCK:
                close_block()
            depth = find(tag)
            if depth >= 0:
                if any(t in BLOCK for t, _ in path[depth:]) and tag not in BLOCK:
                    continue  # an inline end tag does not end blocks
                pop_to(depth)
            continue
        if tag in RAW_TEXT:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else size
            continue
        if tag == "br":
            parts.append(" ")
        if tag in VOID:
            continue
        if tag in BLOCK:
            close_block()
            if tag in ENDS_PARAGRAPH and (depth := find("p", "button td th table")) >= 0:
                pop_to(depth)
            if tag in SIBLINGS and (depth := find(tag, SIBLINGS[tag])) >= 0:
                pop_to(depth)
        if not attributes.endswith("/") or tag in BLOCK:
            path.append((tag, _label(tag, attributes)))
            in_link += tag == "a"
    close_block()
    return out
