"""Blocks of a web page: leaf texts in page order with what surrounds them.

A small tolerant reader, not a full HTML parser: it keeps a stack of open block elements,
closes the ones whose end tags may be left out, and survives unclosed, crossed and cut-off
markup. Inline elements do not end a block; ``br`` is white space in it. What a browser never
shows as text (scripts, styles, the head, templates, ...) is skipped while reading.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

# Element names of the HTML standard, by what they do to a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr "
    # formulas are part of the text around them
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded mphantom msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SKIPPED = frozenset(
    "script style noscript template textarea title svg iframe object canvas audio video "
    "select datalist annotation annotation-xml".split()
)
# Of these the ones that run to the page's end if they are not ended, as their content is no markup;
# of the others only the start tag is lost then.
RAW = frozenset("script style textarea title".split())
# Elements that end an open one of these when they start (end tags that may be left out).
SIBLINGS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("td", "th", "tr"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "body": ("head",),
}
# Open elements that a left-out end tag does not reach through.
SCOPES = frozenset("ul ol dl table tr article section div main aside nav form".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
HIDDEN = re.compile(r"""display\s*:\s*none|\bhidden\b(?!\s*=\s*["']?false)|aria-hidden\s*=\s*["']?true""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


NEAREST = 48  # open elements, and words of their names, that a block is described by


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # nearest open block elements, innermost last
    names: tuple[str, ...]  # words of their classes, ids and roles
    link_chars: int


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes and "hidden" not in attributes.lower():
        return ()
    found = ["".join(m) for m in NAMES.findall(attributes)]
    words = [w.lower() for x in found for w in NAME.findall(x)]
    if HIDDEN.search(attributes):
        words.append("hidden")
    return tuple(words)


def blocks(page: str | None) -> list[Block]:
    """The non-empty blocks of a page."""
    page = page or ""
    out: list[Block] = []
    # per open element: name, tags and names down to it
    stack: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = []
    depths: dict[str, list[int]] = {}  # of the open elements of a name
    scopes: list[int] = []  # depths of the open elements of SCOPES
    endless: set[str] = set()  # skipped elements without an end tag from here on
    parts: list[str] = []
    linked = links = 0
    at = 0

    def push(name: str, attributes: str) -> None:
        tags, names = (stack[-1][1], stack[-1][2]) if stack else ((), ())
        depths.setdefault(name, []).append(len(stack))
        if name in SCOPES:
            scopes.append(len(stack))
        stack.append((name, (*tags[-NEAREST:], name), (names + _names(attributes))[-NEAREST:]))

    def cut(depth: int) -> None:
        while len(stack) > depth:
            name = stack.pop()[0]
            depths[name].pop()
            if name in SCOPES:
                scopes.pop()

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tags, names = (stack[-1][1], stack[-1][2]) if stack else ((), ())
                out.append(Block(text, tags, names, min(linked, len(text))))
            parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = entities.unescape(text)
        parts.append(text)
        if links:
            linked += len(text)

    while at < len(page):
        m = MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                links = 0 if m[1] else 1
            continue
        if m[1]:
            flush()
            if depths.get(name):
                cut(depths[name][-1])
                links = 0
            continue
        if name in SKIPPED:
            if not m[3].endswith("/>") and name not in endless:
                end = re.compile(rf"</{re.escape(name)}(?![^\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name in RAW:
                    at = len(page)
                else:
                    endless.add(name)
            parts.append(" ")
            continue
        flush()
        links = 0
        if name in VOID or m[3].endswith("/>"):
            continue
        if stack and stack[-1][0] == "p":
            cut(len(stack) - 1)
        ends = [depths[e][-1] for e in SIBLINGS.get(name, ()) if depths.get(e)]
        if ends and max(ends) >= (scopes[-1] if scopes else 0):
            cut(max(ends))
        push(name, m[3])
    flush()
    return out
