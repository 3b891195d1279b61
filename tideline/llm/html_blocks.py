"""Text blocks of an HTML page with the tags and class words around them."""

import html
import re
from dataclasses import dataclass, field

_ATTRIBUTES = r"""((?:[^>"']|"[^"]*"|'[^']*')*+)"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|template|svg|math|iframe|object|noscript|textarea|select|title)\b{_ATTRIBUTES}>(.*?)(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+){_ATTRIBUTES}>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Tags within a block; every other tag ends one.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag ends these if they are open, up to the nearest of the tags after the bar.
_ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _ENDS.items()}


@dataclass
class Block:
    text: str
    marks: frozenset[str]
    parent: str
    link_chars: int
    main: bool | None


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    title: str = ""


class _Open:
    __slots__ = ("main", "marks", "tag")

    def __init__(self, tag: str, marks: frozenset[str], main: bool | None):
        self.tag, self.marks, self.main = tag, marks, main


def clean(text: str) -> str:
    """Character references decoded, white space runs as one space, trimmed."""
    return " ".join((html.unescape(text) if "&" in text else text).split())


def parse(source: str | None) -> Page:
    """Blocks in page order: runs of text between tags that end a block.

    Script, style and other content that is no running text is left out, comments and markup too. Tags left open,
    closed twice or cut off at the end of the page are taken as browsers take them, roughly. A null or empty source
    has no blocks.
    """
    page = Page()
    if not source:
        return page
    stack = [_Open("", frozenset(), None)]
    pieces: list[str] = []
    links, at = 0, 0

    def flush() -> None:
        nonlocal links
        if pieces:
            text = clean("".join(pieces))
            if text:
                holder = next((o for o in reversed(stack) if o.tag not in INLINE), stack[0])
                inner = stack[-1]
                page.blocks.append(Block(text, inner.marks, holder.tag, links, inner.main))
            pieces.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        pieces.append(text)
        if "<a" in stack[-1].marks:
            links += len(text)

    for m in _TOKEN.finditer(source):
        if m.start() > at:
            add(source[at : m.start()])
        at = m.end()
        raw = m[1]
        if raw:
            if raw.lower() == "title" and not page.title:
                page.title = clean(m[3])
            if raw.lower() not in ("math", "textarea", "select"):
                continue
            flush()
            continue
        if m[5]:
            closing, tag, attributes = m[4], m[5].lower(), m[6]
        elif m[8]:
            closing, tag, attributes = m[7], m[8].lower(), m[9]
        else:
            continue
        inline = tag in INLINE
        if tag == "br":
            pieces.append(" ")
            continue
        if not inline:
            flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if inline and stack[i].tag not in INLINE:
                    break
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if not inline:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE:
                    break
            if tag in _ENDS:
                ended, until = _ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in until:
                        break
                    if stack[i].tag in ended:
                        del stack[i:]
                        break
        outer = stack[-1]
        own, main = {"<" + tag}, outer.main
        if attributes:
            for name, *values in _NAMED.findall(attributes):
                value = next((v for v in values if v), "")
                if name.lower() == "data-main":
                    main = value == "1"
                else:
                    own.update("." + w.lower() for w in _WORD.findall(value))
        stack.append(_Open(tag, outer.marks if own <= outer.marks else outer.marks | own, main))
    if at < len(source):
        add(source[at:])
    flush()
    return page
