"""Leaf blocks of html pages: the paragraphs between tags, with their ancestors.

A paragraph is the text between two tags that are not inline, entities decoded,
each run of white space one space, trimmed and not empty. Comments vanish; head,
script, style, noscript and template hold no paragraph. Sloppy markup is taken as
browsers take it: p, li, td, th, tr, dt, dd and option close at the next of their kind,
an end tag closes up to its start, one without a start is ignored. Elements with
names of their own (with a hyphen) count as sections: an open p ends before them.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# fixed values: tags that do not end a paragraph, tags that hold none, tags without content
INLINE = frozenset("a abbr b code em i mark small span strong sub sup u".split())
HIDDEN = ("head", "script", "style", "noscript", "template")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_SCOPE = frozenset("table ul ol dl div section main article nav aside header footer body html tbody td".split())
_BLOCK = frozenset("p div ul ol li table section main article nav aside header footer h1 h2 h3 h4 h5 h6 form dl blockquote pre hr".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_CLASS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    path: tuple[int, ...]  # numbers of the open elements, outermost first
    leaf: str  # tag right around the text


class Page(NamedTuple):
    blocks: list[Block]
    names: list[str]  # tag of each element
    marks: list[str]  # class, id and role of each element
    title: str


def parse(source: str | None) -> Page:
    """The leaf blocks of a page in order. Null and empty pages have none."""
    blocks: list[Block] = []
    names, marks = [""], [""]
    stack: list[tuple[str, int]] = []
    text: list[str] = []
    title: list[str] = []
    hidden: list[str] = []
    in_title = False

    def flush() -> None:
        if text:
            words = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if words:
                blocks.append(Block(words, tuple(n for _, n in stack), stack[-1][0] if stack else ""))

    for found in _TOKEN.finditer(source or ""):
        end, tag, rest, words = found.groups()
        if words is not None:
            if in_title:
                title.append(words)
            if not hidden:
                text.append(words)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "title" and "head" in hidden:
            in_title = not end
        if hidden:
            if end and tag == hidden[-1]:
                hidden.pop()
            elif not end and tag in HIDDEN and hidden[-1] not in ("script", "style"):
                hidden.append(tag)
            elif not end and tag == "body" and hidden == ["head"]:
                hidden.clear()
            if hidden or end:
                continue
            if tag != "body":
                continue
        if tag in INLINE:
            continue
        flush()
        if tag in HIDDEN:
            if not end and not rest.endswith("/"):
                hidden.append(tag)
            continue
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        block = tag in _BLOCK or "-" in tag
        if tag in _CLOSES or (block and stack and stack[-1][0] == "p"):
            shut = _CLOSES.get(tag, set()) | ({"p"} if block else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    del stack[k:]
                elif (stack[k][0] in _SCOPE or "-" in stack[k][0]) and not (tag == "tr" and stack[k][0] == "td"):
                    break
        if tag in VOID or rest.endswith("/"):
            continue
        names.append(tag)
        marks.append(" ".join(a or b or c for _, a, b, c in _CLASS.findall(rest)))
        stack.append((tag, len(names) - 1))
    if not hidden:
        flush()
    return Page(blocks, names, marks, _SPACE.sub(" ", html.unescape("".join(title))).strip())
