"""Html pages: a small tolerant parser, cleaning per board, Markdown, embedded JSON.

One Arrow UDF reads a page once and gives everything later steps need from it."""

from __future__ import annotations

import html
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style".split())
_CLOSE = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "option": {"option"}}
_WALL = frozenset("ul ol table div section main article body html td".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(.*?)(/?)>$", re.S)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_HYDRATION = re.compile(r"<!--(?: |\$|/\$)?-->")

# fixed values: what boards put around an offer, by board
JJI_BANNER, JJI_BANNER_LEVELS = "#1 Job Board for tech industry in Europe", 5
JJI_ADVERT, JJI_ADVERT_LEVELS = "ADVERTISEMENT: Recommended by Just Join IT", 2
JJI_PLACES, JJI_PLACES_LEVELS = "/job-offers/all-locations", 2
JJI_COOKIES = "cookiescript_injected_wrapper"
JJI_CLASSES = ("mui-", "Mui")
NFJ_CONTENT = ("common-posting-content-wrapper", "common-apply-box")
NFJ_CLASSES = ("tw-", "tr-", "mb-", "ng-")
BDJ_CLASSES = ("cookie-bar", "bg-action", "bg-black")
BDJ_MENU, BDJ_TAGS, BDJ_HEADING = "main-menu", ("footer", "next-route-announcer"), "Similar offers"
DROPPED_TAGS = ("script", "noscript", "img", "svg", "style", "iframe")
KEPT_ATTRIBUTES = ("href", "id", "class", "type")
JJI_CONSENT = "By applying, I consent to the processing of my personal data"
JJI_LINES = ("Show menu\n", "Save\n", "Apply\n", "Applied -\n")
BDJ_LINES = ("Apply\n",)


class Node:
    """An element (tag), a text (tag None) or a comment (tag '!')."""

    __slots__ = ("attrs", "children", "parent", "tag", "text")

    def __init__(self, tag: str | None, text: str = "", attrs: dict[str, str] | None = None):
        self.tag, self.text, self.attrs, self.children, self.parent = tag, text, attrs or {}, [], None

    def add(self, child: Node) -> Node:
        child.parent = self
        self.children.append(child)
        return child

    def drop(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def walk(self):
        """All elements below, in document order; safe against changes on the way."""
        for c in list(self.children):
            if c.tag not in (None, "!"):
                yield c
                yield from c.walk()

    def all_text(self) -> str:
        return "".join(c.text if c.tag is None else "" if c.tag == "!" else c.all_text() for c in self.children)

    def above(self, n: int) -> Node | None:
        out = self
        for _ in range(n):
            out = out.parent if out is not None else None
        return out

    def html(self) -> str:
        return "".join(c._outer() for c in self.children)

    def _outer(self) -> str:
        if self.tag is None:
            return html.escape(self.text, quote=False)
        if self.tag == "!":
            return f"<!--{self.text}-->"
        attrs = "".join(f' {k}="{html.escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>" if self.tag in VOID else f"<{self.tag}{attrs}>{self.html()}</{self.tag}>"


def parse(source: str) -> Node:
    """A tree of whatever is given; unclosed and stray tags do not fail."""
    root = here = Node("#")
    raw = None
    for token in _TOKEN.findall(_HYDRATION.sub("", source)):
        if raw:
            if token.lower().startswith(f"</{raw}"):
                here, raw = here.parent or root, None
            else:
                here.add(Node(None, token))
            continue
        if token.startswith("<!--"):
            here.add(Node("!", token[4:-3]))
            continue
        found = _TAG.match(token)
        if not found:
            if not token.startswith(("<!", "<?")):
                here.add(Node(None, html.unescape(token)))
            continue
        end, tag, rest, single = found.group(1), found.group(2).lower(), found.group(3), found.group(4)
        if end:
            at = here
            while at is not root and at.tag != tag:
                at = at.parent
            if at is not root:
                here = at.parent
            continue
        if tag in _CLOSE:
            at = here
            while at is not root and at.tag not in _WALL - _CLOSE[tag] and at.tag not in _CLOSE[tag]:
                at = at.parent
            if at.tag in _CLOSE[tag]:
                here = at.parent
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(rest)}
        node = here.add(Node(tag, attrs=attrs))
        if tag not in VOID and not single:
            here, raw = node, tag if tag in _RAW else None
    return root


def _blank_pass(root: Node) -> None:
    """One pass in document order: childless elements without text go, few attributes stay."""
    for e in root.walk():
        if not e.all_text().strip() and not any(c.tag not in (None, "!") for c in e.children):
            e.drop()
        e.attrs = {k: v for k, v in e.attrs.items() if k in KEPT_ATTRIBUTES}


def _keep_classes(root: Node, prefixes: tuple[str, ...]) -> None:
    for e in root.walk():
        if "class" in e.attrs:
            e.attrs["class"] = " ".join(c for c in e.attrs["class"].split() if not c.startswith(prefixes))


def clean_page(source: str, board: str) -> str:
    """A page without scripts, pictures, blanks and what its board puts around the offer."""
    return _cleaned(parse(source), board)


def _cleaned(root: Node, board: str) -> str:
    for e in root.walk():
        if e.tag in DROPPED_TAGS:
            e.drop()
    root.children = [c for c in root.children if c.tag != "!"]
    _blank_pass(root)
    if board == "jji":
        for e in root.walk():
            text = e.all_text().strip() if e.tag == "span" else ""
            up = JJI_BANNER_LEVELS if text.startswith(JJI_BANNER) else JJI_ADVERT_LEVELS if text.startswith(JJI_ADVERT) else 0
            if e.tag == "a" and e.attrs.get("href") == JJI_PLACES:
                up = JJI_PLACES_LEVELS
            target = e.above(up) if up else e if e.tag == "footer" or e.attrs.get("id") == JJI_COOKIES else None
            if target is not None and target is not root:
                target.drop()
        _blank_pass(root)
        _keep_classes(root, JJI_CLASSES)
    elif board == "nfj":
        _blank_pass(root)
        _keep_classes(root, NFJ_CLASSES)
        first = lambda tag: next((e.html() for e in root.walk() if e.tag == tag), "")
        return "".join(map(first, NFJ_CONTENT))
    elif board == "bdj":
        for e in root.walk():
            if e.attrs.get("id") == BDJ_MENU or e.tag in BDJ_TAGS or set(BDJ_CLASSES) & set(e.attrs.get("class", "").split()):
                e.drop()
            elif e.tag == "h3" and e.all_text().startswith(BDJ_HEADING) and e.parent is not root:
                e.parent.drop()
    return root.html()


def to_markdown(cleaned: str, board: str = "") -> str:
    """Markdown of a cleaned page: headings, paragraphs, lists, links, emphasis, code, tables."""
    return _markdown(parse(cleaned), board)


def _markdown(tree: Node, board: str) -> str:
    out: list[str] = []

    def inline(n: Node) -> str:
        if n.tag is None:
            return re.sub(r"\s+", " ", n.text)
        if n.tag == "!":
            return ""
        body = "".join(map(inline, n.children))
        if n.tag == "br":
            return "\n"
        mark = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}.get(n.tag, "")
        if n.tag == "a" and n.attrs.get("href") and body.strip():
            return f"[{body.strip()}]({n.attrs['href']})"
        return f"{mark}{body}{mark}" if mark and body.strip() else body

    inner = frozenset("a b strong i em code span small sub sup u mark abbr br label".split())

    def block(n: Node, depth: int = 0) -> None:
        line: list[str] = []

        def flush(prefix: str = "", after: str = "\n\n") -> None:
            text = "".join(line).strip()
            line.clear()
            if text:
                out.append(prefix + text + after)

        for c in n.children:
            if c.tag is None or c.tag in inner:
                line.append(inline(c))
                continue
            flush()
            if c.tag == "!":
                continue
            if re.fullmatch(r"h[1-6]", c.tag):
                text = inline(c).strip()
                if text:
                    out.append("#" * int(c.tag[1]) + f" {text}\n\n")
            elif c.tag in ("ul", "ol"):
                for k, item in enumerate((x for x in c.children if x.tag == "li"), 1):
                    own = "".join(inline(x) for x in item.children if x.tag is None or x.tag in inner or x.tag == "p").strip()
                    if own:
                        out.append("\t" * depth + (f"{k}. " if c.tag == "ol" else "- ") + own + "\n")
                    for x in item.children:
                        if x.tag in ("ul", "ol"):
                            wrap = Node("#")
                            wrap.children = [x]
                            block(wrap, depth + 1)
                if not depth:
                    out.append("\n")
            elif c.tag == "tr":
                cells = [inline(x).strip() for x in c.children if x.tag in ("td", "th")]
                if any(cells):
                    out.append("| " + " | ".join(cells) + " |\n")
            elif c.tag == "pre":
                out.append("```\n" + c.all_text().strip("\n") + "\n```\n\n")
            elif c.tag == "hr":
                out.append("---\n\n")
            else:
                block(c, depth)
        flush()

    block(tree)
    text = "".join(out).replace("\r\n", "\n")
    if board == "jji":
        text = "\n".join(x for x in text.split("\n") if not x.lstrip().startswith(JJI_CONSENT))
    for line in JJI_LINES if board == "jji" else BDJ_LINES if board == "bdj" else ():
        text = text.replace(line, "")
    lines = [x.strip(" ") for x in text.split("\n")]
    blank = [not x.strip(" \t") for x in lines]
    # the second and later of empty lines in a row go, but for one at either end of the text
    return "\n".join(x for k, x in enumerate(lines) if not (1 < k < len(lines) - 1 and blank[k] and blank[k - 1]))


def embedded(root: Node, kind: str) -> list[str]:
    """The JSON of all scripts of a type in a page; what doesn't parse is {}."""
    out = []
    for e in root.walk():
        if e.tag == "script" and e.attrs.get("type") == kind:
            try:
                json.loads(e.all_text())
                out.append(e.all_text())
            except ValueError:
                out.append("{}")
    return out


# fixed values: wordings before the last day of an offer
ENDS = ("Valid for", "Ważna do")


def page_end(root: Node) -> str | None:
    """The last day of an offer as its page tells it: the first paragraph of the div that
    follows a paragraph that begins with one of ENDS; of several the last."""
    out = None
    for e in root.walk():
        if e.tag == "p" and e.all_text().startswith(ENDS):
            after = [c for c in e.parent.children if c.tag not in (None, "!")]
            k = next(i for i, c in enumerate(after) if c is e) + 1
            if k < len(after) and after[k].tag == "div":
                out = next((p.all_text().strip() for p in after[k].walk() if p.tag == "p"), "")
    return out


PAGE = "clean string, md string, n_paragraphs int, ends string, ld_json array<string>, app_json array<string>"


def read_page(page: Column, board: Column) -> Column:
    """One pass over a page: its cleaned html, Markdown, paragraphs, last day and embedded JSON."""
    return F.pandas_udf(_read_pages, PAGE)(page, board)


def _read_pages(pages: pd.Series, boards: pd.Series) -> pd.DataFrame:
    """The fields of PAGE. The page and its cleaned form are parsed once each. Null pages give
    nulls."""
    rows = []
    for source, board in zip(pages, boards):
        if not isinstance(source, str):
            rows.append((None,) * 6)
            continue
        raw = parse(source)
        ld, app = embedded(raw, "application/ld+json"), embedded(raw, "application/json")
        cleaned = _cleaned(raw, board)
        tree = parse(cleaned)
        rows.append((cleaned, _markdown(tree, board), sum(e.tag == "p" for e in tree.walk()), page_end(tree), ld, app))
    return pd.DataFrame(rows, columns=["clean", "md", "n_paragraphs", "ends", "ld_json", "app_json"])


def scripts(c: Column, kind: str) -> Column:
    """The raw contents of all scripts of a type, without a parser."""
    return F.regexp_extract_all(c, F.lit(rf'(?is)<script[^>]*type="{re.escape(kind)}"[^>]*>(.*?)</script>'), F.lit(1))


def strip_tags(c: Column) -> Column:
    """Plain text: scripts, styles, comments and tags removed, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<!--.*?-->", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"[ \t\n\r\f]+", " "))


def table_rows(c: Column) -> Column:
    """Rows of a simple table as arrays of cell texts."""
    rows = F.regexp_extract_all(c, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(x, r"<[^>]*>", ""))))
