"""The main body of web pages (problem 3): a linear-chain conditional random field
over DOM leaf blocks.

Every leaf block gets features of its ancestors, of its place towards the page's
first heading, of its text and of the blocks it stands together with. The field has
two labels, is trained on labelled pages by gradient ascent on the log-likelihood and
decoded by Viterbi.

No page comes labelled. The training pages are labelled by what repeats over them: what
a board writes around offers stands outside the heading's region on many pages, so that
groups of blocks inside that are worded alike are told from the offer. No wording is listed.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Page, parse

BITS = 16
_WRAP = frozenset("ul ol li table tbody thead tfoot tr dl dt dd".split())
_HASHED = re.compile(r"^[a-z]{2,4}-[0-9a-f]{4,}$")
_DIGITS = re.compile(r"\d+")
_PIECE = re.compile(r"[^\W\d_]+|9+|[^\w\s]|_")


def form(text: str) -> str:
    """A text without case and without its numbers."""
    return _DIGITS.sub("9", text.lower())


def shape(text: str) -> str:
    """How a text is built: words as A (capital), a or x (short), numbers as 9, marks as they are. A
    text of many pieces is told by its end and its length only."""
    pieces = _PIECE.findall(_DIGITS.sub("9", text))
    if len(pieces) > 10:
        return f"{pieces[-1] if not pieces[-1].isalnum() else 'a'}{min(len(pieces) // 10, 4)}+"
    return " ".join(("x" if len(w) < 4 and w.isupper() else "A" if w[0].isupper() else "a") if w[0].isalpha() else w for w in pieces)


class Layout:
    """Where each block of a page stands: its container and its way to the heading."""

    def __init__(self, page: Page):
        blocks, names = page.blocks, page.names
        self.head = next((k for k, b in enumerate(blocks) if b.leaf == "h1"), None)
        self.container: list[int] = []
        self.up: list[int] = []
        self.meet: list[int] = []
        path = blocks[self.head].path[:-1] if self.head is not None else ()
        for k, b in enumerate(blocks):
            inner = list(b.path[:-1])
            while inner and names[inner[-1]] in _WRAP:
                inner.pop()
            self.container.append(inner[-1] if inner else 0)
            shared = 0
            for x, y in zip(path, b.path):
                if x != y:
                    break
                shared += 1
            self.up.append(len(path) - shared if self.head is not None else 99)
            self.meet.append(path[shared - 1] if shared else 0)
        self.inside = [page.names[m] not in ("", "body", "html") for m in self.meet] if self.head is not None else [False] * len(blocks)
        self.groups: dict[int, list[int]] = defaultdict(list)
        for k, c in enumerate(self.container):
            self.groups[c].append(k)


class Wordings:
    """How often texts (by form, rare ones by shape) belong to offers on a sample of pages.

    Starts from the region around each page's first heading; groups of blocks in there whose
    wordings mostly stand outside are taken out, and the counts are made anew."""

    def __init__(self, pages: list[tuple[Page, Layout]], rounds: int = 8, least: int = 5, foreign: float = -1.0):
        self.least, self.foreign = least, foreign
        self.count: dict[str, list[float]] = {}
        seen = [(page, at, [form(b.text) for b in page.blocks], [shape(b.text) for b in page.blocks]) for page, at in pages]
        odd: list[set[int]] = [set() for _ in seen]
        for _ in range(rounds):
            count: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for (_, at, forms, shapes), out in zip(seen, odd):
                for k, (f, s) in enumerate(zip(forms, shapes)):
                    if k != at.head and at.head is not None:
                        main = int(at.inside[k] and at.container[k] not in out)
                        count["f" + f][main] += 1
                        count["s" + s][main] += 1
            self.count = dict(count)
            now = [self.odd(page, at) for page, at, _, _ in seen]
            if now == odd:
                break
            odd = now

    def weight(self, text: str) -> float:
        """Log-odds that a text belongs to an offer."""
        n = self.count.get("f" + form(text), (0.0, 0.0))
        if sum(n) < self.least:
            n = self.count.get("s" + shape(text), (0.0, 0.0))
        return float(np.log((n[1] + 0.5) / (n[0] + 0.5)))

    def odd(self, page: Page, at: Layout) -> set[int]:
        """Containers inside the heading's region, without the heading, that are worded like
        what stands outside: on the whole, or by one text that hardly ever stands in an offer."""
        out = set()
        for c, members in at.groups.items():
            if at.head not in members and at.inside[members[0]]:
                weights = [self.weight(page.blocks[k].text) for k in members]
                if np.mean(weights) < 0 or min(weights) < self.foreign:
                    out.add(c)
        return out


def label(page: Page, at: Layout, wordings: Wordings) -> list[int]:
    """Labels for training pages: 1 for the blocks that share a region below body with the
    first h1, but for groups that are worded like what stands outside."""
    if at.head is None:
        return [0] * len(page.blocks)
    odd = wordings.odd(page, at)
    return [int(at.inside[k] and at.container[k] not in odd) for k in range(len(page.blocks))]


_CODES: dict[str, int] = {}


def _code(feature: str) -> int:
    got = _CODES.get(feature)
    if got is None:
        if len(_CODES) > 500_000:
            _CODES.clear()
        got = _CODES[feature] = zlib.crc32(feature.encode("utf-8", "replace")) & ((1 << BITS) - 1)
    return got


def _text_codes(f: str) -> tuple[int, ...]:
    return tuple({_code("word" + w) for w in f.split()})


_known_codes = lru_cache(maxsize=50_000)(_text_codes)
_known_shape = lru_cache(maxsize=50_000)(shape)


class Rows(NamedTuple):
    """Numbers of the features of a page's blocks: those of each block one after another with
    where each begins, and those of each group of blocks, shared by its members."""

    own: np.ndarray
    starts: np.ndarray
    group: np.ndarray  # group of each block
    shared: np.ndarray
    shared_starts: np.ndarray

    def of(self, k: int) -> np.ndarray:
        """All features of block k."""
        ends = [*self.starts[1:], len(self.own)], [*self.shared_starts[1:], len(self.shared)]
        g = self.group[k]
        return np.concatenate([self.own[self.starts[k] : ends[0][k]], self.shared[self.shared_starts[g] : ends[1][g]]])


def features(page: Page, layout: Layout | None = None) -> Rows:
    """The features of every block, from its whole text."""
    at = layout or Layout(page)
    blocks, names, marks = page.blocks, page.names, page.marks
    forms = [form(b.text) for b in blocks]
    shapes = [_known_shape(b.text) if len(b.text) < 300 else shape(b.text) for b in blocks]
    title = page.title.split(" | ")[0]
    paths: dict[tuple[int, bool], list[int]] = {}  # codes of an element's tag and marks
    numbers: dict[tuple[int, str], int] = {}
    shared: list[set[int]] = []
    own, group = [], []
    head = str(int(at.head is None))
    for k, b in enumerate(blocks):
        inside = at.inside[k]
        same = at.head is not None and at.container[k] == at.container[at.head]
        place = f"{int(inside)}{int(same)}"
        key = (at.container[k], place)
        if key not in numbers:
            numbers[key] = len(shared)
            bag: set[int] = set()
            for m in at.groups[at.container[k]]:
                if m != at.head:
                    for w in ("s" + shapes[m], "w" + forms[m] if len(forms[m]) < 60 else "w-long"):
                        bag.add(_code("bag" + w + place))
                        if inside:
                            bag.add(_code("bagin" + w))
            shared.append(bag)
        group.append(numbers[key])
        f = {
            _code(x) for x in (
                "one", "in" + place, "leaf" + b.leaf, f"leaf{b.leaf}{place}", "shape" + shapes[k], f"shape{shapes[k]}{place}", "text" + forms[k] if len(forms[k]) < 60 else "text-long", "head" + head,
                f"up{min(at.up[k], 5)}", f"down{min(len(b.path), 12)}", "cont" + names[at.container[k]] + place, f"title{int(b.text == title)}")
        }
        for n in b.path:
            if (n, inside) not in paths:
                paths[n, inside] = [_code(f"tag{names[n]}{int(inside)}"), *(_code("mark" + m) for m in marks[n].split() if not _HASHED.match(m))]
            f.update(paths[n, inside])
        f.update(_known_codes(forms[k]) if len(forms[k]) < 300 else _text_codes(forms[k]))
        own.append(f)
    sizes, widths = [len(x) for x in own], [len(x) for x in shared]
    flat = lambda sets, n: np.fromiter((c for x in sets for c in x), dtype=np.int32, count=n)
    begin = lambda n: np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64) if n else np.empty(0, np.int64)
    return Rows(flat(own, sum(sizes)), begin(sizes), np.array(group, dtype=np.int64), flat(shared, sum(widths)), begin(widths))


def _normal(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    """A linear-chain conditional random field with two labels."""

    def __init__(self):
        self.emit = np.zeros((1 << BITS, 2), dtype=np.float64)
        self.move = np.zeros((2, 2))

    def scores(self, rows: Rows) -> np.ndarray:
        out = np.add.reduceat(self.emit[rows.own], rows.starts, axis=0)
        widths = np.diff(np.append(rows.shared_starts, len(rows.shared)))
        alone = np.zeros((len(widths), 2))
        if len(rows.shared):
            alone[widths > 0] = np.add.reduceat(self.emit[rows.shared], rows.shared_starts[widths > 0], axis=0)
        return out + alone[rows.group]

    def marginals(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label) of each block and the expected number of each move."""
        n = len(score)
        forth, back = np.zeros((n, 2)), np.zeros((n, 2))
        forth[0] = score[0]
        for t in range(1, n):
            forth[t] = score[t] + _normal(forth[t - 1][:, None] + self.move, 0)
        for t in range(n - 2, -1, -1):
            back[t] = _normal(self.move + (score[t + 1] + back[t + 1])[None, :], 1)
        total = _normal(forth[-1], 0)
        one = np.exp(forth + back - total)
        two = np.exp(forth[:-1, :, None] + self.move[None] + (score[1:] + back[1:])[:, None, :] - total).sum(axis=0) if n > 1 else np.zeros((2, 2))
        return one, two

    def fit(self, pages: list[tuple[Rows, list[int]]], epochs: int = 6, rate: float = 0.25, decay: float = 1e-4) -> Field:
        """Gradient ascent with per-weight steps on the pages' log-likelihood."""
        seen_e, seen_m = np.full_like(self.emit, 1e-6), np.full_like(self.move, 1e-6)
        order = np.random.default_rng(7)
        whole = [[rows.of(k) for k in range(len(gold))] for rows, gold in pages]
        for _ in range(epochs):
            for p in order.permutation(len(pages)):
                rows, gold = pages[p]
                if not gold:
                    continue
                one, two = self.marginals(self.scores(rows))
                target = np.eye(2)[gold]
                moves = -two
                for a, b in zip(gold, gold[1:]):
                    moves[a, b] += 1
                where = np.concatenate(whole[p])
                step = np.repeat(target - one, [len(r) for r in whole[p]], axis=0)
                ids, back = np.unique(where, return_inverse=True)
                grad = np.zeros((len(ids), 2))
                np.add.at(grad, back, step)
                grad -= decay * self.emit[ids]
                seen_e[ids] += grad**2
                self.emit[ids] += rate * grad / np.sqrt(seen_e[ids])
                seen_m += moves**2
                self.move += rate * moves / np.sqrt(seen_m)
        return self

    def decode(self, rows: Rows) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not len(rows.starts):
            return []
        score = self.scores(rows)
        best, came = score[0], []
        for t in range(1, len(score)):
            all_ = best[:, None] + self.move
            came.append(all_.argmax(axis=0))
            best = score[t] + all_.max(axis=0)
        out = [int(best.argmax())]
        for step in reversed(came):
            out.append(int(step[out[-1]]))
        return out[::-1]


def train(pages: DataFrame, sample: int = 500) -> Field:
    """Fits the field on at most ``sample`` pages, those of the smallest hashes."""
    ids = [r[0] for r in pages.where("html is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id")).limit(sample).collect()]
    rows = pages.where(F.col("html").isNotNull() & F.col("page_id").isin(ids)).select("page_id", "html").dropDuplicates(["page_id"]).collect() if ids else []
    read = [(page, Layout(page)) for page in (parse(r.html) for r in sorted(rows, key=lambda r: r.page_id))]
    wordings = Wordings(read)
    return Field().fit([(features(page, at), label(page, at, wordings)) for page, at in read])


def main_blocks(pages: DataFrame, field: Field) -> DataFrame:
    """(page_id, block_no, text, text_md5): the main body's paragraphs in order.

    Null, empty and body-less pages give no rows. The field is a fixed 1 MB and
    travels with the task; pages are never shuffled."""
    emit, move = field.emit.astype(np.float32), field.move
    used = np.flatnonzero(np.abs(emit).sum(axis=1))
    packed = (used, emit[used], move)

    def run(batches):
        own = Field()
        own.emit[packed[0]] = packed[1]
        own.move = packed[2]
        for pdf in batches:
            out = []
            for page_id, source in zip(pdf.page_id, pdf.html):
                page = parse(source)
                for no, (b, y) in enumerate(zip(page.blocks, own.decode(features(page)))):
                    if y:
                        out.append((page_id, no, b.text, hashlib.md5(b.text.encode("utf-8", "surrogatepass")).hexdigest()))
            yield pd.DataFrame(out, columns=["page_id", "block_no", "text", "text_md5"])

    return pages.where("html is not null").select("page_id", "html").mapInPandas(run, "page_id bigint, block_no int, text string, text_md5 string")


def summary(labels: list[list[int]], found: list[list[int]]) -> dict[str, float]:
    c = Counter((g, y) for gs, ys in zip(labels, found) for g, y in zip(gs, ys))
    return {"precision": c[1, 1] / max(1, c[1, 1] + c[0, 1]), "recall": c[1, 1] / max(1, c[1, 1] + c[1, 0])}
