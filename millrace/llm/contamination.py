"""Evaluation texts in a training corpus (problem 9), by suffix arrays.

Every partition of the corpus is one or more shards. A shard's words become numbers,
its suffix array is built by prefix doubling, and every suffix of every evaluation
item is looked up in it by binary search. That gives each item's longest verbatim
match at every place of the shard. Words that no item has cannot be part of a match;
they are kept as breaks, and suffixes that start closer than ``least`` words before a
break are left out of the array, which loses no match.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INVISIBLE = dict.fromkeys([0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF])
# fixed values: letters that don't decompose into a base letter and an accent
_FOLD = str.maketrans({"ł": "l", "Ł": "l", "ø": "o", "Ø": "o", "đ": "d", "Đ": "d", "ß": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe", "ı": "i", "ħ": "h"})
_OTHER = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
_UNSEEN = re.compile("[" + "".join(map(chr, INVISIBLE)) + "]")


def _ranges(codes: list[int]) -> str:
    """A character class of sorted code points."""
    out, at = [], 0
    for k in range(1, len(codes) + 1):
        if k == len(codes) or codes[k] != codes[k - 1] + 1:
            out.append(f"{chr(codes[at])}-{chr(codes[k - 1])}")
            at = k
    return "[" + "".join(out) + "]+"


_ACCENT = re.compile(_ranges([c for c in range(0x300, 0x110000) if unicodedata.combining(chr(c))]))
_INLINE = re.compile(r"</?(?:a|abbr|b|code|em|i|mark|small|span|strong|sub|sup|u)\b[^<>]*>", re.I)
_TAG = re.compile(r"<!--.*?-->|</?[a-zA-Z][^<>]*>", re.S)
_WORD = re.compile(r"[^\W_]+")
_MARK = re.compile(r"(?<=\w)[*_`~]+(?=\w)")


def words(text: str | None) -> list[str]:
    """Words of a text; case, accents, punctuation, markup, spacing and invisible
    characters don't count. Null and empty texts have none."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _ACCENT.sub("", unicodedata.normalize("NFKD", _UNSEEN.sub("", text)))
        text = _OTHER.sub(lambda m: _FOLD[ord(m[0])], text)
    return _WORD.findall(_MARK.sub("", text).lower())


def suffix_array(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The given starts, ordered by the suffixes' first ``depth`` numbers (or more).

    Prefix doubling over all positions; a suffix that ends sorts first."""
    n = len(data)
    if n == 0 or len(starts) == 0:
        return starts
    rank = np.unique(data, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        after = np.full(n, -1, dtype=np.int64)
        after[: n - step] = rank[step:] if step < n else after[: n - step]
        key = rank * (n + 2) + after + 1
        new = np.unique(key, return_inverse=True)[1]
        done = new.max() == n - 1
        rank = new.astype(np.int64)
        step *= 2
        if done:
            break
    return starts[np.argsort(rank[starts], kind="stable")]


class Items:
    """All suffixes of the evaluation items as rows of numbers."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        own = [(i, words(t)) for i, t in rows]
        self.code = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in own for w in ws}))}
        self.data = np.array([c for _, ws in own for c in [*(self.code[w] for w in ws), 0]], dtype=np.int64)
        self.item = np.array([i for i, ws in own for _ in range(len(ws) + 1)], dtype=np.int64)
        self.pos = np.array([k for _, ws in own for k in range(len(ws) + 1)], dtype=np.int64)
        self.left = np.array([len(ws) - k for _, ws in own for k in range(len(ws) + 1)], dtype=np.int64)
        self.depth = max((len(ws) for _, ws in own), default=1)


def _window(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``size`` numbers from each place, -1 beyond the end."""
    where = at[:, None] + np.arange(size)[None, :]
    return np.where(where < len(data), data[np.minimum(where, len(data) - 1)], -1)


def _before(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 per row: lexicographic order of rows against other."""
    differ = rows != other
    first = differ.argmax(axis=1)
    k = np.arange(len(rows))
    return np.where(differ.any(axis=1), np.sign(rows[k, first] - other[k, first]), 0)


def matches(docs: list[tuple[int, list[str]]], items: Items, least: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(doc, item, words matched, place in the doc, place in the item): for each doc and
    item the longest run of at least ``least`` words, the earliest of equals."""
    if not docs:
        return
    code = items.code
    data = np.array([c for _, ws in docs for c in [*(code.get(w, 0) for w in ws), 0]], dtype=np.int64)
    sizes = np.array([len(ws) + 1 for _, ws in docs])
    owner = np.repeat(np.arange(len(docs)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # words until the next break, for every place
    breaks = np.flatnonzero(data == 0)
    run = breaks[np.searchsorted(breaks, np.arange(len(data)))] - np.arange(len(data))
    # only stretches that can hold a match go into the array
    keep = np.flatnonzero(run >= least)
    if not len(keep):
        return
    stretch = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(stretch, keep, 1)
    np.add.at(stretch, keep + run[keep] + 1, -1)
    inside = np.flatnonzero(np.cumsum(stretch[:-1]) > 0)
    small = data[inside]
    back = np.full(len(data), -1, dtype=np.int64)
    back[inside] = np.arange(len(inside))
    order = suffix_array(small, back[keep], max(items.depth, least))
    queries = np.flatnonzero(items.left >= least)
    want = _window(items.data, queries, least)
    bounds = []
    for side in (0, 1):
        low, high = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), len(order), dtype=np.int64)
        while (open_ := low < high).any():
            mid = (low + high) // 2
            got = _before(_window(small, order[np.minimum(mid, len(order) - 1)], least), want)
            right = open_ & ((got < 0) | ((got == 0) & (side == 1)))
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)
        bounds.append(low)
    found = []
    low, size = bounds[0], bounds[1] - bounds[0]
    hit = np.flatnonzero(size > 0)
    ends = np.cumsum(size[hit])
    for begin_, end_ in _pieces(ends, 1 << 18):
        q = np.repeat(hit[begin_:end_], size[hit[begin_:end_]])
        nth = np.arange(len(q)) - np.repeat(ends[begin_:end_] - size[hit[begin_:end_]] - (ends[begin_ - 1] if begin_ else 0), size[hit[begin_:end_]])
        place, row = inside[order[low[q] + nth]], queries[q]
        most = np.minimum(items.left[row], run[place])
        length = np.full(len(q), least, dtype=np.int64)
        open_ = np.flatnonzero(length < most)
        while len(open_):  # a word further where both go on alike
            same = items.data[row[open_] + length[open_]] == data[place[open_] + length[open_]]
            open_ = open_[same]
            length[open_] += 1
            open_ = open_[length[open_] < most[open_]]
        found.append(_best(owner[place], items.item[row], length, place - begin[owner[place]], items.pos[row]))
    if found:
        for doc, item, words_, place, pos in zip(*_best(*[np.concatenate(c) for c in zip(*found)])):
            yield docs[doc][0], int(item), int(words_), int(place), int(pos)


def _pieces(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of queries with at most ``most`` hits together (more only for a single query)."""
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to
        at = to


def _best(doc, item, length, place, pos):
    """The longest match per doc and item, of equals the first in the doc, then the last in the item."""
    order = np.lexsort((-pos, place, -length, item, doc))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (doc[order][1:] != doc[order][:-1]) | (item[order][1:] != item[order][:-1])
    keep = order[first]
    return doc[keep], item[keep], length[keep], place[keep], pos[keep]


def leaks(docs: DataFrame, items: DataFrame, least: int = 12, shard_words: int = 1_000_000, block: int = 20_000) -> DataFrame:
    """(doc_id, item_id, n_words, doc_word, item_word): each document that holds at least
    ``least`` consecutive words of an item, with the longest match.

    Items travel to the shards in blocks of at most ``block`` items (the stated query
    set), one broadcast each; every shard is searched for block after block, so that the
    corpus is read, and its words are told, once whatever the number of items, and never
    shuffled. Null and empty texts match nothing."""
    context = docs.sparkSession.sparkContext
    part = items.select("item_id", "item_text").where("item_text is not null").distinct()
    n = max(1, -(-part.count() // block))
    own = [context.broadcast(Items([(r[0], r[1]) for r in part.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()])) for k in range(n)]

    def run(batches):
        shard, size = [], 0

        def flush():
            found = [m for b in own for m in matches(shard, b.value, least)]
            return pd.DataFrame(found, columns=["doc_id", "item_id", "n_words", "doc_word", "item_word"]).astype("int64")

        for pdf in batches:
            for doc, text in zip(pdf.doc_id, pdf.text):
                ws = words(text)
                if len(ws) >= least:
                    shard.append((int(doc), ws))
                    size += len(ws)
                if size >= shard_words:
                    yield flush()
                    shard, size = [], 0
        yield flush()

    return docs.select("doc_id", "text").where("text is not null").mapInPandas(run, "doc_id bigint, item_id bigint, n_words bigint, doc_word bigint, item_word bigint")


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that no item leaked into, with all their columns."""
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
