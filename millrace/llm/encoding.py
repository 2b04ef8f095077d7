"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 8).

Texts are split into words by the tokenizer's own pattern. The distinct words of a
batch go into one trie over bytes. For byte-pair encodings the encoding of a prefix
is fixed by its last token: it is the suffix token t whose remaining prefix ends in a
token that t may follow. So a depth-first walk hands each node the last-token states
of its ancestors and computes every shared prefix once; a word's ids are then read
back through the states along its path.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class PairRules:
    """Which two tokens may stand beside each other in a byte-pair encoding."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.text = {i: t for t, i in ranks.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._may: dict[tuple[int, int], bool] = {}

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one; None for a single byte."""
        if token not in self._parts:
            whole = self.text[token]
            pieces = [bytes([b]) for b in whole]
            while len(pieces) > 2:
                best = min(range(len(pieces) - 1), key=lambda k: self.ranks.get(pieces[k] + pieces[k + 1], 1 << 60))
                pieces[best : best + 2] = [pieces[best] + pieces[best + 1]]
            self._parts[token] = None if len(pieces) < 2 else (self.ranks[pieces[0]], self.ranks[pieces[1]])
        return self._parts[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both gives exactly these two tokens."""
        key = (left, right)
        if key not in self._may:
            a, b = self.text[left], self.text[right]
            self._may[key] = (a + b) not in self.ranks and self._holds(left, right)
        return self._may[key]

    def _holds(self, left: int, right: int) -> bool:
        whole = self.text[left] + self.text[right]
        cut = len(self.text[left])
        pieces = [bytes([b]) for b in whole]
        while True:
            best, at = 1 << 60, -1
            for k in range(len(pieces) - 1):
                rank = self.ranks.get(pieces[k] + pieces[k + 1], 1 << 60)
                if rank < best:
                    best, at = rank, k
            if at < 0:
                break
            if sum(map(len, pieces[:at])) < cut < sum(map(len, pieces[: at + 2])) and sum(map(len, pieces[: at + 1])) == cut:
                return False
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return len(pieces) == 2 and len(pieces[0]) == cut


class WordTrie:
    """Words over bytes with the last token of the encoding of every prefix."""

    def __init__(self, rules: PairRules):
        self.rules = rules
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[int, int]] = [{}]
        self.state: list[int] = [-1]  # last token of the prefix that ends here
        self.found: dict[str, list[int]] = {}

    def add(self, words: list[str]) -> None:
        """Encodes all words that are new, sharing the work of common prefixes."""
        ends: dict[int, str] = {}
        for word in words:
            node = 0
            for byte in word.encode("utf-8"):
                down = self.children[node]
                node = down.get(byte) or self._grow(down, byte)
            ends[node] = word
        self._walk(ends)

    def _grow(self, down: dict[int, int], byte: int) -> int:
        self.children.append({})
        self.state.append(-1)
        down[byte] = len(self.state) - 1
        return down[byte]

    def _walk(self, ends: dict[int, str]) -> None:
        """Depth first; the states along the path are at hand as a stack."""
        prefix = bytearray()
        states: list[int] = []
        todo = [(child, byte, 0) for byte, child in self.children[0].items()]
        while todo:
            node, byte, depth = todo.pop()
            del prefix[depth:], states[depth:]
            prefix.append(byte)
            if self.state[node] < 0:
                self.state[node] = self._last(bytes(prefix[-self.rules.longest :]), states)
            states.append(self.state[node])
            if node in ends:
                self.found[ends[node]] = self._back(states)
            todo.extend((child, b, depth + 1) for b, child in self.children[node].items())

    def _last(self, tail: bytes, states: list[int]) -> int:
        """The last token of a prefix, from the states of all shorter prefixes."""
        ranks, n = self.rules.ranks, len(states) + 1
        for size in range(len(tail), 0, -1):
            token = ranks.get(tail[len(tail) - size :])
            if token is not None and (size == n or self.rules.may_follow(states[n - size - 1], token)):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def _back(self, states: list[int]) -> list[int]:
        out, end = [], len(states)
        while end > 0:
            token = states[end - 1]
            out.append(token)
            end -= len(self.rules.text[token])
        out.reverse()
        return out


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _trie(path: str) -> WordTrie:
    return WordTrie(PairRules(load_ranks(path)))


def encode_texts(texts: list[str | None], path: str, pattern: str, max_nodes: int = 3_000_000) -> list[list[int]]:
    """Ids of each text without special tokens; null and empty texts have none.

    ``max_nodes`` bounds a worker's memory: a fuller trie is started anew between
    batches, which changes no result."""
    import regex

    split = regex.compile(pattern).findall
    trie = _trie(path)
    if len(trie.state) > max_nodes:
        trie.clear()
    words = [split(t) if t else [] for t in texts]
    new = {w for row in words for w in row if w not in trie.found}
    trie.add(sorted(new))
    found = trie.found
    out = []
    for row in words:
        ids: list[int] = []
        for w in row:
            ids += found[w]
        out.append(ids)
    return out


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of every row's text. Null and empty texts have the empty
    list. Narrow: no shuffle, memory bounded by one Arrow batch and the trie."""

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                ids = encode_texts([t if isinstance(t, str) else None for t in part[text]], path, pattern)
                yield pd.DataFrame({key: part[key].to_numpy(), "ids": [np.asarray(x, dtype="int32") for x in ids]})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(run, f"{key} {kind}, ids array<int>")
