"""Variant spellings of names of firms and persons (problem 7).

A name is parted into its core (what distinguishes the firm or the surname), a first
name and words that many names share. Cores meet through MinHash banding over padded
q-grams, whose bands are chosen from the collision curve for a wanted recall; pairs are
verified by Monge-Elkan similarity of their tokens and clustered by stars.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, parts
from .canonical import Vocabulary, distance, fold

# fixed values: legal forms, over folded text
_LEGAL = re.compile(
    r"(?<!\w)(?:spolka\s+z(?:\s+ograniczona\s+odpowiedzialnoscia|\s*o\.?\s*o\.?)|sp\.?\s*z\s*o\.?\s*o\.?|spolka\s+akcyjna|s\.\s?a\.?|sa|spolka\s+komandytowa|sp\.?\s*komandytowa|sp\.?\s*k\.?|spolka\s+jawna|sp\.?\s*j\.?"
    r"|spol\.?\s*s\s*r\.?\s*o\.?|s\.?\s*r\.?\s*o\.?|a\.\s?s\.?|gesellschaft\s+mbh|g\.?\s?m\.?\s?b\.?\s?h\.?|mbh|ag|limited|ltd\.?|llc|plc|incorporated|inc\.?|corporation|corp\.?)(?!\w)"
)
# fixed values: words of trade that names share, with their short forms
_TRADE = (
    "consulting consult consultants consultant cons doradztwo dor software softw soft sw programowanie program prog services service serv svcs svc systems system syst sys industries industry inds ind przemysl"
    " laboratories laboratory laboratoria labs lab solutions solution solns soln sol rozwiazania group grupa grp gr technologies technology technologie techn tech polska poland pol pl international internat intl int engineering engineers"
    " engineer engg engrg eng insurance insur ins ubezpieczenia logistics logistic logist logistyka log it informatyczne uslugi usl studio std studios holding company co firma przedsiebiorstwo deutschland europe digital"
).split()
# fixed values: given names with their short forms, over folded text
GIVEN = {
    "grzegorz": "greg grzesiek grzes gregor", "helena": "hela lena helenka helen", "tomasz": "tomek tom tomus thomas", "zuzanna": "zuza zuzia zuzka", "bartlomiej": "bartek bart bartosz", "robert": "rob bob robcio robek bobby",
    "ignacy": "ignas nacek", "aleksander": "alek alex olek alexander", "william": "will bill billy willy", "dorothea": "dora thea dorothy dorota", "katarzyna": "kasia kaska kate katherine", "stanislaw": "staszek stach stas",
    "jakub": "kuba jake jakob jacob", "malgorzata": "gosia malgosia margaret", "elzbieta": "ela elka elizabeth", "jan": "janek jasiek john", "anna": "ania anka", "piotr": "piotrek peter", "pawel": "pawelek paul", "krzysztof": "krzysiek krzys", "andrzej": "jedrek",
    "michal": "michalek mike michael", "maria": "marysia mary", "joanna": "asia joasia", "agnieszka": "aga", "magdalena": "magda", "wojciech": "wojtek", "marcin": "marcinek", "mateusz": "mati", "lukasz": "lukaszek", "barbara": "basia", "ewa": "ewka", "jozef": "jozek joseph",
    "tadeusz": "tadek", "zbigniew": "zbyszek", "ryszard": "rysiek richard", "henryk": "heniek henry", "karolina": "karola", "natalia": "natalka", "aleksandra": "ola", "monika": "monia", "edward": "edek ed", "franciszek": "franek frank", "antoni": "antek tony",
}
_GIVEN = {w: k for k, short in GIVEN.items() for w in (k, *short.split())}
_TRADES = Vocabulary({t for t in _TRADE if len(t) > 5}, reach=2)
_FIRSTS = Vocabulary({g for g in _GIVEN if len(g) > 4}, reach=1)
_LINK = frozenset("i and und et y oraz a".split())
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?\.?")


class Name(NamedTuple):
    core: tuple[str, ...]  # sorted tokens; a cut-off one keeps its point
    first: str  # full given name, one letter for an initial, or empty


def part_name(text: str | None) -> Name | None:
    """The parts of a name; None for null, empty and wordless ones."""
    if not isinstance(text, str):
        return None
    plain = re.sub(r"\s+", " ", fold(text)).strip()
    web = re.fullmatch(r"(?:https?://)?(?:www\.)?([\w-]+)\.[\w.]+/?", plain)
    if web and " " not in plain:
        plain = web.group(1)
    plain = _LEGAL.sub(" ", plain)
    rough = _WORD.findall(plain.replace("'", ""))
    first, core = "", []
    for k, raw in enumerate(rough):
        t = raw.rstrip(".")
        if t in _GIVEN and not first:
            first = _GIVEN[t]
        elif len(t) == 1:
            if t in _LINK and not raw.endswith(".") and 0 < k < len(rough) - 1:
                continue
            first = first or t
        elif t in _LINK or t in _TRADE or (len(t) > 5 and any(s >= 0.8 for _, s in _TRADES.near(t))):
            continue
        elif not first and len(t) > 4 and not raw.endswith(".") and _FIRSTS.near(t):
            first = _GIVEN[_FIRSTS.near(t)[0][0]]
        else:
            core.append(raw if raw.endswith(".") and k < len(rough) else t)
    if not core:
        core = [r.rstrip(".") for r in rough if len(r.rstrip(".")) > 1] or [r.rstrip(".") for r in rough]
        first = ""
    return Name(tuple(sorted(core)), first) if core else None


def grams(core: tuple[str, ...], q: int = 2) -> set[str]:
    """Padded q-grams of all tokens; a cut-off token has no end. With q = 2 a name run
    together, in any order of its parts, loses no more than the grams at the joints."""
    out = set()
    for t in core:
        padded = "#" * (q - 1) + t.rstrip(".") + ("" if t.endswith(".") else "$")
        out |= {padded[k : k + q] for k in range(max(1, len(padded) - q + 1))}
    return out


def collision(s: float, rows: int, bands: int) -> float:
    """Chance that texts of Jaccard similarity s share a band."""
    return 1 - (1 - s**rows) ** bands


def bands_for(s: float, rows: int, recall: float) -> int:
    """Bands needed to catch pairs of similarity s with the wanted recall."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - s**rows)))


_HASHES: list[tuple[np.ndarray, np.ndarray]] = []


def _hashes(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the first ``size`` hash functions, drawn once per process."""
    if not _HASHES or len(_HASHES[0][0]) < size:
        rng = np.random.default_rng(11)
        drawn = rng.integers(1, 1 << 61, (max(size, 2048), 2), dtype=np.uint64)
        _HASHES[:] = [(drawn[:, 0] | np.uint64(1), drawn[:, 1])]
    return _HASHES[0][0][:size], _HASHES[0][1][:size]


@lru_cache(10_000)
def _hashed(item: str, size: int) -> np.ndarray:
    a, b = _hashes(size)
    with np.errstate(over="ignore"):
        h = np.uint64(xxhash.xxh64_intdigest(item)) * a + b
    return h ^ (h >> np.uint64(29))


def signature(items: set[str], size: int) -> np.ndarray:
    """MinHash signature of a set. A longer signature begins with the shorter."""
    return np.minimum.reduce([_hashed(i, size) for i in items])


def _edits(a: str, b: str, most: int) -> int:
    """``distance``, without its grid where the letters alone tell that more edits are needed:
    an edit changes at most one letter on either side, a swap none."""
    rest, lost = b, 0
    for c in a:
        if c in rest:
            rest = rest.replace(c, "", 1)
        else:
            lost += 1
    return most + 1 if max(lost, len(rest)) > most else distance(a, b, most)


def _token(a: str, b: str) -> float:
    """Similarity of two tokens: edits, or a cut-off token that begins the other."""
    cut_a, cut_b = a.endswith("."), b.endswith(".")
    x, y = a.rstrip("."), b.rstrip(".")
    if x == y:
        return 1.0
    if cut_a and len(x) >= 3 or cut_b and len(y) >= 3:
        short, long = (x, y) if cut_a and (not cut_b or len(x) <= len(y)) else (y, x)
        if long.startswith(short):
            return 0.97
        if len(short) > 4 and _edits(short, long[: len(short)], 1) <= 1:
            return 0.85
    size = max(len(x), len(y))
    most = int(0.4 * size)  # less alike counts as not alike
    n = _edits(x, y, most)
    return 1 - n / size if size and n <= most else 0.0


def monge_elkan(a: tuple[str, ...], b: tuple[str, ...], least: float = 0.6) -> float:
    """Mean over the tokens of the longer core of the best similarity in the other; 0 if a
    token of either finds nothing of at least ``least``. Cores that differ in gaps only are
    compared without them, in either order."""
    sims = [[_token(x, y) for y in b] for x in a]
    rows, cols = [max(r) for r in sims], [max(c) for c in zip(*sims)]
    out = min(np.mean(rows), np.mean(cols)) if min(rows + cols) >= least else 0.0
    if len(a) != len(b) and min(len(a), len(b)) == 1:
        few, many = (a, b) if len(a) < len(b) else (b, a)
        out = max(out, _run_together(few[0], many))
    return float(out)


def _run_together(one: str, many: tuple[str, ...]) -> float:
    """Similarity of one token and several without gaps, in any order: at most 3 edits, or one
    where either is cut off. All orders of up to four; of more, a search over the tokens that
    may stand at each place, within the edits that are left."""
    whole = one.rstrip(".")
    if len(many) > 4:
        size = max(len(whole), sum(len(t.rstrip(".")) for t in many))
        n = _laid(whole, tuple(t.rstrip(".") for t in many), 3)
        return 1 - n / size if n <= 3 and size >= 8 else 0.0
    out = 0.0
    for order in itertools.permutations(many):
        text = "".join(t.rstrip(".") for t in order)
        size = max(len(text), len(whole))
        n = _edits(text, whole, 3)
        if n <= 3 and size >= 8:
            out = max(out, 1 - n / size)
        if order[-1].endswith(".") and len(text) >= 8 and _edits(text, whole[: len(text)], 1) <= 1:
            out = max(out, 0.95 - 0.05 * (whole[: len(text)] != text))
        if one.endswith(".") and len(whole) >= 8 and _edits(whole, text[: len(whole)], 1) <= 1:
            out = max(out, 0.95 - 0.05 * (whole != text[: len(whole)]))
    return out


def _laid(whole: str, parts: tuple[str, ...], most: int) -> int:
    """Fewest edits that lay all parts side by side over ``whole``, most + 1 if more."""
    if not parts:
        return min(len(whole), most + 1)
    best = most + 1
    for k, t in enumerate(parts):
        rest = parts[:k] + parts[k + 1 :]
        for size in range(max(0, len(t) - most), min(len(whole), len(t) + most) + 1):
            n = distance(t, whole[:size], best - 1) if best else 1
            if n < best:
                best = min(best, n + _laid(whole[size:], rest, best - 1 - n))
    return best


def firsts_agree(a: str, b: str) -> bool:
    """Whether two given names can be the same person's: equal, or one the other's initial."""
    if not a or not b:
        return a == b
    return a == b or (len(a) == 1 or len(b) == 1) and a[0] == b[0]


def same_name(a: Name, b: Name, least: float = 0.79) -> bool:
    return firsts_agree(a.first, b.first) and monge_elkan(a.core, b.core) >= least


def node_of(text: str | None) -> str | None:
    """The parts of a name as one key 'first|core core'."""
    p = part_name(text)
    return None if p is None else f"{p.first}|{' '.join(p.core)}"


def parted(df: DataFrame, name: str = "employer_name") -> DataFrame:
    """(name, node): every distinct spelling with its parts as one key 'first|core core'."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({name: pdf[name], "node": pd.Series([node_of(text) for text in pdf[name]], dtype=object)})

    return df.where(F.col(name).isNotNull()).select(name).distinct().mapInPandas(run, f"{name} string, node string").where("node is not null")


def _as_name(node: str) -> Name:
    first, _, core = node.partition("|")
    return Name(tuple(core.split(" ")), first)


def lowest_jaccard(letters: int, q: int = 2) -> float:
    """Jaccard similarity of a name of so many letters and of its worst variant of one edit,
    two swapped letters in the middle (q + 1 grams lost on either side). Names of fewer than
    five letters have no variant that verifies and count as five."""
    own = max(letters, 5) + q - 1
    return (own - q - 1) / (own + q + 1)


@lru_cache(1000)
def bands_of(letters: int, rows: int, recall: float, least: int) -> int:
    """Bands of a name: from the collision curve at one edit, but at least ``least``, as longer
    names may have several. The shorter of two names has the more bands, so that a pair shares
    those of the longer."""
    return max(least, bands_for(lowest_jaccard(letters), rows, recall))


_FOLD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _folded(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A key with one more number in it."""
    with np.errstate(over="ignore"):
        key = (key ^ more) * _FOLD[0]
        return (key ^ (key >> np.uint64(31))) * _FOLD[1]


def banded(own: list[Name], rows: int, recall: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all cores and whose they are. The initial of the given name (none for firms)
    is part of the key, as names that differ in it are never one."""
    by: dict[int, list[int]] = {}
    for i, name in enumerate(own):
        by.setdefault(bands_of(sum(len(t.rstrip(".")) for t in name.core), rows, recall, least), []).append(i)
    keys, whose = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
    for n, members in by.items():
        for k in range(0, len(members), 1000):
            some = members[k : k + 1000]
            sig = np.stack([signature(grams(own[i].core), rows * n) for i in some]).reshape(len(some), n, rows)
            start = np.array([xxhash.xxh64_intdigest(own[i].first[:1]) for i in some], dtype=np.uint64)
            key = _folded(start[:, None], np.arange(n, dtype=np.uint64)[None, :])
            for r in range(rows):
                key = _folded(key, sig[:, :, r])
            keys.append(key.ravel())
            whose.append(np.repeat(np.array(some, dtype=np.int32), n))
    return np.concatenate(keys), np.concatenate(whose)


class Side:
    """Names of a block with what tells by numbers which of them can be one: letters, in buckets,
    of every token, and given names. Buckets only make names look more alike."""

    def __init__(self, nodes: list[str], rows: int, recall: float, least: int):
        self.own = [_as_name(n) for n in nodes]
        keys, whose = banded(self.own, rows, recall, least)
        order = np.argsort(keys)
        self.keys, self.whose = keys[order], whose[order]
        self.first = np.array([xxhash.xxh64_intdigest(x.first) for x in self.own], dtype=np.uint64)
        self.initial = np.array([len(x.first) == 1 for x in self.own], dtype=bool)
        #: more tokens than are compared here: always can
        self.open = np.array([len(x.core) > MOST for x in self.own], dtype=bool)
        self.count = np.array([len(x.core) for x in self.own], dtype=np.int64)
        self.short = np.zeros((len(self.own), MOST), dtype=bool)  # cut-off tokens
        self.length = np.zeros((len(self.own), MOST), dtype=np.int64)
        at = []
        for i, x in enumerate(self.own):
            for k, t in enumerate(x.core[:MOST]):
                self.short[i, k], t = t.endswith("."), t.rstrip(".")
                self.length[i, k] = len(t)
                at += [(i * MOST + k) * BUCKETS + _bucket(c) for c in t]
        size = len(self.own) * MOST * BUCKETS
        self.letters = np.bincount(np.array(at, dtype=np.int64), minlength=size).astype(np.int16).reshape(-1, MOST, BUCKETS)
        self.whole = self.letters.sum(axis=1, dtype=np.int16)
        self.seen = ((self.whole > 0) << np.arange(BUCKETS, dtype=np.int64)).sum(axis=1).astype(np.uint64)


#: tokens of a name and buckets of letters that are compared by numbers
MOST, BUCKETS = 3, 32


def _bucket(c: str) -> int:
    k = ord(c) - 97
    return k if 0 <= k < 26 else 26 + ord(c) % 6


def met(a: Side, b: Side, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the names of a and b that share a band, once each, in pieces: as many names of
    a at a time as meet ``most`` by all bands together, at least one. No bucket is cut."""
    lo, hi = np.searchsorted(b.keys, a.keys, "left"), np.searchsorted(b.keys, a.keys, "right")
    hit = np.flatnonzero(hi > lo)
    hit = hit[np.argsort(a.whose[hit], kind="stable")]
    whose, lo, n = a.whose[hit], lo[hit], (hi - lo)[hit]
    upto, k = np.cumsum(n), 0
    while k < len(hit):
        done = upto[k - 1] if k else 0
        end = max(int(np.searchsorted(upto, done + most, "right")), k + 1)
        end = int(np.searchsorted(whose, whose[end - 1], "right"))  # all bands of the last name
        each = n[k:end]
        at = np.repeat(lo[k:end] - (upto[k:end] - each - done), each) + np.arange(int(upto[end - 1] - done))
        code = np.unique(np.repeat(whose[k:end].astype(np.int64), each) * len(b.own) + b.whose[at])
        yield code // len(b.own), code % len(b.own)
        k = end


def _lone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many letters only the one and only the other text has. The more of them are the fewest
    edits: an edit changes at most one letter on either side, a swap none."""
    d = x - y
    left = np.maximum(d, 0).sum(axis=1)
    return left, left - d.sum(axis=1)


def can_be_one(a: Side, ia: np.ndarray, b: Side, ib: np.ndarray, least: float = 0.79, token: float = 0.6, joined: int = 3) -> np.ndarray:
    """Which pairs ``same_name`` can confirm, by given names and by the letters: no similarity is
    higher than the letters of the tokens allow. Loses no pair that is confirmed."""
    able = (a.first[ia] == b.first[ib]) | a.initial[ia] | b.initial[ib]  # a band has one initial
    free = a.open[ia] | b.open[ib]
    cut_ = a.short[ia].any(axis=1) | b.short[ib].any(axis=1)  # lack letters
    # each letter that only one of them has costs an edit
    na, nb = a.count[ia], b.count[ib]
    edits = np.maximum(np.maximum(na, nb) * np.maximum(a.length[ia].max(axis=1), b.length[ib].max(axis=1)) * (1 - least) + 1e-9, joined)
    x, y = a.seen[ia], b.seen[ib]
    able &= free | cut_ | (np.bitwise_count(x & ~y) <= edits) & (np.bitwise_count(y & ~x) <= edits)
    ask = np.flatnonzero(able & ~free)
    for p in range(1, MOST + 1):
        for q in range(1, MOST + 1):
            own = ask[(na[ask] == p) & (nb[ask] == q)]
            for k in range(0, len(own), 50_000):
                some = own[k : k + 50_000]
                sa, sb = ia[some], ib[some]
                sims = np.zeros((len(some), p, q))
                for i in range(p):
                    for j in range(q):
                        size, (one, two) = np.maximum(a.length[sa, i], b.length[sb, j]), _lone(a.letters[sa, i], b.letters[sb, j])
                        n = np.maximum(one, two)
                        sim = np.where(n <= (0.4 * size).astype(np.int64), 1 - n / np.maximum(size, 1), 0)
                        # of a cut-off token no letter may be missing in the other, or one
                        gone = np.minimum(np.where(a.short[sa, i], one, 9), np.where(b.short[sb, j], two, 9))
                        sims[:, i, j] = np.maximum(sim, np.where(gone == 0, 1.0, np.where(gone == 1, 0.85, 0)))
                rows, cols = sims.max(axis=2), sims.max(axis=1)
                high = (np.minimum(rows.mean(axis=1), cols.mean(axis=1)) >= least - 1e-9) & (np.minimum(rows.min(axis=1), cols.min(axis=1)) >= token - 1e-9)
                if p != q and min(p, q) == 1:
                    one, two = _lone(a.whole[sa], b.whole[sb])
                    high |= (np.maximum(one, two) <= joined) | cut_[some] & (np.minimum(one, two) <= 1)
                able[some] = high
    return able


def blocks(nodes: DataFrame, size: int = 24_000) -> DataFrame:
    """(block, side, node, n): the nodes dealt into groups of about ``size``, every two groups (and
    each with itself) as one block. So candidates, which grow with the square of the nodes by
    chance, are made, told apart and verified within a task; none is ever written. What moves is
    each node once per group. ``side`` is 0 and 1 in a block of two groups, 2 in one of a single."""
    spark = nodes.sparkSession
    total, cores = nodes.count(), spark.sparkContext.defaultParallelism
    groups = max(1, math.ceil(total / size))
    while groups * (groups + 1) // 2 < cores and total > 500 * groups:
        groups += 1
    g = F.pmod(F.xxhash64("node"), F.lit(groups)).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda k: F.struct((F.least(g, k) * groups + F.greatest(g, k)).alias("block"), F.when(g == k, 2).otherwise((g > k).cast("int")).alias("side")))
    dealt = nodes.select(F.explode(meets).alias("m"), "node", "n").select("m.block", "m.side", "node", "n")
    return dealt.repartition(max(parts(spark), min(2000, groups * (groups + 1) // 2)), "block")


def _merged(df: DataFrame) -> DataFrame:
    """A side that grows with the data: joined by sorted shuffles, so that no hash table of
    it is ever built on the driver."""
    return df.hint("merge")


def node_id(node: str) -> int:
    """What xxhash64 gives for a node in Spark."""
    x = xxhash.xxh64_intdigest(node, seed=42)
    return x - (1 << 64) if x >> 63 else x


def _within(nodes: DataFrame, confirmed: bool, rows: int, recall: float, bands: int, least: float) -> DataFrame:
    """(a, na, wa, b, nb, wb), a < b: ids, nodes and weights of the pairs of all blocks that can
    be one or, if ``confirmed``, are; then without nodes, which are null."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf[pdf.side != 1].sort_values("node")
        two = one if (pdf.side == 2).all() else pdf[pdf.side == 1]
        na, nb = one.node.tolist(), two.node.tolist()
        out: dict[str, list] = {c: [] for c in ("a", "na", "wa", "b", "nb", "wb")}
        if na and nb:
            a = Side(na, rows, recall, bands)
            b = a if two is one else Side(nb, rows, recall, bands)
            wa, wb = one.n.tolist(), two.n.tolist()
            for ia, ib in met(a, b):
                if a is b:
                    ia, ib = ia[ia < ib], ib[ia < ib]
                able = can_be_one(a, ia, b, ib, least)
                for i, j in zip(ia[able].tolist(), ib[able].tolist()):
                    if not confirmed or same_name(a.own[i], b.own[j], least):
                        for end, (node, w) in zip("ab", sorted([(na[i], wa[i]), (nb[j], wb[j])])):
                            out[end].append(node_id(node))
                            out["n" + end].append(None if confirmed else node)
                            out["w" + end].append(w)
        return pd.DataFrame({c: pd.Series(v, dtype=object if c[0] == "n" else "int64") for c, v in out.items()})

    return blocks(nodes).groupBy("block").applyInPandas(run, "a bigint, na string, wa bigint, b bigint, nb string, wb bigint")


def candidate_pairs(nodes: DataFrame, rows: int = 4, recall: float = 0.97, least: int = 80) -> DataFrame:
    """(a, b), a < b: nodes that share a band and whose given names and letters can agree. Nodes
    are distinct, so that a surname has no more nodes than there are given names and initials."""
    return _within(nodes, False, rows, recall, least, 0.79).select(F.col("na").alias("a"), F.col("nb").alias("b"))


def links(nodes: DataFrame, least: float = 0.79, rows: int = 4, recall: float = 0.97, bands: int = 80) -> DataFrame:
    """(a, wa, b, wb): the pairs of nodes that Monge-Elkan similarity and given names confirm, once
    each, as ids (xxhash64 of the node) with their weights."""
    return _within(nodes, True, rows, recall, bands, least).select("a", "wa", "b", "wb")


def centers(edges: DataFrame) -> DataFrame | None:
    """(id, center) of the nodes with links, by star clustering; None without any link. In each
    round the free nodes that weigh more than all their free neighbours become centers and take
    their free neighbours, each the heaviest center it sees; weight is the number of spellings
    and links, ties by id. Rounds go on until no link is left: each takes at least the heaviest
    free node. Nodes that no center took are missing: they are centers of their own.

    Links are kept in both directions, so that a round is two windows, one per end, and an
    anti join; one checkpoint per round."""
    both = edges.select("a", "wa", "b", "wb").union(edges.select("b", "wb", "a", "wa"))
    from_a, from_b = Window.partitionBy("a"), Window.partitionBy("b")
    for x, ends in (("b", from_b), ("a", from_a)):
        both = both.withColumn(f"w{x}", F.struct(F.col(f"w{x}").alias("w"), F.count(F.lit(1)).over(ends).alias("l")))
    flat = lambda df, *more: df.select("a", F.col("wa.w").alias("wa"), F.col("wa.l").alias("la"), "b", F.col("wb.w").alias("wb"), F.col("wb.l").alias("lb"), *more)
    left, done = flat(both), None
    rank = lambda x: F.struct(f"w{x}", f"l{x}", x)
    while True:
        marked = left.withColumn("ca", rank("a") > F.max(rank("b")).over(from_a))
        taken = F.max(F.when(F.col("ca"), rank("a"))).over(from_b)["a"]
        center = F.when(rank("b") > F.max(rank("a")).over(from_b), F.col("b")).otherwise(taken)
        now = cut(marked.select("a", "wa", "la", "b", "wb", "lb", center.alias("center")))
        if now.isEmpty():
            return done
        gone = now.where("center is not null").select(F.col("b").alias("id"), "center").distinct()
        done = gone if done is None else done.union(gone)
        left = now.where("center is null").drop("center").join(_merged(gone.select(F.col("id").alias("a"))), "a", "left_anti")


def stars(nodes: DataFrame, edges: DataFrame, weight: str = "n") -> DataFrame:
    """(node, center): the ``centers`` of nodes and their links (a, b), by name."""
    own = nodes.select(F.xxhash64("node").alias("id"), "node", F.col(weight).cast("bigint").alias("w"))
    at = lambda x: _merged(own.select(F.col("node").alias(x), F.col("id").alias(f"i{x}"), F.col("w").alias(f"w{x}")))
    full = edges.join(at("a"), "a").join(at("b"), "b").select(F.col("ia").alias("a"), "wa", F.col("ib").alias("b"), "wb")
    return _named(own.drop("w"), centers(full)).drop("id", "c")


def _named(own: DataFrame, done: DataFrame | None) -> DataFrame:
    """Rows with ``node`` and its ``id``, with the center's id ``c`` and node ``center``."""
    if done is None:
        return own.withColumn("c", F.col("id")).withColumn("center", F.col("node"))
    nodes = own.select(F.col("id").alias("c"), F.col("node").alias("center")).distinct()
    return centered(own, done).join(_merged(nodes), "c")


def centered(own: DataFrame, done: DataFrame | None) -> DataFrame:
    """Rows with the ``id`` of a node (null where there is none), with that of its center, ``c``."""
    if done is None:
        return own.withColumn("c", F.col("id"))
    return own.join(_merged(done), "id", "left").withColumn("c", F.coalesce("center", "id")).drop("center")


def _spelled(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """Every distinct spelling (name, node, id), and the centers. Null, empty and wordless names have
    none. Equal nodes collapse before anything is compared, so a spelling that a third of all
    rows share is one node."""
    spelled = cut(parted(df, name))
    nodes = spelled.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    return spelled.withColumn("id", F.xxhash64("node")), centers(cut(links(nodes)))


def name_clusters(df: DataFrame, name: str = "employer_name") -> DataFrame:
    """(name, node, center): the cluster of every distinct spelling."""
    return _named(*_spelled(df, name)).select(name, "node", "center")


def linked_profiles(profiles: DataFrame, crowd: int = 500) -> DataFrame:
    """(employer_a, employer_b): pairs of profiles of one cluster. A cluster of more than
    ``crowd`` profiles is split by salt, so that its pairs are made in many tasks."""
    own = profiles.where("employer_id is not null").select("employer_id", "employer_name").distinct()
    member = cut(own.join(_merged(centered(*_spelled(profiles, "employer_name")).select("employer_name", "c")), "employer_name").select("employer_id", "c").distinct())
    size = member.groupBy("c").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    salted = member.join(_merged(size), "c").withColumn("parts", F.ceil(F.col("size") / crowd).cast("int"))
    a = salted.select("c", F.pmod(F.xxhash64("employer_id"), F.col("parts").cast("bigint")).alias("salt"), F.col("employer_id").alias("employer_a"))
    b = salted.select("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)).alias("salt"), F.col("employer_id").alias("employer_b"))
    return a.join(_merged(b), ["c", "salt"]).where("employer_a < employer_b").select("employer_a", "employer_b").distinct()
