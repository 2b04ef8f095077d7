"""Postings of one vacancy across boards without a common key (problem 1):
probabilistic record linkage.

Titles are parted into technology, kind of role, level and business area, employers
into clusters of names, cities into entries of the reference list. Several passes of
blocking bring candidate pairs together; each pair gets an agreement level per
attribute; expectation-maximisation on the counts of agreement patterns estimates the
probabilities of each level among matches and non-matches; the posterior is the
confidence. Non-matches are all pairs of the table that aren't matches, counted without
being made; as offers of one employer are alike in other ways, they are counted apart.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .canonical import Reference, Vocabulary, distance, fold, references, tokens
from .names import centered, centers, links, node_of

# fixed values: words of levels, kinds of role and business areas, over folded text
LEVELS = {
    "intern": "intern trainee stazysta stazystka praktykant internship", "junior": "junior jr mlodszy mlodsza", "mid": "mid regular middle medium samodzielny", "senior": "senior sr starszy starsza",
    "lead": "lead leading leader lider glowny glowna principal", "expert": "expert ekspert",
}
KINDS = {
    "developer": "developer dev engineer programmer programista programistka inzynier swe", "administrator": "administrator admin sysadmin administratorka", "analyst": "analyst analityk analityczka", "architect": "architect architekt",
    "consultant": "consultant konsultant konsultantka advisor doradca", "tester": "tester qa testerka quality",
}
AREAS = {
    "auctions": "aukcje", "broadcast": "transmisje", "cards": "karty", "checkout": "koszyk", "claims": "szkody", "couriers": "kurierzy", "customs": "clo", "energy": "energia", "fleet": "flota", "forecasts": "prognozy", "fraud": "naduzycia",
    "harvest": "zbiory", "hospitals": "szpitale", "identity": "tozsamosc", "invoicing": "fakturowanie", "irrigation": "nawadnianie", "laboratory": "laboratorium", "leasing": "", "libraries": "biblioteki", "loyalty": "lojalnosc", "maps": "mapy",
    "mortgages": "hipoteki", "payments": "platnosci", "pensions": "emerytury", "ports": "porty", "pricing": "cenniki", "printing": "druk", "railways": "koleje", "recruitment": "rekrutacja", "reporting": "raporty", "returns": "zwroty",
    "schools": "szkoly", "search": "wyszukiwarka", "stadiums": "stadiony", "taxes": "podatki", "telemetry": "telemetria", "tickets": "bilety", "vaccines": "szczepionki", "warehouse": "magazyn", "weather": "pogoda",
}
_DICT = {"level": LEVELS, "kind": KINDS, "area": AREAS}
_WORDS = {part: {w: k for k, more in table.items() for w in (k, *more.split())} for part, table in _DICT.items()}
# fixed values: words of titles that belong to no part
_IDLE = frozenset("team systems system solution solutions test role level remote hybrid new hot pilne urgent b2b uop ref m f d k x w mfd h i na do the of and zespol zdalnie praca job offer".split())
_NEAR = {part: Vocabulary({w for w in words if len(w) > 3}) for part, words in _WORDS.items()}
_BRACKET = re.compile(r"[(\[]\s*(?:[mfkxdw]\s*/\s*)+[mfkxdw]\s*[)\]]|[(\[]\s*(?:b2b|uop|remote|zdalnie|hybrid|ref\.?[^)\]]*)\s*[)\]]", re.I)


class Titles:
    """Parts titles into technology, kind, level and area."""

    def __init__(self, tech: Reference):
        self.tech = tech
        self.spans: dict[tuple[str, ...], int] = {own: i for own, i in tech.names}
        self.longest = max((len(k) for k in self.spans), default=1)
        self.known: dict[str, dict] = {}

    def part(self, title: str | None) -> dict:
        """Parts that can't be told are None; null, empty and wordless titles have none."""
        if not isinstance(title, str):
            return {}
        if title not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[title] = self._part(title)
        return self.known[title]

    def _part(self, title: str) -> dict:
        rest: list[str | None] = [t for t in tokens(_BRACKET.sub(" ", title))]
        out: dict = {}

        def take(a: int, b: int) -> None:
            for k in range(a, b):
                rest[k] = None

        for size in range(min(self.longest, len(rest)), 0, -1):  # exact names, longest first
            for k in range(len(rest) - size + 1):
                span = tuple(rest[k : k + size])
                if "tech" not in out and None not in span and span in self.spans and not (size == 1 and span[0] in _IDLE):
                    out["tech"] = self.spans[span]
                    take(k, k + size)
        for part, words in _WORDS.items():
            for k, t in enumerate(rest):
                if part not in out and t in words:
                    if part == "kind" and t in ("engineer", "developer") and k and rest[k - 1] in ("test", "qa"):
                        continue
                    out[part] = words[t]
                    take(k, k + 1)
        if "kind" in out and out["kind"] == "developer" and "test" in rest:
            out["kind"] = "tester"
        guesses = []
        for k, t in enumerate(rest):
            if t is None or t in _IDLE:
                continue
            for part in _WORDS:
                if part not in out and len(t) > 2:
                    guesses += [(s, part, k, k + 1, _WORDS[part][w]) for w, s in _NEAR[part].near(t)]
            if "tech" not in out:
                guesses += [(s, "tech", k, k + 1, self.tech.joined[w]) for w, s in self.tech.whole.near(t) if len(t) > 2]
                for size in (2, 3):
                    span = rest[k : k + size]
                    if len(span) == size and None not in span:
                        guesses += [(s + 0.05, "tech", k, k + size, self.tech.joined[w]) for w, s in self.tech.whole.near("".join(span))]
        for s, part, a, b, value in sorted(guesses, key=lambda g: (-g[0], g[1], g[2], str(g[4]))):
            if part not in out and all(rest[k] is not None for k in range(a, b)) and s >= 0.6:
                out[part] = value
                take(a, b)
                if part == "kind" and value == "developer" and "test" in rest:
                    out[part] = "tester"
        # what one part lacks and one short word is left over, an edit away
        for part in ("tech", "kind", "level", "area"):
            if part not in out:
                words = {t[0]: i for t, i in self.spans.items() if len(t) == 1} if part == "tech" else _WORDS[part]
                near = {words[w] for t in rest if t and t not in _IDLE and not t.isdigit() for w in words if max(len(t), len(w)) > 1 and distance(t, w, 1) <= 1 and len(w) < 5}
                if len(near) == 1:
                    out[part] = near.pop()
        # an area that no list holds: the one word that is left over names it
        over = {t for t in rest if t and t not in _IDLE and len(t) > 3 and t.isalpha()} - {w for words in _WORDS.values() for w in words}
        if "area" not in out and len(over) == 1:
            out["area"] = "=" + over.pop()
        return out


#: attributes and their agreement levels: 2 agree, 1 nearly or unknown, 0 differ
ATTRIBUTES = ("employer", "tech", "kind", "level", "area", "city")


_CODES = {part: {k: i for i, k in enumerate(table)} for part, table in _DICT.items()}


def _code(text: str) -> int:
    """A number for a word that no list holds, above those of the lists."""
    return 1 << 62 | xxhash.xxh64_intdigest(text) >> 2


def vacancies(offers: DataFrame, canon: DataFrame) -> DataFrame:
    """(offer_id, source, employer, tech, kind, level, area, cities) of every offer, once, as
    numbers: these rows are kept and moved.

    ``employer`` is the center of the cluster of names, ``cities`` the sorted entries (or
    hashes of the folded texts) of the non-empty cities. Rows with the same offer_id count once."""
    refs = references(canon)
    empty = Reference("", [])
    titles, cities = Titles(refs.get("req_technology", empty)), refs.get("cities", empty)
    rank = F.struct("ingested_at", F.struct("source", "employer_name", "role_title", "cities"))
    once = offers.where("offer_id is not null").groupBy("offer_id").agg(F.max(rank).alias("r")).select("offer_id", "r.col2.*")

    def run(batches):
        nodes: dict[str, str | None] = {}
        for pdf in batches:
            if len(nodes) > 300_000:
                nodes.clear()
            for text in pdf.employer_name:
                if isinstance(text, str) and text not in nodes:
                    nodes[text] = node_of(text)
            parts = [titles.part(t) for t in pdf.role_title]
            out = pdf[["offer_id", "source", "spelling"]].copy()
            out["node"] = pd.Series([nodes[t] if isinstance(t, str) else None for t in pdf.employer_name], dtype=object, index=out.index)
            out["tech"] = pd.array([p.get("tech") for p in parts], dtype="Int64")
            for c, codes in _CODES.items():
                out[c] = pd.array([None if (x := p.get(c)) is None else codes[x] if x in codes else _code(x) for p in parts], dtype="Int64")
            found = []
            for own in pdf.cities:
                keys = set()
                for v in own if own is not None else []:
                    if isinstance(v, str) and v.strip():
                        best = cities.best(v)
                        keys.add(int(best) if best > 0 else _code(fold(v).strip()))
                found.append(sorted(keys))
            out["cities"] = pd.Series(found, index=out.index, dtype=object)
            yield out

    named = once.withColumn("spelling", F.xxhash64("employer_name"))
    rows = cut(named.mapInPandas(run, "offer_id bigint, source string, spelling bigint, node string, tech bigint, kind bigint, level bigint, area bigint, cities array<bigint>"))
    nodes = rows.where("node is not null").select("node", "spelling").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    own = rows.withColumn("id", F.when(F.col("node").isNotNull(), F.xxhash64("node"))).drop("node", "spelling")
    return centered(own, centers(cut(links(nodes)))).withColumnRenamed("c", "employer").drop("id")


#: blocking passes: attributes that must be equal (city: one of them). Each has the employer,
#: so that a block grows with one employer's offers of one kind and not with the table
PASSES = (("employer", "tech", "city"), ("employer", "kind", "level", "area"), ("employer", "tech", "level", "area"))


def compared(rows: DataFrame) -> DataFrame:
    """(offer_a, offer_b, pattern): candidate pairs of different sources with an agreement
    level per attribute, as one digit each in the order of ATTRIBUTES.

    A pass joins on a hash of its attributes, so a hot employer is spread over its
    technologies, areas and cities. Rows carry what is compared into the join, and a pair
    that several passes or cities find is made by the first of them, so that pairs, which can
    grow with the square of an employer's offers, are never moved."""
    unknown = F.lit(None).cast(rows.schema["cities"].dataType.elementType)

    def keys(no: int, cols: tuple[str, ...]):
        key = lambda city: F.struct(F.xxhash64(F.lit(no), *[city if c == "city" else F.col(c) for c in cols]).alias("block"), F.lit(no).alias("no"), city.alias("city"))
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols if c != "city"])
        return F.when(known, F.transform("cities", key) if "city" in cols else F.array(key(unknown)))

    met = F.explode(F.flatten(F.array_compact(F.array(*[keys(no, cols) for no, cols in enumerate(PASSES)])))).alias("k")
    blocks = rows.select(met, "offer_id", "source", "tech", "kind", "level", "area", "cities").select("k.*", "offer_id", "source", "tech", "kind", "level", "area", "cities")
    side = lambda s: blocks.select("block", *[F.col(c).alias(f"{c}_{s}") for c in blocks.columns if c != "block"])
    same = {c: F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(False)) for c in ATTRIBUTES[1:-1]}
    same |= {"employer": F.lit(True), "city": F.arrays_overlap("cities_a", "cities_b")}  # each pass has the employer
    found = [reduce(lambda a, b: a & b, [same[c] for c in cols]) for cols in PASSES]
    # both sides are asked, so that they have the same columns and move as one
    no, city = F.greatest("no_a", "no_b"), F.least("city_a", "city_b")
    first = city.isNull() | (city == F.array_min(F.array_intersect("cities_a", "cities_b")))
    for k in range(1, len(PASSES)):
        first &= (no < k) | ~F.coalesce(found[k - 1], F.lit(False))
    pairs = side("a").join(side("b"), "block").where("offer_id_a < offer_id_b and not source_a <=> source_b").where(first)

    def level(c: str):
        x, y = F.col(f"{c}_a"), F.col(f"{c}_b")
        return F.when(x.isNull() | y.isNull(), "1").when(x == y, "2").otherwise("0")

    city = F.when(F.arrays_overlap("cities_a", "cities_b"), "2").otherwise("0")  # offers without a city share none
    return pairs.select(F.col("offer_id_a").alias("offer_a"), F.col("offer_id_b").alias("offer_b"), F.concat(F.lit("2"), *[level(c) for c in ATTRIBUTES[1:-1]], city).alias("pattern"))


def agreement(rows: DataFrame) -> dict[str, dict[str, tuple[int, int, int]]]:
    """How many of all pairs of offers of different sources differ, are unknown and agree, by
    attribute: ``any`` among all pairs, ``same`` among those of one employer. Counted from the
    sizes of groups of equal values, so that no pair is made. A pair with several common
    cities counts once for each, at most as one."""
    entry = lambda a, v: F.when(v.isNotNull(), F.struct(F.lit(a).alias("part"), v.cast("string").alias("value")))
    one = F.lit("")
    parts_ = [entry("all", one)]
    for c in ("tech", "kind", "level", "area"):
        parts_ += [entry(c, F.col(c)), entry(f"{c}?", F.when(F.col(c).isNotNull(), one))]
    own = F.concat(F.array_compact(F.array(*parts_)), F.transform("cities", lambda x: F.struct(F.lit("city").alias("part"), x.cast("string").alias("value"))))
    # dealt out by employer, all that follows but the last sums is counted where it is
    sized = rows.repartition("employer").select("employer", "source", F.explode(own).alias("p")).groupBy("employer", "source", "p.part", "p.value").agg(F.count(F.lit(1)).cast("double").alias("n"))

    def pairs(name: str, keys: list[str]) -> DataFrame:
        by_source = sized.groupBy(*keys, "source").agg(F.sum("n").alias("n"))
        across = by_source.groupBy(*keys).agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("k"))
        k = F.when(F.col("employer").isNotNull(), F.col("k")) if "employer" in keys else F.col("k")
        return across.groupBy("part").agg(F.sum(k).alias("k")).select(F.lit(name).alias("name"), "part", "k")

    counted: dict[str, dict[str, float]] = {"any": {}, "same": {}}
    for r in pairs("any", ["part", "value"]).union(pairs("same", ["employer", "part", "value"])).collect():
        counted[r.name][r.part] = r.k or 0.0
    out, same = {}, counted["same"]
    for name, got in counted.items():
        total = got.get("all", 0.0)
        out[name] = {"employer": (total - same.get("all", 0.0), 0.0, same.get("all", 0.0))} if name == "any" else {"employer": (0.0, 0.0, total)}
        for c in ("tech", "kind", "level", "area"):
            known, agree = got.get(f"{c}?", 0.0), got.get(c, 0.0)
            out[name][c] = (known - agree, total - known, agree)
        agree = min(total, got.get("city", 0.0))
        out[name]["city"] = (total - agree, 0.0, agree)
    return out


class Model(NamedTuple):
    """Shares of matches and of siblings among all pairs and, per attribute, the probability of
    each agreement level among matches (m), other pairs (u, by whether the employer agrees) and
    siblings: vacancies that were written alike but for one attribute, which differs (``odd``
    tells how often it is which; n holds for the others)."""

    p: float
    m: list[dict[str, float]]
    u: dict[str, list[dict[str, float]]]
    siblings: float
    odd: list[float]
    n: list[dict[str, float]]


def shares(pattern: str, model: Model) -> tuple[float, float, list[float]]:
    """Posterior of a match, of any other pair, and of a sibling by the attribute that differs."""
    match, other = model.p, 1 - model.p - model.siblings
    for i, c in enumerate(pattern):
        match *= model.m[i][c]
        other *= model.u["any" if i == 0 or pattern[0] != "2" else "same"][i][c]
    near = []
    for j, c in enumerate(pattern):
        w = model.siblings * model.odd[j] if c == "0" else 0.0
        for i, x in enumerate(pattern):
            w *= 1.0 if i == j else model.n[i][x]
        near.append(w)
    total = match + other + sum(near) or 1.0
    return match / total, other / total, [w / total for w in near]


def posterior(pattern: str, model: Model) -> float:
    """The chance that a pair of this pattern is a match."""
    return shares(pattern, model)[0]


def fit(counts: dict[str, int], totals: dict[str, dict[str, tuple[int, int, int]]], rounds: int = 200, pseudo: float = 2.0, misread: float = 0.001) -> Model:
    """EM over all pairs of the table: those compared, by their pattern, and the rest, which are
    non-matches and known as ``totals`` (what ``agreement`` counts).

    A vacancy's postings agree in all attributes by definition, so that an attribute differs
    among matches only where it was misread: in at most a share ``misread`` of them, which
    bounds the M-step whatever the size of the data. ``pseudo`` pairs per level keep
    probabilities off zero."""
    size, levels = len(ATTRIBUTES), "012"
    bound = lambda d: {c: misread if c == "0" else d[c] * (1 - misread) / (d["1"] + d["2"]) for c in levels} if d["0"] > misread else d
    level_shares = lambda t: {c: (x + pseudo) / (sum(t) + 3 * pseudo) for c, x in zip(levels, t)}
    total = max(1.0, sum(totals["any"]["employer"]))
    start = min(0.25, 1 / total**0.5)
    model = Model(start, [bound({"0": 0.05, "1": 0.05, "2": 0.9})] * size, {k: [level_shares(t[a]) for a in ATTRIBUTES] for k, t in totals.items()}, start, [1 / size] * size, [{"0": 0.05, "1": 0.05, "2": 0.9}] * size)
    for _ in range(rounds):
        mass, alike = 0.0, [0.0] * size
        got, kin = ([dict.fromkeys(levels, 0.0) for _ in range(size)] for _ in range(2))
        same = [dict.fromkeys(levels, 0.0) for _ in range(size)]
        for pattern, k in counts.items():
            match, _, near = shares(pattern, model)
            mass += k * match
            alike = [x + k * w for x, w in zip(alike, near)]
            for i, c in enumerate(pattern):
                got[i][c] += k * match
                kin[i][c] += k * (sum(near) - near[i])
                same[i][c] += k * (match + sum(near)) * (pattern[0] == "2")
        both = [{c: got[i][c] + kin[i][c] + k for c, k in zip(levels, (alike[i], 0.0, 0.0))} for i in range(size)]
        taken = {"any": both, "same": same}
        p = min(0.25, max(1e-12, mass / total))
        new = Model(
            p, [bound({c: (g[c] + pseudo * (c == "2") + 1e-3) / (mass + pseudo + 3e-3) for c in levels}) for g in got],
            {k: [level_shares([max(0.0, x - taken[k][i][c]) for c, x in zip(levels, totals[k][a])]) for i, a in enumerate(ATTRIBUTES)] for k in totals},
            min(0.25, max(1e-12, sum(alike) / total)), [(x + pseudo) / (sum(alike) + size * pseudo) for x in alike], [level_shares([g[c] for c in levels]) for g in kin])
        done = abs(new.p - model.p) < 1e-12 and abs(new.siblings - model.siblings) < 1e-12
        model = new
        if done:
            break
    return model


def matches(offers: DataFrame, canon: DataFrame) -> DataFrame:
    """(offer_a, offer_b, pattern, confidence): every compared pair with its posterior.

    Only the counts of the at most 3**6 patterns and of agreeing pairs come to the driver. Pairs
    are made twice, to be counted and to be given, as keeping them costs more than their rows."""
    rows = vacancies(offers, canon)
    pairs = compared(rows)
    counts = {r.pattern: r["count"] for r in pairs.groupBy("pattern").count().collect()}
    if not counts:
        return pairs.withColumn("confidence", F.lit(None).cast("double"))
    model = fit(counts, agreement(rows))
    said = F.create_map(*[F.lit(x) for c in counts for x in (c, posterior(c, model))])
    return pairs.withColumn("confidence", F.element_at(said, F.col("pattern")))


def same_vacancy(found: DataFrame, sure: float = 0.5) -> DataFrame:
    """The pairs whose posterior is at least ``sure``."""
    return found.where(F.col("confidence") >= sure).select("offer_a", "offer_b")
