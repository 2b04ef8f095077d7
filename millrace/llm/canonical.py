"""Freely typed values to the entries of a reference list (problem 4).

Each distinct token of a value is repaired: it joins the vocabulary of the reference
list by edit distance, found through deletions of both sides. Repaired tokens are then
combined by soft TF-IDF to rank the complete entries, beside the whole value without
its gaps. The best entry is taken if it explains enough, else the value is reported
as having none.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, parts
from .contamination import INVISIBLE

# fixed values: common synonyms that reference lists seldom hold, by field and entry
SYNONYMS = {
    "req_technology": {
        "JavaScript": "js; java script", "TypeScript": "type script", "Go": "golang", "C#": "csharp; c sharp", "C++": "cpp; cplusplus", "React": "react js", "Angular": "angular js; angularjs",
        "Vue.js": "vue", "Svelte": "sveltejs", "Next.js": "next", "Node.js": "node", "NestJS": "nest js; nest", ".NET": "dotnet; dot net; net core; asp net", "Spring Boot": "spring",
        "Ruby on Rails": "rails; ror", "PostgreSQL": "postgres; psql; pg", "MySQL": "my sql", "Oracle Database": "oracle; oracle db", "SQL Server": "ms sql; mssql; microsoft sql server; ms sql server",
        "MongoDB": "mongo; mongo db", "Elasticsearch": "elastic; es; elastic search", "Kafka": "apache kafka", "RabbitMQ": "rabbit mq; rabbit", "Spark": "apache spark; pyspark", "Airflow": "apache airflow",
        "Hadoop": "apache hadoop", "Cassandra": "apache cassandra", "Kubernetes": "k8s; kube", "Terraform": "tf", "GitLab CI": "gitlab", "AWS": "amazon web services; amazon aws", "Azure": "ms azure; microsoft azure",
        "Google Cloud": "gcp; google cloud platform", "PowerShell": "power shell", "Power BI": "powerbi; pbi; ms power bi", "TensorFlow": "tensor flow; tf2", "PyTorch": "torch", "Salesforce": "sfdc; sales force",
        "ServiceNow": "snow; service now", "Unreal Engine": "ue; ue4; ue5; unreal", "Unity": "unity3d", "Linux": "gnu linux", "Bash": "shell bash", "Python": "py; python3", "Selenium": "selenium webdriver", "Redis": "redis db",
    },
    "cities": {
        "Warszawa": "warsaw; warschau; wawa; varsovie; varsava", "Kraków": "cracow; krakau; krakow; cracovie", "Wrocław": "breslau; wroclove", "Gdańsk": "danzig", "Poznań": "posen", "Łódź": "lodsch", "Katowice": "kattowitz", "Szczecin": "stettin",
        "Toruń": "thorn", "Bydgoszcz": "bromberg", "Gliwice": "gleiwitz", "Gdynia": "gdingen", "Opole": "oppeln", "Olsztyn": "allenstein", "Bielsko-Biała": "bielsko; bielitz", "Zielona Góra": "grunberg",
        "München": "munich; monachium; muenchen; mnichov", "Köln": "cologne; kolonia; koeln", "Frankfurt am Main": "frankfurt; frankfurt nad menem; ffm", "Leipzig": "lipsk; lipsko", "Dresden": "drezno; drazdany", "Düsseldorf": "duesseldorf",
        "Nürnberg": "nuremberg; norymberga; nuernberg", "Wien": "vienna; wieden; viden; vienne", "Praha": "prague; praga; prag", "Brno": "brunn; bruenn", "Ostrava": "ostrau", "Bratislava": "bratyslawa; pressburg", "Košice": "koszyce; kaschau; kosice",
        "Budapest": "budapeszt", "Debrecen": "debreczyn", "Paris": "paryz; pariz", "Toulouse": "tuluza", "Strasbourg": "strasburg; strassburg", "Kyiv": "kijow; kiev; kiew", "Lviv": "lwow; lemberg; lvov", "Kharkiv": "charkow; kharkov; charkiw",
        "Odesa": "odessa", "Dnipro": "dniepr; dnepr", "Vilnius": "wilno; vilna", "Kaunas": "kowno", "Riga": "ryga", "Tallinn": "tallin; reval", "London": "londyn; londres; londyn", "Edinburgh": "edynburg", "København": "copenhagen; kopenhaga; kopenhagen; kobenhavn",
        "Berlin": "berlino", "Hamburg": "hamburk", "Olomouc": "olomuniec; olmutz", "Salzburg": "salcburg", "Bordeaux": "bordo", "Amsterdam": "amsterodam",
    },
    "role_seniority": {
        "intern": "trainee; praktykant; praktykantka; stazysta; stazystka; internship; staz; student; praktikant", "junior": "jr; mlodszy; mlodsza; entry level; entry", "regular": "mid; medium; middle; mid level; samodzielny; samodzielna; intermediate",
        "senior": "sr; starszy; starsza", "expert": "ekspert", "lead": "team leader; lider; leader; leading; team lead; tech lead; glowny; kierownik zespolu", "head": "head of; szef", "director": "dyrektor", "vice-president": "vp; vice president; wiceprezes",
        "c-level": "c level; cxo; cto; ceo; cio; executive", "principal": "glowny specjalista", "staff": "staff engineer",
    },
}
_FOLD = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i"})
_TOKEN = re.compile(r"[^\W_]+(?:\+\+|#)?")


def fold(text: str) -> str:
    text = html.unescape(text).translate(INVISIBLE).lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).translate(_FOLD)


def tokens(text: str) -> list[str]:
    """Tokens without case and accents; '+' and '#' stay with the word before them."""
    return _TOKEN.findall(fold(text))


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours also across further edits)
    between a and b, most + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = len(a) + len(b)
    grid = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        grid[i + 1][1] = i
    for j in range(len(b) + 1):
        grid[1][j + 1] = j
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        match = 0
        for j, y in enumerate(b, 1):
            k, m = seen.get(y, 0), match
            if x == y:
                match = j
            grid[i + 1][j + 1] = min(grid[i][j] + (x != y), grid[i + 1][j] + 1, grid[i][j + 1] + 1, grid[k][m] + (i - k - 1) + 1 + (j - m - 1))
        seen[x] = i
        if min(grid[i + 1][1:]) > most + 1:
            return most + 1
    return min(grid[-1][-1], most + 1)


def allowed(size: int) -> int:
    """Edits that a word of this length may have."""
    return 0 if size < 4 else 1 if size < 6 else 2 if size < 11 else 3


def _deletions(word: str, most: int) -> set[str]:
    out, rim = {word}, {word}
    for _ in range(most):
        rim = {w[:k] + w[k + 1 :] for w in rim for k in range(len(w))}
        out |= rim
    return out


class Vocabulary:
    """Words that can be found by edit distance through the deletions of both sides."""

    def __init__(self, words: set[str], reach: int = 2):
        self.words, self.reach = words, reach
        self.index: dict[str, set[str]] = defaultdict(set)
        for w in words:
            for d in _deletions(w, min(reach, allowed(len(w)))):
                self.index[d].add(w)
        self.longest = max(map(len, words), default=0) + reach
        self._known: dict[str, list[tuple[str, float]]] = {}

    def near(self, token: str) -> list[tuple[str, float]]:
        """(word, similarity) of the words within the edits their length allows."""
        if token in self._known:
            return self._known[token]
        if len(token) > self.longest:  # more edits than allowed from every word
            return []
        if token in self.words:
            out = {token: 1.0}
        else:
            out = {}
            for d in _deletions(token, min(self.reach, allowed(len(token) + 1))):
                for w in self.index.get(d, ()):
                    most = min(self.reach, allowed(max(len(w), len(token)) if min(len(w), len(token)) >= 4 else 0))
                    n = distance(token, w, most)
                    if n <= most:
                        out[w] = 1 - n / max(len(w), len(token))
        if len(self._known) > 200_000:
            self._known.clear()
        self._known[token] = sorted(out.items(), key=lambda x: (-x[1], x[0]))
        return self._known[token]


class Reference:
    """The entries of one field with all their names."""

    def __init__(self, field: str, entries: list[tuple[int, str, list[str]]]):
        self.exact: dict[str, int] = {}
        self.joined: dict[str, int] = {}
        names: dict[tuple[str, ...], int] = {}
        for first in (True, False):
            for canon_id, name, others in sorted(entries, key=lambda e: e[0]):
                more = SYNONYMS.get(field, {}).get(name, "").split(";")
                for text in [name] if first else [*(o for o in others or [] if o), *more]:
                    own = tuple(tokens(text))
                    if own:
                        names.setdefault(own, canon_id)
                        self.joined.setdefault("".join(own), canon_id)
        self.names = list(names.items())
        seen = defaultdict(int)
        for own, _ in self.names:
            for t in set(own):
                seen[t] += 1
        n = len(self.names) or 1
        self.weight = {t: math.log(1 + n / k) for t, k in seen.items()}
        self.stranger = 0.35 * math.log(1 + n)
        self.vocabulary = Vocabulary(set(seen))
        self.whole = Vocabulary(set(self.joined), reach=3)
        self.by_token: dict[str, list[int]] = defaultdict(list)
        for k, (own, _) in enumerate(self.names):
            for t in set(own):
                self.by_token[t].append(k)
        self.known: dict[str, int] = {}

    def score(self, own: list[str], name: tuple[str, ...], near: dict[str, dict[str, float]]) -> tuple[float, float]:
        """Soft TF-IDF cosine of a value and a name, and how much of the name is explained."""
        dot = got = total = 0.0
        used = set()
        for t in name:
            w = self.weight[t]
            total += w
            best = max(((near[x].get(t, 0.0), x) for x in near if x not in used), default=(0.0, ""))
            if best[0]:
                used.add(best[1])
                dot += w * w * best[0]
                got += w * best[0]
        size = sum((self.weight.get(next(iter(near[x])), 0) if near[x] else self.stranger) ** 2 if x not in used else 0 for x in set(own))
        size += sum(max((self.weight[t] for t in near[x] if t in name), default=0) ** 2 for x in used)
        mine = math.sqrt(sum(self.weight[t] ** 2 for t in name))
        return dot / (mine * math.sqrt(size) or 1.0), got / (total or 1.0)

    def wanted(self, own: list[str]) -> list[tuple[str, str]]:
        """What has to be looked up for a value of these tokens: (kind, word), kind being a token
        of names or a whole name without gaps."""
        out = [("token", t) for t in own] + [("whole", "".join(own))]
        out += [("whole", a + b) for a, b in zip(own, own[1:]) if len(a + b) > 4]  # words split or run together
        if len(own) > 1:
            out += [("whole", t) for t in own if len(t) > 6]  # names of several words run together within a longer value
        return out

    def lookup(self, kind: str, word: str) -> list[tuple[str, float]]:
        return (self.vocabulary if kind == "token" else self.whole).near(word)

    def rank(self, own: list[str], repaired: dict[tuple[str, str], list[tuple[str, float]]], least: float = 0.45, explained: float = 0.74) -> int:
        """The entry meant by a value of these tokens, given what each of them may be: the best
        by soft TF-IDF over repaired tokens or by the value without gaps, of equals the one
        with more of it explained and the smaller number. -1 if none is good enough."""
        found: list[tuple[float, float, int]] = []
        if own:
            found += [(s + 0.15, 1.0, self.joined[w]) for w, s in repaired["whole", "".join(own)]]
            near = {t: dict(repaired["token", t]) for t in own}
            for a, b in zip(own, own[1:]):
                found += [(0.8 * s, s, self.joined[w]) for w, s in repaired.get(("whole", a + b), ()) if len(a + b) > 4]
            if len(own) > 1:
                found += [(0.75 * s, s, self.joined[w]) for t in own if len(t) > 6 for w, s in repaired["whole", t]]
            for k in {k for t in near for w in near[t] for k in self.by_token[w]}:
                cosine, part = self.score(own, self.names[k][0], near)
                found.append((cosine, part, self.names[k][1]))
        found = [f for f in found if f[0] >= least and f[1] >= explained]
        return max(found, key=lambda f: (round(f[0], 9), f[1], -f[2]))[2] if found else -1

    def best(self, value: str) -> int:
        """The entry meant by a single value, -1 if none."""
        if value not in self.known:
            own = tokens(value)
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[value] = self.rank(own, {x: self.lookup(*x) for x in self.wanted(own)})
        return self.known[value]


def references(canon: DataFrame, most: int = 200_000) -> dict[str, Reference]:
    """The reference lists, by field. The list is a fixed table of checked size: more than
    ``most`` entries are refused rather than sent to every task."""
    rows = canon.select("canon_id", "field_name", "canon_name", "other_names").where("canon_name is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the reference list has more than {most} entries")
    by: dict[str, list] = defaultdict(list)
    for r in rows:
        by[r.field_name].append((r.canon_id, r.canon_name, r.other_names))
    return {f: Reference(f, e) for f, e in by.items()}


def repaired_tokens(values: DataFrame, refs: dict[str, Reference]) -> DataFrame:
    """(field_name, kind, word, near): every distinct token of distinct values (field_name,
    value), joined to the reference vocabulary by edit distance; ``near`` holds (word,
    similarity) of all entries in reach. The vocabulary's deletion index stands in for the
    join's other side, as it is of checked size."""

    def split(batches):
        for pdf in batches:
            out = [(f, kind, w) for f, v in zip(pdf.field_name, pdf.value) if f in refs for kind, w in refs[f].wanted(tokens(v)) if w]
            yield pd.DataFrame(out, columns=["field_name", "kind", "word"]).drop_duplicates()

    def join(batches):
        for pdf in batches:
            pdf["near"] = [[{"w": w, "s": s} for w, s in refs[f].lookup(kind, x)] for f, kind, x in zip(pdf.field_name, pdf.kind, pdf.word)]
            yield pdf

    words = values.mapInPandas(split, "field_name string, kind string, word string").repartition(parts(values.sparkSession), "field_name", "kind", "word").distinct()
    return words.mapInPandas(join, "field_name string, kind string, word string, near array<struct<w:string,s:double>>")


def meant(values: DataFrame, refs: dict[str, Reference]) -> DataFrame:
    """(field_name, value, canon_id) of distinct values (field_name, value).

    Tokens that some entry is near to are few, as entries are; they come back to the values'
    tasks as far as each value needs them, by a join on the value's hash."""
    found = repaired_tokens(values, refs).where(F.size("near") > 0)

    def ask(batches):
        for pdf in batches:
            out = [(f, v, kind, w) for f, v in zip(pdf.field_name, pdf.value) if f in refs for kind, w in dict.fromkeys(refs[f].wanted(tokens(v))) if w]
            yield pd.DataFrame(out, columns=["field_name", "value", "kind", "word"])

    needs = values.mapInPandas(ask, "field_name string, value string, kind string, word string")
    given = needs.join(found, ["field_name", "kind", "word"]).groupBy("field_name", "value").agg(F.collect_list(F.struct("kind", "word", "near")).alias("got"))

    def rank(batches):
        for pdf in batches:
            ids = []
            for f, v, got in zip(pdf.field_name, pdf.value, pdf.got):
                known = {(g["kind"], g["word"]): [(n["w"], n["s"]) for n in g["near"]] for g in (got if got is not None else ())}
                own = tokens(v)
                ids.append(refs[f].rank(own, {x: known.get(x, []) for x in refs[f].wanted(own)}) if f in refs else -1)
            yield pdf[["field_name", "value"]].assign(canon_id=pd.Series(ids, index=pdf.index, dtype="int64"))

    return values.join(given, ["field_name", "value"], "left").mapInPandas(rank, "field_name string, value string, canon_id bigint")


def map_values(offers: DataFrame, canon: DataFrame, lists: tuple[str, ...] = ("req_technology", "cities"), singles: tuple[str, ...] = ("role_seniority",)) -> DataFrame:
    """(offer_id, field_name, pos, value, canon_id): every value that isn't exactly a
    canonical name, with the entry meant or -1.

    Rows with the same offer_id count once (the last ingested). Null lists, null elements
    and null values give no row, empty and wordless values -1. Each distinct value is worked
    out once, from distinct tokens; a value that a third of all rows hold is one value there,
    and comes back to its rows by a join that the engine may split."""
    refs = references(canon)
    kept = ["offer_id", *lists, *singles]
    rank = F.struct("ingested_at", F.struct(*kept[1:]))
    once = offers.where("offer_id is not null").groupBy("offer_id").agg(F.max(rank).alias("r")).select("offer_id", *[F.col(f"r.col2.{c}").alias(c) for c in kept[1:]])

    def elements(f: str):
        return F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), lambda v, i: F.struct(F.lit(f).alias("field_name"), i.cast("int").alias("pos"), v.alias("value")))

    own = [elements(f) for f in lists]
    own += [F.array(F.struct(F.lit(f).alias("field_name"), F.lit(0).alias("pos"), F.col(f).alias("value"))) for f in singles]
    rows = once.select("offer_id", F.explode(F.concat(*own)).alias("v")).select("offer_id", "v.*").where(F.col("value").isNotNull() & F.col("field_name").isin(list(refs)))
    exact = canon.where("canon_name is not null").select("field_name", F.col("canon_name").alias("value")).distinct()
    rows = rows.join(exact, ["field_name", "value"], "left_anti")
    values = cut(rows.select("field_name", "value").distinct())
    return rows.join(meant(values, refs), ["field_name", "value"]).select("offer_id", "field_name", "pos", "value", "canon_id")
