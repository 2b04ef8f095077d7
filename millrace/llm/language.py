"""Languages of documents and of their segments (problem 10): a bidirectional gated
recurrent network over bytes, trained in numpy by backpropagation through time.

The network labels every byte position of a sentence; a sentence's language pools its
positions, a segment its sentences, a document its segments. It is trained on a bounded
sample of sentences of documents as they are labelled; languages whose own sentences it
assigns elsewhere are wrong labels, not languages of the corpus, and are dropped.
"""

from __future__ import annotations

import io
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import read_bytes, shared_dir, write_bytes
from .contamination import INVISIBLE

# fixed values: notations of languages by two-letter code
NOTATIONS = {
    "en": "en eng english angielski englisch", "pl": "pl pol polish polski polnisch", "de": "de deu ger german deutsch niemiecki",
    "cs": "cs ces cze czech cz čeština cesky česky czeski", "fr": "fr fra fre french français francais francuski", "uk": "uk ukr ukrainian ua українська ukraiński",
    "ru": "ru rus russian русский rosyjski", "sk": "sk slk slo slovak slovenčina", "it": "it ita italian italiano", "es": "es spa spanish español espanol", "nl": "nl nld dut dutch nederlands",
    "pt": "pt por portuguese português", "lt": "lt lit lithuanian", "hu": "hu hun hungarian magyar", "ro": "ro ron rum romanian", "sv": "sv swe swedish svenska", "da": "da dan danish dansk",
}
_CODE = {w: code for code, words in NOTATIONS.items() for w in words.split()}
# fixed values: labels that say nothing
_NONE = frozenset("und undetermined unknown xx n/a na none null ?? ? - mul zxx mis".split())


def canonical(label: str | None) -> str | None:
    """The two-letter code of a label in any notation; None for missing or undetermined
    ones; an unknown notation stays as it is, in lower case."""
    if not isinstance(label, str) or not label.strip() or label.strip().lower() in _NONE:
        return None
    low = label.strip().lower()
    return _CODE.get(low) or _CODE.get(re.split(r"[-_ ]", low)[0]) or low


_LINE = re.compile(r"[\r\n\v\f\x85  ]+")
_LEAD = re.compile(r"^[\s>#*•–—\-_`|„“”\"'«»]*(?:\d{1,2}[.)]\s+)?")
_CUT = re.compile(r"(?<=[.!?…])[\"'”“»)\]*_]*\s+(?=[\W\d_]*[^\W\d_])")
_STOP = re.compile(r"(?:[^\W_]|[+#])[)\]\"'”»*_`]*[.!?…][^\w]*(?:<[^<>]*>|[^\w]|\d)*$")
# fixed values: short forms whose point is no stop, as at the end of titles
_SHORT = re.compile(r"(?<!\w)(?:sr|jr|inc|ltd|corp|ref|r)\.[\W\d]*$", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")


def sentences(text: str | None, least: int = 4) -> list[str]:
    """The sentences of a text in order: parts of a line that end with a stop and have at
    least ``least`` words. Headings, titles and lists of terms have no stop and make none."""
    if not text:
        return []
    out = []
    for line in _LINE.split(text):
        line = _LEAD.sub("", line)
        if len(line) < 12:
            continue
        for part in _CUT.split(line):
            if _STOP.search(part) and not _SHORT.search(part) and len(_LETTERS.findall(part)) >= least:
                out.append(part.strip())
    return out


_DIGITS = re.compile(r"\d+")
_SAME = re.compile(r"([^\w\s])\1+")
_UNSEEN = re.compile("[" + "".join(map(chr, INVISIBLE)) + "]")


def to_bytes(sentence: str) -> bytes:
    """What the network reads: lower case, runs of digits and of space as one, nothing invisible."""
    if not sentence.isascii():
        sentence = _UNSEEN.sub("", sentence)
    return " ".join(_SAME.sub(r"\1", _DIGITS.sub("0", sentence.lower())).split()).encode("utf-8", "replace")


class ByteGru:
    """Embedding, two gated recurrent layers side by side (one per direction), softmax."""

    def __init__(self, langs: list[str], hidden: int = 32, embed: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        g = lambda *s: (rng.standard_normal(s) * (1 / np.sqrt(s[0]))).astype(np.float32)
        self.langs, self.hidden = langs, hidden
        self.p = {"E": (rng.standard_normal((256, embed)) * 0.3).astype(np.float32), "V": g(2 * hidden, len(langs)), "c": np.zeros(len(langs), np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": g(embed, 3 * hidden), f"U{d}": g(hidden, 3 * hidden), f"a{d}": np.zeros(3 * hidden, np.float32)}

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.array(self.langs), **self.p)
        return out.getvalue()

    @staticmethod
    def load(stored: bytes) -> ByteGru:
        got = np.load(io.BytesIO(stored), allow_pickle=False)
        net = ByteGru([str(x) for x in got["langs"]], hidden=len(got["Uf"]), embed=got["E"].shape[1])
        net.p = {k: got[k] for k in net.p}
        return net

    def _halved(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per direction: what each byte adds to the gates, and the weights of gates and of the
        candidate state. The gates are halved, as sigmoid(x) is (tanh(x / 2) + 1) / 2."""
        H = self.hidden
        half = np.concatenate([np.full(2 * H, 0.5, np.float32), np.ones(H, np.float32)])
        table = np.stack([(self.p["E"] @ self.p[f"W{d}"] + self.p[f"a{d}"]) * half for d in "fb"])
        U = np.stack([self.p[f"U{d}"] for d in "fb"])
        return table, U[:, :, : 2 * H] * np.float32(0.5), np.ascontiguousarray(U[:, :, 2 * H :])

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions of (time, row) bytes and its gradients, by
        backpropagation through time. Both directions advance together."""
        H, V, (T, B) = self.hidden, self.p["V"], x.shape
        table, Uzr, Un = self._halved()
        gx = np.stack([table[0][x], table[1][x[::-1]]], axis=1)
        kind = table.dtype
        h0 = np.zeros((T, 2, B, H), kind)
        zs, rs, ns, rhs, outs = (np.empty((T, 2, B, H), kind) for _ in range(5))
        h = np.zeros((2, B, H), kind)
        for t in range(T):
            h0[t] = h
            zr = np.tanh(gx[t, :, :, : 2 * H] + np.matmul(h, Uzr))
            zr += 1
            zr *= 0.5
            z, r = zr[:, :, :H], zr[:, :, H:]
            rh = r * h
            n = np.tanh(gx[t, :, :, 2 * H :] + np.matmul(rh, Un))
            zs[t], rs[t], ns[t], rhs[t] = z, r, n, rh
            h = n + z * (h - n)
            outs[t] = h
        flat = np.concatenate([outs[:, 0], outs[::-1, 1]], axis=2).reshape(T * B, 2 * H)
        q = flat @ V + self.p["c"]
        q -= q.max(axis=1, keepdims=True)
        np.exp(q, out=q)
        q /= q.sum(axis=1, keepdims=True)
        at = (np.arange(T * B), np.tile(y, T))
        loss = -float(np.log(q[at] + 1e-9).mean())
        q[at] -= 1
        q /= T * B
        g = {"c": q.sum(axis=0), "V": flat.T @ q}
        back = (q @ V.T).reshape(T, B, 2 * H)
        dout = np.stack([back[:, :, :H], back[::-1, :, H:]], axis=1)
        to_n, to_z, to_r = (1 - zs) * (1 - ns * ns), (h0 - ns) * zs * (1 - zs), h0 * rs * (1 - rs)
        da = np.empty((T, 2, B, 3 * H), kind)
        Uzr_t, Un_t = 2 * Uzr.transpose(0, 2, 1), Un.transpose(0, 2, 1)
        dh = np.zeros((2, B, H), kind)
        for t in range(T - 1, -1, -1):
            dh += dout[t]
            own = da[t]
            np.multiply(dh, to_n[t], out=own[:, :, 2 * H :])
            np.multiply(dh, to_z[t], out=own[:, :, :H])
            drh = np.matmul(own[:, :, 2 * H :], Un_t)
            np.multiply(drh, to_r[t], out=own[:, :, H : 2 * H])
            dh *= zs[t]
            drh *= rs[t]
            dh += drh
            dh += np.matmul(own[:, :, : 2 * H], Uzr_t)
        codes, seen = np.unique(x, return_inverse=True)
        which = np.zeros((2, len(codes), T, B), kind)
        which[0].reshape(len(codes), T * B)[seen.reshape(-1), np.arange(T * B)] = 1
        which[1] = which[0][:, ::-1]
        g["E"] = np.zeros_like(self.p["E"])
        for k, d in enumerate("fb"):
            flat = np.ascontiguousarray(da[:, k]).reshape(T * B, 3 * H)
            by_byte = np.zeros((256, 3 * H), kind)
            by_byte[codes] = which[k].reshape(len(codes), T * B) @ flat
            g[f"U{d}"] = np.concatenate([h0[:, k].reshape(-1, H).T @ flat[:, : 2 * H], rhs[:, k].reshape(-1, H).T @ flat[:, 2 * H :]], axis=1)
            g[f"a{d}"] = by_byte.sum(axis=0)
            g[f"W{d}"] = self.p["E"].T @ by_byte
            g["E"] += by_byte @ self.p[f"W{d}"].T
        return loss, g

    def fit(self, data: list[tuple[bytes, int]], steps: int = 500, batch: int = 48, longest: int = 48, rate: float = 0.015, seed: int = 3) -> ByteGru:
        """Adam over ``steps`` batches of training sentences. A step takes ``longest`` bytes from any
        place of a sentence, of one in six without its accents, of two in five with some words
        exchanged for words of any language, as names and technical terms are."""
        rng = np.random.default_rng(seed)
        pool = sorted({w for b, _ in data for w in b.split(b" ")})
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        order = np.concatenate([rng.permutation(len(data)) for _ in range(-(-steps * batch // len(data)))])
        for count in range(1, steps + 1):
            rows = [data[k] for k in order[(count - 1) * batch : count * batch]]
            x = np.frombuffer(b"".join(_part(b, longest, rng, pool) for b, _ in rows), dtype=np.uint8).reshape(len(rows), longest).T
            _, g = self.step(x, np.array([y for _, y in rows]))
            scale = min(1.0, 1.0 / (np.sqrt(sum(float((a * a).sum()) for a in g.values())) + 1e-9))
            now = rate * min(1.0, count / 20) * (1 - 0.95 * count / steps)
            for k in self.p:
                a = g[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.99 * v[k] + 0.01 * a * a
                self.p[k] -= (now * (m[k] / (1 - 0.9**count)) / (np.sqrt(v[k] / (1 - 0.99**count)) + 1e-8)).astype(self.p[k].dtype)
        return self

    def _scores(self, texts: list[bytes]) -> np.ndarray:
        """Sums over all positions of the log-probabilities of each language, of texts in the
        order of their lengths. The texts still being read are the last rows, so that nothing
        is masked and a text costs what it is long."""
        H, B, L = self.hidden, len(texts), len(self.langs)
        table, Uzr, Un = self._halved()
        Un = Un * np.float32(0.5)  # r is kept as 2 r below
        sizes = np.array([len(t) for t in texts])
        T = int(sizes[-1])
        x = np.zeros((T, B), dtype=np.intp)
        for k, t in enumerate(texts):
            x[: len(t), k] = np.frombuffer(t, dtype=np.uint8)
        first = np.searchsorted(sizes, np.arange(T), side="right")  # rows from here on reach position t
        s = np.empty((T, B, L), np.float32)
        s[:] = self.p["c"]
        gx, zr, rh, n = (np.empty((B, w), np.float32) for w in (3 * H, 2 * H, H, H))
        for k, steps in enumerate((range(T), range(T - 1, -1, -1))):
            h, part = np.zeros((B, H), np.float32), self.p["V"][k * H : (k + 1) * H]
            for t in steps:
                a = first[t]
                live, g, y, q, c = h[a:], gx[a:], zr[a:], rh[a:], n[a:]
                np.take(table[k], x[t, a:], axis=0, out=g)
                np.matmul(live, Uzr[k], out=y)
                y += g[:, : 2 * H]
                np.tanh(y, out=y)
                y += 1
                np.multiply(y[:, H:], live, out=q)
                np.matmul(q, Un[k], out=c)
                c += g[:, 2 * H :]
                np.tanh(c, out=c)
                live -= c
                live *= y[:, :H]
                live *= np.float32(0.5)
                live += c
                s[t, a:] += live @ part
        s -= s.max(axis=2, keepdims=True)
        s -= np.log(np.exp(s).sum(axis=2, keepdims=True))
        s *= (np.arange(T)[:, None] < sizes[None, :])[:, :, None]
        return s.sum(axis=0, dtype=np.float64)

    def pooled(self, texts: list[bytes], rows: int = 512, piece: int = 512) -> np.ndarray:
        """Mean log-probability over all positions of each text. Every text is read whole;
        one longer than ``piece`` bytes in pieces side by side, so that a single long one
        doesn't take as many steps as it has bytes. Pieces of like length share a batch."""
        parts = [(k, t[at : at + piece]) for k, t in enumerate(texts) for at in range(0, len(t), piece)]
        parts.sort(key=lambda p: len(p[1]))
        out, size = np.zeros((len(texts), len(self.langs))), np.array([max(1, len(t)) for t in texts])
        for at in range(0, len(parts), rows):
            some = parts[at : at + rows]
            np.add.at(out, [k for k, _ in some], self._scores([t for _, t in some]))
        return out / size[:, None]


def _part(text: bytes, longest: int, rng: np.random.Generator, pool: list[bytes]) -> bytes:
    chance = rng.random(2)
    if chance[0] < 1 / 6:
        text = "".join(c for c in unicodedata.normalize("NFKD", text.decode("utf-8", "replace")) if not unicodedata.combining(c)).replace("ł", "l").encode()
    if chance[1] < 0.4:
        words = text.split(b" ")
        for _ in range(1 + len(words) // 8):
            words[int(rng.integers(len(words)))] = pool[int(rng.integers(len(pool)))]
        text = b" ".join(words)
    text = (text or b" ") + b" "
    while len(text) < longest:  # a short sentence stands there more than once
        text += text
    at = int(rng.integers(0, len(text) - longest + 1))
    return text[at : at + longest]


def label_code(label) -> Column:
    """``canonical`` as an expression."""
    low = F.lower(F.trim(label))
    known = F.create_map(*[F.lit(x) for w, code in _CODE.items() for x in (w, code)])
    head = F.element_at(F.split(low, "[-_ ]"), 1)
    return F.when(~F.coalesce(low, F.lit("")).isin("", *_NONE), F.coalesce(F.element_at(known, low), F.element_at(known, head), low))


def train(docs: DataFrame, per_language: int = 2000, docs_per_language: int = 400, most_languages: int = 50, least_docs: int = 3) -> ByteGru:
    """Trains on at most ``per_language`` sentences of at most ``docs_per_language`` documents
    per label, those of the smallest hashes, of the ``most_languages`` labels that most documents
    bear; twice, as the first network tells which labels aren't languages of the corpus and
    which sentences are labelled wrongly. Labels are read first, then only the texts chosen."""
    own = docs.where("text is not null and doc_id is not null").select("doc_id", label_code(F.col("lang")).alias("code"), F.xxhash64("doc_id").alias("h")).where("code is not null")
    labels = [r.code for r in own.groupBy("code").count().where(F.col("count") >= least_docs).orderBy(F.desc("count"), "code").limit(most_languages).collect()]
    nearest = own.where(F.col("code").isin(labels)).withColumn("k", F.row_number().over(Window.partitionBy("code").orderBy("h", "doc_id"))).where(F.col("k") <= docs_per_language)
    code = {r.doc_id: r.code for r in nearest.select("doc_id", "code").collect()} if labels else {}
    chosen = docs.where(F.col("doc_id").isin(list(code)) & F.col("text").isNotNull()).select("doc_id", "text").collect() if code else []
    by: dict[str, list[str]] = {}
    for r in sorted(chosen, key=lambda r: r.doc_id):
        by.setdefault(code[r.doc_id], []).extend(sentences(r.text))
    rows = [(c, x) for c, found in by.items() for x in sorted(set(found), key=lambda x: xxhash.xxh64_intdigest(x.encode("utf-8", "replace")))[:per_language]]
    return kept(docs.sparkSession, rows, least_docs)


def kept(spark: SparkSession, rows: list[tuple[str, str]], least_docs: int) -> ByteGru:
    """The network for these training sentences: read from the shared folder if it was trained
    on them before, else trained and left there under the hash of what it was trained on."""
    content = xxhash.xxh64_hexdigest(repr((least_docs, sorted(set(rows)))).encode("utf-8", "replace"))
    name = f"{shared_dir(spark).rstrip('/')}/models/language-{content}.npz"
    stored = read_bytes(spark, name)
    if stored is not None:
        return ByteGru.load(stored)
    net = fit_sentences(rows, least_docs)
    write_bytes(spark, name, net.dump())
    return net


def fit_sentences(rows: list[tuple[str, str]], least: int = 3, doubt: float = 1.2) -> ByteGru:
    """Two trainings: the first tells real languages from wrong labels, the second leaves out
    sentences whose label the first contradicts by more than ``doubt`` nats per position."""
    rows = sorted(set(rows))
    count: dict[str, int] = {}
    for lang, _ in rows:
        count[lang] = count.get(lang, 0) + 1
    langs = sorted(k for k, n in count.items() if n >= least) or sorted(count) or ["und"]
    data = [(to_bytes(s), langs.index(l)) for l, s in rows if l in langs]
    if not data:
        return ByteGru(langs)
    net = ByteGru(langs, hidden=24).fit(data, steps=150)
    said = net.pooled([b for b, _ in data])
    own = {k: [said[i].argmax() == k for i, (_, y) in enumerate(data) if y == k] for k in range(len(langs))}
    real = [k for k in own if np.mean(own[k]) >= 0.5] or list(own)
    clean = [(b, real.index(y)) for i, (b, y) in enumerate(data) if y in real and said[i][y] >= said[i].max() - doubt]
    return ByteGru([langs[k] for k in real], seed=6).fit(clean)


def decide(scores: np.ndarray, sizes: list[int], change: float = 9.0, weight: float = 0.08) -> list[int]:
    """The language of every sentence of a document: Viterbi over pooled scores, where a
    change of language costs ``change`` nats and a position counts ``weight``."""
    gain = scores * (np.array(sizes) * weight)[:, None]
    best, came = gain[0], []
    for row in gain[1:]:
        jump = best.max() - change
        came.append(np.where(best >= jump, np.arange(len(best)), best.argmax()))
        best = np.maximum(best, jump) + row
    out = [int(best.argmax())]
    for step in reversed(came):
        out.append(int(step[out[-1]]))
    return out[::-1]


def segments(docs: DataFrame, net: ByteGru) -> DataFrame:
    """(doc_id, label, seg_no, seg_lang, confidence, n_sentences, n_segments): the runs of
    sentences in one language of every document that has sentences.

    Narrow: the network (some 20 kB) travels with the task; a sentence that comes again in
    a task is read once. Null, empty and wordless texts give no rows."""

    def run(batches):
        known: dict[bytes, np.ndarray] = {}  # sentences read by this task so far
        read = lru_cache(maxsize=100_000)(to_bytes)
        for whole in batches:
            for start in range(0, len(whole), 5000):
                pdf = whole.iloc[start : start + 5000]
                docs_ = [(d, l, [read(s) for s in sentences(t)]) for d, l, t in zip(pdf.doc_id, pdf.lang, pdf.text)]
                new = sorted({b for _, _, bs in docs_ for b in bs if b not in known})
                if len(known) > 200_000:
                    known.clear()
                    new = sorted({b for _, _, bs in docs_ for b in bs})
                known.update(zip(new, net.pooled(new)))
                rows = []
                for doc, label, bs in docs_:
                    if not bs:
                        continue
                    scores, sizes = np.array([known[b] for b in bs]), [len(b) for b in bs]
                    said = decide(scores, sizes)
                    runs, at = [], 0
                    for k in range(1, len(said) + 1):
                        if k == len(said) or said[k] != said[at]:
                            sure = np.exp(np.average(scores[at:k, said[at]], weights=sizes[at:k]))
                            runs.append((net.langs[said[at]], float(sure), k - at))
                            at = k
                    rows += [(doc, canonical(label), no, lang, sure, n, len(runs)) for no, (lang, sure, n) in enumerate(runs)]
                yield pd.DataFrame(rows, columns=["doc_id", "label", "seg_no", "seg_lang", "confidence", "n_sentences", "n_segments"])

    return docs.where("text is not null").select("doc_id", "lang", "text").mapInPandas(run, "doc_id bigint, label string, seg_no int, seg_lang string, confidence double, n_sentences int, n_segments int")


def relabelled(found: DataFrame) -> DataFrame:
    """The segments of documents whose label is missing or wrong or that mix languages."""
    return found.where("label is null or n_segments > 1 or label <> seg_lang")


def of_documents(found: DataFrame) -> DataFrame:
    """(doc_id, lang, confidence): the language with the most sentences of each document,
    of equals the first; ``confidence`` pools the document's segments."""
    by = found.groupBy("doc_id", "seg_lang").agg(F.sum("n_sentences").alias("n"), F.sum(F.col("confidence") * F.col("n_sentences")).alias("c"), F.min("seg_no").alias("at"))
    return by.groupBy("doc_id").agg(F.max_by("seg_lang", F.struct("n", -F.col("at"))).alias("lang"), (F.max_by("c", F.struct("n", -F.col("at"))) / F.sum("n")).alias("confidence"))
