import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import blocks, contamination, encoding, language, mainbody
from millrace.llm.queries import BYTE_PATTERN, TOKENIZERS


def test_blocks_follow_the_definition():
    page = parse = blocks.parse("<html><head><title>T | B</title></head><body><nav><p>a<p>b <b>c</b>&nbsp;d</nav><!-- x --><p>e<!-- y -->f<br>g</p><noscript><p>n</p></noscript><template><p>t</p></template><script>var t='</p><p>x';</script><ul><li>1<li>2</ul> &amp;\n z</body>")
    assert [b.text for b in page.blocks] == ["a", "b c d", "ef", "g", "1", "2", "& z"] and parse.title == "T | B"
    assert blocks.parse(None).blocks == [] and blocks.parse("").blocks == [] and blocks.parse("<p").blocks != None  # noqa: E711
    assert len(blocks.parse("<div>" * 3000 + "x").blocks) == 1


def make_page(rng: random.Random, k: int) -> tuple[str, list[str]]:
    main = [f"Senior Go Tester ({k})", f"Firm {k}", f"Place of work: City {k}"] + [f"We build thing number {rng.randrange(999)} and ship it every week." for _ in range(6)]
    tag = rng.choice(["main", "div", "section"])
    nav = "".join(f"<li>{x}</li>" for x in ("Jobs", "Salaries", "Sign in"))
    card = "<div class='card'><p>Apply now</p><p>Similar offers</p><p>Lead PHP Tester (Maps)</p><p>9000 - 12000 PLN</p></div>"
    inside, outside = (card, "") if k % 3 == 0 else ("", card)  # boards write the same into offers and around them
    body = f"<h1>{main[0]}</h1>" + "".join(f"<p>{x}</p>" for x in main[1:4]) + inside + "".join(f"<p>{x}</p>" for x in main[4:])
    return f"<html><head><title>{main[0]} | B</title></head><body><nav><ul>{nav}</ul></nav><{tag}>{body}</{tag}>{outside}<footer><p>Terms of use</p><p>We build thing number 7 and ship it every week.</p></footer></body></html>", main


def test_field_keeps_the_main_body(spark):
    rng = random.Random(3)
    made = [make_page(rng, k) for k in range(120)]
    rows = [(k, html, "x") for k, (html, _) in enumerate(made)] + [(900, None, "x"), (901, "", "x"), (902, "<p>This offer is gone.</p>", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, html string, text string").withColumn("block_no", F.lit(1))
    field = mainbody.train(df.where("page_id < 60"), sample=60)
    got = {(r.page_id, r.text_md5) for r in mainbody.main_blocks(df.where("page_id >= 60"), field).collect()}
    want = {(k, hashlib.md5(t.encode()).hexdigest()) for k, (_, main) in enumerate(made) for t in main if k >= 60}
    assert len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)
    assert mainbody.main_blocks(df.limit(0), field).count() == 0 and mainbody.train(df.limit(0)).decode(mainbody.features(blocks.parse(""))) == []


def test_labels_need_no_wording():
    rng = random.Random(5)
    pages = []
    for k in range(80):
        html, _ = make_page(rng, k)
        pages.append(html.replace("</h1>", "</h1><div><p>Zorp blip</p><p>Quux now</p></div>").replace("<footer>", "<aside><p>Zorp blip</p><p>Other thing</p></aside><aside><p>Zorp blip</p></aside><aside><p>Quux now</p></aside><footer>"))
    read = [(p, mainbody.Layout(p)) for p in map(blocks.parse, pages)]
    wordings = mainbody.Wordings(read)
    for page, at in read:
        got = {b.text for b, y in zip(page.blocks, mainbody.label(page, at, wordings)) if y}
        assert not got & {"Zorp blip", "Quux now", "Jobs"} and page.title.split(" | ")[0] in got


def test_marginals_and_viterbi_against_all_labelings():
    import itertools

    f = mainbody.Field()
    rng = np.random.default_rng(1)
    f.emit[:6] = rng.normal(size=(6, 2))
    f.move = rng.normal(size=(2, 2))
    own = np.array([x for k in range(5) for x in (k, (k + 2) % 6)], dtype=np.int32)
    rows = mainbody.Rows(own, np.arange(0, 10, 2), np.array([0, 0, 1, 1, 1]), np.array([5, 1], dtype=np.int32), np.array([0, 1]))
    s = f.scores(rows)
    assert np.allclose(s, [f.emit[rows.of(k)].sum(axis=0) for k in range(5)])
    total = {y: sum(s[t, y[t]] for t in range(5)) + sum(f.move[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=5)}
    z = np.log(sum(np.exp(v) for v in total.values()))
    one, _ = f.marginals(s)
    assert np.allclose(one[2, 1], sum(np.exp(v - z) for y, v in total.items() if y[2] == 1))
    assert f.decode(rows) == list(max(total, key=total.get))


TEXTS = [None, "", " ", "Hello world", "Łódź żółć naïve — “quoted” 🚀🚀", "a" * 5000, "aaaa bbbb\n\n\n  x\t\ty'll don't 12345", "日本語テキスト", "\x00​﻿", "The the THE the\r\nThe"]


def test_encoding_equals_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("abcdeéł 1.,-'\n<|end|>") for _ in range(rng.randrange(200))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit(1))
    got = {r.doc_id: r.ids for r in encoding.encode(df, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", BYTE_PATTERN).collect()}
    assert got == {k: t.encode(x, add_special_tokens=False).ids if x else [] for k, x in enumerate(texts)}
    assert encoding.encode(df.limit(0), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", BYTE_PATTERN).count() == 0
    ranks = encoding.load_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    back = {i: b for b, i in ranks.items()}
    assert all(b"".join(back[i] for i in got[k]).decode() == x for k, x in enumerate(texts) if x)


def test_words_ignore_what_does_not_count():
    assert contamination.words("Zam​knął, <b>dzi</b>ał<br/>x &amp; **Y** co­de") == contamination.words("zamknal dzial x y code") == ["zamknal", "dzial", "x", "y", "code"]
    assert contamination.words(None) == contamination.words("—") == []


def test_suffix_array_is_sorted():
    data = np.array([3, 1, 2, 1, 2, 1, 0, 2, 2, 2, 0])
    order = contamination.suffix_array(data, np.arange(len(data)), len(data))
    assert [tuple(data[k:]) for k in order] == sorted(tuple(data[k:]) for k in range(len(data)))
    assert len(contamination.suffix_array(data[:0], np.arange(0), 3)) == 0


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 40)))) for k in range(25)] + [(90, None), (91, ""), (92, "x " * 40), (93, items_text := "a b c")]
    docs = []
    for k in range(150):
        ws = [rng.choice(vocab + ["other", "words"]) for _ in range(60)]
        i = rng.randrange(25)
        src = items[i][1].split()
        n = rng.randrange(8, 16)
        at = rng.randrange(len(ws))
        docs.append((k, " ".join(ws[:at]) + " " + ", ".join(src[:n]).upper() + " " + " ".join(ws[at:])))
    docs += [(900, None), (901, ""), (902, "x " * 50000), (903, items_text), (900, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)).withColumn("n_words", F.lit(2))
    it = spark.createDataFrame(items, "item_id bigint, item_text string").withColumn("text", F.lit("t"))
    got = {(r.doc_id, r.item_id): r.n_words for r in contamination.leaks(df, it, shard_words=500, block=10).collect()}
    grams: dict = {}
    for i, t in items:
        ws = (t or "").split()
        for k in range(len(ws) - 11):
            grams.setdefault(tuple(ws[k : k + 12]), set()).add(i)
    want = set()
    for d, t in docs:
        ws = contamination.words(t)
        for k in range(len(ws) - 11):
            want |= {(d, i) for i in grams.get(tuple(ws[k : k + 12]), ())}
    assert set(got) == want and len(want) > 20 and got[(902, 92)] == 40
    left = contamination.without_leaks(df, contamination.leaks(df, it))
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert contamination.leaks(df, it.limit(0)).count() == 0 and contamination.leaks(df.limit(0), it).count() == 0


PHRASES = {
    "en": ("we", "build the service for our customers", "and the team ships it every week"), "de": ("wir", "bauen den dienst für unsere kunden", "und das team liefert jede woche"), "pl": ("my", "budujemy usługę dla naszych klientów", "a zespół wydaje ją co tydzień"),
}


def sentence(rng: random.Random, lang: str) -> str:
    ws = (" ".join(PHRASES[lang])).split()
    return " ".join(rng.choice(ws) for _ in range(9)).capitalize() + "."


def test_canonical_labels():
    assert [language.canonical(x) for x in ("en_GB", "POL", "Deutsch", "čeština", None, "", "und", "??", "tlh")] == ["en", "pl", "de", "cs", None, None, None, None, "tlh"]


def test_sentences():
    text = "# Title here and there\n\n- We ship it every week. Wir bauen den Dienst heute! ✅\nPython\n1. Good knowledge of C++.\nSenior Dev of Things, Sr.\n" + "x" * 50
    assert language.sentences(text) == ["We ship it every week.", "Wir bauen den Dienst heute! ✅", "Good knowledge of C++."]
    assert language.sentences(None) == language.sentences("") == []


def test_gradients_against_differences():
    net = language.ByteGru(["a", "b"], hidden=3, embed=2, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = np.array([[97, 98], [98, 99], [99, 97], [97, 98]]), np.array([0, 1])
    _, g = net.step(x, y)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for k in range(0, flat.size, max(1, flat.size // 7)) if name != "E" else (97 * 2, 98 * 2 + 1):
            old = flat[k]
            flat[k] = old + 1e-4
            up, _ = net.step(x, y)
            flat[k] = old - 1e-4
            down, _ = net.step(x, y)
            flat[k] = old
            assert abs((up - down) / 2e-4 - g[name].reshape(-1)[k]) < 1e-5


def test_pooling_equals_position_by_position():
    net = language.ByteGru(["a", "b", "c"], hidden=5, embed=4, seed=2)
    sig = lambda v: 1 / (1 + np.exp(-v))

    def states(text: bytes, d: str) -> list[np.ndarray]:
        h, out = np.zeros(5), []
        for c in text:
            g = net.p["E"][c] @ net.p[f"W{d}"] + net.p[f"a{d}"]
            z, r = np.split(sig(g[:10] + h @ net.p[f"U{d}"][:, :10]), 2)
            n = np.tanh(g[10:] + (r * h) @ net.p[f"U{d}"][:, 10:])
            h = n + z * (h - n)
            out.append(h)
        return out

    def alone(text: bytes) -> np.ndarray:
        back = states(text[::-1], "b")[::-1]
        s = np.array([np.concatenate(p) @ net.p["V"] + net.p["c"] for p in zip(states(text, "f"), back)])
        return (s - np.log(np.exp(s).sum(axis=1, keepdims=True))).mean(axis=0)

    texts = [b"abc", b"", b"x", b"zu\xc5\x82 long enough", b"abc"]
    got = net.pooled(texts, rows=3)
    assert all(np.allclose(got[k], alone(t), atol=1e-5) for k, t in enumerate(texts) if t) and not got[1].any()
    long = bytes(range(97, 123)) * 3
    assert np.allclose(net.pooled([long], piece=26)[0], net.pooled([long[:26]])[0], atol=1e-5)
    again = language.ByteGru.load(net.dump())
    assert again.langs == net.langs and np.allclose(again.pooled(texts), got)


def test_label_codes_equal_the_plain_form(spark):
    labels = ["en_GB", "POL", "Deutsch", "čeština", None, "", " und ", "??", "tlh", "uk-UA", " EN "]
    df = spark.createDataFrame([(x,) for x in labels], "lang string")
    assert [r.c for r in df.select(language.label_code(F.col("lang")).alias("c")).collect()] == [language.canonical(x) for x in labels]


def test_network_labels_segments(spark):
    rng = random.Random(6)
    docs = []
    for k in range(120):
        lang = rng.choice(list(PHRASES))
        docs.append((k, lang if k % 10 else "fr", " ".join(sentence(rng, lang) for _ in range(5)), lang))
    mixed = [(500, "en", sentence(rng, "en") + "\n" + sentence(rng, "de") + " " + sentence(rng, "de"), ""), (501, None, None, ""), (502, "en", "", ""), (503, "en", "Python", ""), (504, None, sentence(rng, "pl"), "pl"), (505, "EN", sentence(rng, "en") * 3000, "en")]
    df = spark.createDataFrame(docs + mixed, "doc_id bigint, lang string, text string, truth string").withColumn("label", F.lit("x")).withColumn("h", F.lit(1))
    net = language.train(df.where("doc_id < 100"))
    assert set(net.langs) == set(PHRASES)
    found = language.segments(df, net).cache()
    one = {r.doc_id: r.seg_lang for r in found.where("n_segments = 1").collect()}
    hits = [one.get(k) == t for k, _, _, t in docs if k >= 100]
    assert np.mean(hits) >= 0.9
    assert [(r.seg_no, r.seg_lang) for r in found.where("doc_id = 500").orderBy("seg_no").collect()] == [(0, "en"), (1, "de")]
    assert {r.doc_id for r in language.relabelled(found).where("doc_id >= 500").collect()} == {500, 504}
    assert language.of_documents(found).where("doc_id = 500").first().lang == "de" and language.of_documents(found).where("confidence > 1.000001 or confidence <= 0").count() == 0
    assert language.segments(df.limit(0), net).count() == 0 and language.train(df.limit(0)).langs == ["und"]
