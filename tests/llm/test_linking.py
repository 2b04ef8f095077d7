import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import canonical, linkage, names


@pytest.mark.parametrize("text, core, first", [
    ("Zódjak & Stardas Engineering s.r.o.", ("stardas", "zodjak"), ""), ("www.zodjak-stardas.example", ("stardas", "zodjak"), ""), ("T. Norkrogseskkax Usługi IT", ("norkrogseskkax",), "t"), ("Weskgasfunstip, Ignaś - Usługi IT", ("weskgasfunstip",), "ignacy"),
    ("Weskgasfunstip, I. - IT", ("weskgasfunstip",), "i"), ("Mezbrox i Zuvhośk SW Ltd", ("mezbrox", "zuvhosk"), ""), ("Rokz. Wugbralt Industries", ("rokz.", "wugbralt"), ""), ("Consulting", ("consulting",), ""),
])
def test_parts_of_names(text, core, first):
    assert names.part_name(text) == names.Name(core, first)


@pytest.mark.parametrize("text", [None, "", "  ", "...", "—"])
def test_names_without_words(text):
    assert names.part_name(text) is None


@pytest.mark.parametrize("a, b, same", [
    ("Hamjiv Lukdas", "lukdas hajmiv software", True), ("HamjivLukdas", "Hamjiv Lukdas", True), ("Tomasz Norkrogseskkax", "Tomek Norkrogsesskkax IT", True), ("Tomasz Norkrogseskkax", "Aleksander Norkrogseskkax", False), ("A. Norkrogseskkax", "Alek Norkrogseskkax", True),
    ("Wugbralt Rokzik", "Wugbralt Rokz. GmbH", True), ("Hatbrit Kumfex", "Hatbrit Zerlap", False),
])
def test_same_name(a, b, same):
    assert names.same_name(names.part_name(a), names.part_name(b)) is same


def test_bands_reach_the_wanted_recall():
    n = names.bands_for(0.45, 5, 0.97)
    assert names.collision(0.45, 5, n) >= 0.97 > names.collision(0.45, 5, n - 1)


def test_candidates_of_low_overlap(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.sample("bcdfghjklmnprstvwxz", n))
    want = set()
    for _ in range(60):
        short, (x, y) = word(5), (word(6), word(7))
        swapped = short[:2] + short[3] + short[2] + short[4]
        first, last = sorted((x, y))
        typed = last + first[:2] + "a" + first[3:]  # reversed, without a gap, one letter wrong
        want |= {tuple(sorted((f"|{short}", f"|{swapped}"))), tuple(sorted((f"|{first} {last}", f"|{typed}")))}
    assert all(names.same_name(names._as_name(a), names._as_name(b)) for a, b in want)
    nodes = spark.createDataFrame(sorted({(n, 1) for p in want for n in p}), "node string, n bigint")
    got = {(r.a, r.b) for r in names.candidate_pairs(nodes).collect()}
    for several in (False, True):
        kind = {p for p in want if (" " in p[0] + p[1]) is several}
        assert len(got & kind) / len(kind) >= 0.9


def test_more_than_four_parts_run_together():
    parts = ("abel", "bora", "cedi", "dofu", "egam")
    assert names.monge_elkan(parts, ("cediabeldofuegambora",)) == 1.0
    assert names.monge_elkan(parts, ("cediabelxdofuegambora",)) > 0.9 and names.monge_elkan(parts, ("zzzzabelqqqqdofuegambora",)) < 0.79


def test_stars_of_a_long_chain(spark):
    n = 40  # falling weight: a round takes two nodes from the heavy end
    nodes = spark.createDataFrame([(f"|n{k:02d}", 100 - k) for k in range(n)], "node string, n bigint")
    edges = spark.createDataFrame([(f"|n{k:02d}", f"|n{k + 1:02d}") for k in range(n - 1)], "a string, b string")
    got = {r.node: r.center for r in names.stars(nodes, edges).collect()}
    assert got == {f"|n{k:02d}": f"|n{k - k % 2:02d}" for k in range(n)}


def people(rng: random.Random, n: int):
    syllables = ["bal", "kor", "tin", "vex", "mud", "rop", "sel", "gaf", "win", "zok", "hul", "pef"]
    out = []
    for _ in range(n):
        a, b = ("".join(rng.choice(syllables) for _ in range(3)) for _ in range(2))
        base = f"{a} {b}"
        k = rng.randrange(len(a) - 1)
        out.append([base + " Group", f"{b.upper()} {a.upper()} S.A.", a + b, (a[:k] + a[k + 1 :] + " " + b).title() + " Ltd", f"www.{a}-{b}.example"])
    return out


def test_clusters_recover_planted_variants(spark):
    groups = people(random.Random(4), 40)
    rows = [(k * 10 + i, name, "x") for k, g in enumerate(groups) for i, name in enumerate(g)] + [(9000, None, "x"), (9001, "", "x"), (9002, groups[0][0], "x"), (9002, groups[0][0], "x")]
    df = spark.createDataFrame(rows, "employer_id bigint, employer_name string, node string").withColumn("center", F.lit(1)).withColumn("salt", F.lit(2))
    got = {(r.employer_a, r.employer_b) for r in names.linked_profiles(df, crowd=2).collect()}
    want = {(k * 10 + i, k * 10 + j) for k, g in enumerate(groups) for i in range(len(g)) for j in range(i + 1, len(g))} | {(i, 9002) for i in range(5)}
    assert len(got & want) / len(want) >= 0.95 and len(got - want) <= 0.02 * len(want)
    assert names.linked_profiles(df.limit(0)).count() == 0


def test_letters_rule_out_no_name_that_is_the_same():
    rng = random.Random(5)
    nodes = {names.node_of(n) for g in people(rng, 12) for n in g} | {"|abel bora cedi dofu", "|boraabelcedidofu", "k|korwin", "karol|korwin", "karol|korvin", "|rokz. wugbralt", "|rokzik wugbralt", "|rokzikwugb.", "|ab.", "|abel"}
    side = names.Side(sorted(nodes), 4, 0.97, 80)
    i, j = (np.array(x) for x in zip(*[(i, j) for i in range(len(nodes)) for j in range(len(nodes)) if side.own[i].first[:1] == side.own[j].first[:1]]))
    able = names.can_be_one(side, i, side, j)
    same = np.array([names.same_name(side.own[x], side.own[y]) for x, y in zip(i, j)])
    assert not (same & ~able).any() and able.sum() < 0.5 * len(able)
    met = {p for most in (1, 1 << 20) for x, y in names.met(side, side, most) for p in zip(x.tolist(), y.tolist(), [most] * len(x))}
    assert {p[:2] for p in met if p[2] == 1} == {p[:2] for p in met if p[2] > 1}


def test_nodes_move_and_no_candidate(spark):
    nodes = spark.createDataFrame([(names.node_of(n), 1) for g in people(random.Random(6), 300) for n in g], "node string, n bigint").distinct()
    dealt = names.blocks(nodes, size=400)
    groups = -(-nodes.count() // 400)
    assert dealt.count() == nodes.count() * groups and {r.block for r in dealt.where("side < 2").collect()} == {i * groups + j for i in range(groups) for j in range(i + 1, groups)}
    assert {r.id for r in nodes.select(F.xxhash64("node").alias("id")).collect()} == {names.node_id(r.node) for r in nodes.collect()}
    rows = spark.createDataFrame([], "offer_id bigint, source string, employer bigint, tech bigint, kind bigint, level bigint, area bigint, cities array<bigint>")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(names.candidate_pairs(nodes)) and "Aggregate" not in plan(linkage.compared(rows))


def test_a_pair_of_several_passes_and_cities_is_made_once(spark):
    rows = [(1, "a", 5, 1, 1, 1, 1, [1, 2]), (2, "b", 5, 1, 1, 1, 1, [1, 2]), (3, "c", 5, 1, 2, 1, 1, [3]), (4, "d", 5, None, 1, 1, 1, [2]), (5, "d", 5, 1, 1, 2, 1, [2]), (6, "e", 6, 1, 1, 1, 1, [1])]
    df = spark.createDataFrame(rows, "offer_id bigint, source string, employer bigint, tech bigint, kind bigint, level bigint, area bigint, cities array<bigint>")
    got = sorted((r.offer_a, r.offer_b, r.pattern) for r in linkage.compared(df).collect())
    assert got == [(1, 2, "222222"), (1, 3, "220220"), (1, 4, "212222"), (1, 5, "222022"), (2, 3, "220220"), (2, 4, "212222"), (2, 5, "222022")]


def canon(spark):
    return spark.createDataFrame(
        [(1, "req_technology", "JavaScript", ["ECMAScript"]), (2, "req_technology", "Vue.js", ["Vue"]), (3, "req_technology", "Ruby on Rails", ["RoR"]), (4, "req_technology", "Ruby", None), (5, "req_technology", "C#", ["C Sharp"]), (6, "req_technology", "Go", ["Golang"]), (7, "req_technology", ".NET", []),
         (11, "cities", "Łódź", []), (12, "cities", "München", ["Munich"]), (13, "cities", "Frankfurt am Main", ["Frankfurt"]), (21, "role_seniority", "lead", ["team leader"]), (22, "role_seniority", "regular", ["mid"])],
        "canon_id bigint, field_name string, canon_name string, other_names array<string>")


@pytest.mark.parametrize("field, value, want", [
    ("req_technology", "JavScropt", 1), ("req_technology", "#JavaScript", 1), ("req_technology", "eue.js", 2), ("req_technology", "Ruby ono Rails", 3), ("req_technology", "ruby 3", 4), ("req_technology", "C hSarp", 5), ("req_technology", "knowledge of Go", 6), ("req_technology", "dotnet", 7), ("req_technology", "good manners", -1), ("req_technology", "", -1), ("req_technology", "—", -1),
    ("cities", "LODZ area", 11), ("cities", "m. Munchen", 12), ("cities", "monachium", 12), ("cities", "Farnkfurt am nain", 13), ("cities", "Ober-Quellhausen", -1), ("role_seniority", "tema lleader", 21), ("role_seniority", "team spirit", -1), ("role_seniority", "meduim", 22), ("role_seniority", "x" * 20000, -1),
])
def test_best_entry(spark, field, value, want):
    assert canonical.references(canon(spark))[field].best(value) == want


def test_distance_is_symmetric_and_counts_swaps():
    assert canonical.distance("spark", "saprk", 2) == 1 and canonical.distance("praktykant", "pkrtykant", 3) == canonical.distance("pkrtykant", "praktykant", 3) == 2
    assert canonical.distance("abc", "xyz", 1) == 2 and canonical.distance("", "", 1) == 0


def test_map_values_rows(spark):
    at = "timestamp '2025-01-01'"
    df = spark.sql(f"""select * from values (1L, {at}, array('go', null, 'Go', 'x'), array('Lodz'), 'Lead', 7), (1L, {at}, array('go', null, 'Go', 'x'), array('Lodz'), 'Lead', 7), (2L, {at}, null, array(), null, 7),
        (3L, {at}, array(''), null, 'lead', 7), (null, {at}, array('go'), null, 'x', 7) t(offer_id, ingested_at, req_technology, cities, role_seniority, canon_id)""").withColumn("value", F.lit("v"))
    got = {(r.offer_id, r.field_name, r.pos, r.canon_id) for r in canonical.map_values(df, canon(spark)).collect()}
    assert got == {(1, "req_technology", 0, 6), (1, "req_technology", 3, -1), (1, "cities", 0, 11), (1, "role_seniority", 0, 21), (3, "req_technology", 0, -1)}
    assert canonical.map_values(df.limit(0), canon(spark)).count() == 0 and canonical.map_values(df, canon(spark).limit(0)).count() == 0


@pytest.mark.parametrize("title, want", [
    ("Junior C# Test Engineer (Payments) (m/f/d)", (5, "tester", "junior", "payments")), ("Programista Go – Płatności [Starszy]", (6, "developer", "senior", "payments")), ("cards: trainee vue.js admin", (2, "administrator", "intern", "cards")), ("Leading Ruby on Rails Consultant - Hipoteki", (3, "consultant", "lead", "mortgages")), (None, (None,) * 4), ("", (None,) * 4),
])
def test_titles(spark, title, want):
    p = linkage.Titles(canonical.references(canon(spark))["req_technology"]).part(title)
    assert (p.get("tech"), p.get("kind"), p.get("level"), p.get("area")) == want


def totals(n: int = 600_000):
    """All pairs of a table as ``agreement`` counts them: the more alike within an employer."""
    part = lambda k, share: (k - round(k * share), 0, round(k * share))
    rates = dict(zip(linkage.ATTRIBUTES[1:], (0.02, 0.3, 0.2, 0.03, 0.1)))
    same = n // 100
    return {"any": {"employer": (n - same, 0, same), **{a: part(n, r) for a, r in rates.items()}}, "same": {"employer": (0, 0, same), **{a: part(same, 1.5 * r) for a, r in rates.items()}}}


@pytest.mark.parametrize("scale", [1, 1000])
def test_em_separates_matches(scale):
    counts = {"222222": 900, "202220": 700, "220220": 80, "222202": 90, "222022": 70, "220222": 60, "222220": 120}
    model = linkage.fit({k: n * scale for k, n in counts.items()}, {k: {a: tuple(x * scale for x in t) for a, t in d.items()} for k, d in totals().items()})
    assert linkage.posterior("222222", model) > 0.99
    assert all(linkage.posterior(c, model) < 0.5 for c in counts if "0" in c)
    for d in [*model.m, *model.n, *model.u["any"], *model.u["same"]]:
        assert abs(sum(d.values()) - 1) < 1e-9
    assert abs(sum(model.odd) - 1) < 1e-9 and abs(sum(linkage.shares("222202", model)[2]) + sum(linkage.shares("222202", model)[:2]) - 1) < 1e-9


def test_agreement_equals_counted_pairs(spark):
    rng = random.Random(2)
    pick = lambda *x: rng.choice([*x, None])
    rows = [(k, rng.choice("ab"), pick(1, 2), pick(1, 2, 3), pick("d", "t"), pick("s"), pick("x", "y"), rng.choice([[], ["1"], ["2"]])) for k in range(60)]
    df = spark.createDataFrame(rows, "offer_id bigint, source string, employer bigint, tech bigint, kind string, level string, area string, cities array<string>")
    got = linkage.agreement(df)
    for name in ("any", "same"):
        pairs = [(x, y) for i, x in enumerate(rows) for y in rows[i + 1 :] if x[1] != y[1] and (name == "any" or x[2] is not None and x[2] == y[2])]
        for i, c in ((3, "tech"), (4, "kind"), (5, "level"), (6, "area")):
            unknown = sum(x[i] is None or y[i] is None for x, y in pairs)
            agree = sum(x[i] is not None and x[i] == y[i] for x, y in pairs)
            assert got[name][c] == (len(pairs) - unknown - agree, unknown, agree)
        assert got[name]["city"][2] == sum(bool(set(x[7]) & set(y[7])) for x, y in pairs)
    assert linkage.agreement(df.limit(0))["any"]["tech"] == (0, 0, 0)


def test_linkage_rows(spark):
    at = "timestamp '2025-01-01'"
    df = spark.sql(f"""select * from values
        (1L, {at}, 'jji', 'Hamjiv Lukdas Group', 'Senior Go Developer (Payments)', array('Łódź')), (2L, {at}, 'bdj', 'LUKDAS HAMJIV', 'Programista Golang – Płatności [Starszy]', array('lodz', 'Munich')),
        (3L, {at}, 'bdj', 'Hamjiv Lukdas', 'Senior Go Developer (Payments)', array('München')), (4L, {at}, 'jji', 'Hamjiv Lukdas', 'Senior Go Engineer (Payments)', array('Łódź')), (5L, {at}, 'nfj', 'Hamjiv Lukdas', 'Junior Go Engineer (Payments)', array('Łódź')),
        (6L, {at}, null, null, null, null), (7L, {at}, 'ptc', '', '', array()), (2L, {at}, 'bdj', 'LUKDAS HAMJIV', 'Programista Golang – Płatności [Starszy]', array('lodz', 'Munich'))
        t(offer_id, ingested_at, source, employer_name, role_title, cities)""").withColumn("employer", F.lit("x")).withColumn("pattern", F.lit("y"))
    got = {(r.offer_a, r.offer_b): r for r in linkage.matches(df, canon(spark)).collect()}
    assert {k for k, r in got.items() if r.pattern == "222222"} == {(1, 2), (2, 4)} and (1, 4) not in got and (2, 3) not in got
    assert all(0 <= r.confidence <= 1 for r in got.values())
    assert linkage.matches(df.limit(0), canon(spark)).count() == 0
