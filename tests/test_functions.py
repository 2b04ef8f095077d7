import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import html as H
from millrace.functions import text as X
from millrace.functions import variant as V


def one(spark, value, kind, f):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(f(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("value, want", [([" Go ", "go", "", None, "C#"], ["Go", "C#"]), (None, []), ([], []), ([None], []), ([" x﻿", "X"], ["x"])])
def test_normalize_string_array(spark, value, want):
    assert one(spark, value, "array<string>", X.normalize_string_array) == want


def test_union_keeps_first_spelling_and_order(spark):
    df = spark.createDataFrame([(["Go", " rust"], ["RUST", "C", "go "])], "a array<string>, b array<string>")
    assert df.select(X.union_ci(F.col("a"), F.col("b"))).first()[0] == ["Go", " rust", "C"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \t", max_size=3)), max_size=6))
def test_normalising_twice_changes_nothing(spark, values):
    once = one(spark, values, "array<string>", X.normalize_string_array)
    assert one(spark, once, "array<string>", X.normalize_string_array) == once


@pytest.mark.parametrize("value, want", [("Trainee", "intern"), (" MID ", "regular"), ("medium", "regular"), ("c_level", "c-level"), ("", None), (None, None), ("Senior", "senior")])
def test_seniority(spark, value, want):
    assert one(spark, value, "string", X.seniority) == want


@pytest.mark.parametrize("value, want", [("31.02.2026", "2026-03-03"), ("5.3.2026", "2026-03-05"), ("1.13.2025", "2026-01-01"), ("x", None), (None, None)])
def test_dmy(spark, value, want):
    assert one(spark, value, "string", X.dmy_to_iso) == want


def test_canonical_slug_prefers_remote_then_short_then_first(spark):
    assert one(spark, ["bbb", "aaaa-REMOTE", "cc-remote", "dd-remote"], "array<string>", X.canonical_slug) == "cc-remote"
    assert one(spark, ["bb", "aa", "ccc"], "array<string>", X.canonical_slug) == "bb"
    assert one(spark, [], "array<string>", X.canonical_slug) is None


def test_numbers_and_times(spark):
    assert one(spark, 100.0, "double", X.js_number) == "100"
    assert one(spark, 10.5, "double", X.js_number) == "10.5"
    assert one(spark, 1744805170123, "bigint", X.millis_to_iso) == "2025-04-16T12:06:10.123Z"


def test_weekly_key_compat_differs_only_in_odd_years(spark):
    df = spark.sql("select explode(array(date'2021-03-05', date'2025-03-05')) d")
    rows = df.select(X.weekly_key(F.lit("u"), F.col("d")).alias("a"), X.weekly_key(F.lit("u"), F.col("d"), compat=True).alias("b")).collect()
    assert rows[0].a != rows[0].b and rows[1].a == rows[1].b


DOC = {"name": "x", "age": 3, "active": True, "address": {"city": "L", "geo": {"lat": 1.5}}, "tags": ["a", "b"], "empty": None, "a/b+json": [{"k": 1}]}


@pytest.fixture(scope="module")
def doc(spark):
    return spark.createDataFrame([(json.dumps(DOC),)], "j string").select(F.parse_json("j").alias("v"))


@pytest.mark.parametrize("path, kind", [("name", "STRING"), ("age", "NUMBER"), ("active", "BOOLEAN"), ("address", "OBJECT"), ("tags", "ARRAY"), ("empty", "NULL"), ("none", None), ("tags.5", None), ("tags.1", "STRING"), ("a/b+json.0.k", "NUMBER"), ("address.geo.lat", "NUMBER")])
def test_kinds_tell_missing_from_null(doc, path, kind):
    assert doc.select(V.kind(V.get(F.col("v"), path))).first()[0] == kind


def test_strict_getters_do_not_coerce(doc):
    row = doc.select(V.text(F.col("v"), "age").alias("a"), V.number(F.col("v"), "name").alias("b"), V.flag(F.col("v"), "age").alias("c"), V.text(F.col("v"), "address.city").alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == (None, None, None, "L")


def test_reader_keeps_the_first_error(doc):
    r = V.Reader(F.col("v"))
    r.text("name")
    r.text("address.country")
    r.flag("age")
    assert doc.select(r.error()).first()[0] == 'No entry at path "country"'
    with pytest.raises(ValueError):
        V.compile_path("")


def test_html_cleaning_and_markdown():
    page = '<html><body><!-- c --><script>var t="</p>"</script><div class="mui-1 keep"><h2>A <!-- -->B</h2><p>x <b>y</b><p>z<ul><li>one<li>two <a href="/u">l</a></ul><span></span></div><footer>f</footer></body></html>'
    clean = H.clean_page(page, "jji")
    assert "script" not in clean and "footer" not in clean and 'class="keep"' in clean and "<span>" not in clean
    assert H.to_markdown(clean) == "## A B\n\nx **y**\n\nz\n\n- one\n- two [l](/u)\n\n"
    assert H.to_markdown("") == "" and H.clean_page("<p", "bdj") is not None


def test_page_reader_takes_nulls_and_long_pages(spark):
    df = spark.createDataFrame([(None, "jji"), ("", "nfj"), ("<p>" + "x" * 300000, "bdj"), ("<p>a</p>", None)], "h string, s string")
    rows = df.select(H.read_page(F.col("h"), F.col("s")).alias("p")).collect()
    assert rows[0].p.clean is None and rows[2].p.n_paragraphs == 1


def test_embedded_json():
    assert H.embedded(H.parse('<script type="application/json">{"a":1}</script><script type="application/json">{bad</script>'), "application/json") == ['{"a":1}', "{}"]


def test_prompt_and_measures(spark):
    lines = schema.prompt().split("\n")
    assert lines[0] == "You extract structured data from job offers." and lines[-1].startswith("- stage (string, nullable)") and len(lines) == 71
    empty = spark.range(1).select(schema.record({}).alias("job"))
    row = empty.select(schema.quality(F.col("job")).alias("q"), schema.valid(F.col("job")).alias("ok")).first()
    assert abs(row.q - 8 / 47) < 1e-12 and row.ok
    bad = spark.range(1).select(schema.record({"role.seniority": F.lit("guru")}).alias("job"))
    assert bad.select(schema.valid(F.col("job"))).first()[0] is False


def test_merge_rules(spark):
    a = schema.record({"employer.name": F.lit("a"), "role.title": F.lit("t"), "workplace.cities": F.array(F.lit("X"))})
    b = schema.record({"employer.name": F.lit("b"), "role.title": F.lit(""), "workplace.cities": F.array(F.lit("x "), F.lit("Y")), "workplace.isRemote": F.lit(False)})
    m = spark.range(1).select(a.alias("a"), b.alias("b")).select(schema.merge(F.col("a"), F.col("b")).alias("m")).first().m
    assert (m.employer.name, m.role.title, m.workplace.cities, m.workplace.isRemote) == ("b", "t", ["X", "Y"], False)
