import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as X
from millrace.operators import cleaners, guards, pipeline, registry, sinks
from millrace.sources import listings

def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def decided(spark, rows):
    df = spark.createDataFrame(rows, "job_id string, body string, action string, guard string, message string, cache_path string")
    return df.withColumn("decision", F.struct("action", "guard", "message"))


def held(spark, root, area):
    like = spark.createDataFrame([], "job_id string, body string, error struct<stage:string,name:string,message:string,timestamp:timestamp,cause:struct<name:string,message:string>>")
    return {r.job_id: r for r in sinks.stored(spark, f"{root}/{area}", like).collect()}


def test_routes_move_jobs_once(spark, tmp_path):
    root, cache = str(tmp_path / "areas"), str(tmp_path / "cache")
    sinks.put(spark.createDataFrame([("c1", "x"), ("c2", "y")], "cache_path string, content string"), cache, "cache_path")
    first = decided(spark, [("a", "1", "advance", "inputs", "m", None), ("b", "2", "advance", "inputs", "m", None), ("c", None, "load", "quality", "m", None), ("d", "4", "advance", "inputs", "m", "c1")])
    assert sinks.route(first, root, now(), ["body"], cache) == {"load": 1, "quarantine": 0, "trash": 0, "staging": 3, "removed": 0, "cache": 0}
    second = decided(spark, [("a", "1", "quarantine", "clean", "broken", None), ("b", "2", "trash", "duplicate", "duplicate", None), ("d", "4", "remove", "content", "short", "c1"), ("c", "new", "load", "quality", "m", None)])
    assert sinks.route(second, root, now(), ["body"], cache) == {"load": 1, "quarantine": 1, "trash": 1, "staging": 0, "removed": 1, "cache": 1}
    again = sinks.route(second, root, now(), ["body"], cache)
    assert {k: n for k, n in again.items() if k != "removed"} == {"load": 0, "quarantine": 0, "trash": 0, "staging": 0, "cache": 0}
    assert held(spark, root, "staging") == {} and held(spark, root, "load")["c"].body == "new" and held(spark, root, "load")["c"].error is None
    wrong = held(spark, root, "quarantine")["a"].error
    assert (wrong.stage, wrong.message, wrong.cause.message) == ("clean-job-json", "broken", "broken")
    assert held(spark, root, "trash")["b"].error.cause is None
    assert [r.cache_path for r in sinks.stored(spark, cache, spark.createDataFrame([], "cache_path string, content string")).collect()] == ["c2"]
    sinks.truncate(spark, f"{root}/load")
    assert held(spark, root, "load") == {}
    assert set(sinks.route(first.limit(0), root, now(), ["body"]).values()) == {0}


def test_put_leaves_equal_content_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("a", None), ("b", "x"), (None, "y")], "k string, v string")
    assert sinks.put(df, path, "k", buckets=2) == 2 and sinks.put(df, path, "k", buckets=2) == 0
    assert sinks.put(df.withColumn("v", F.lit("x")), path, "k", buckets=2) == 1
    assert sinks.drop(df.select("k"), path, "k", df, buckets=2) == 2 and sinks.drop(df.select("k"), path, "k", df, buckets=2) == 0 and sinks.stored(spark, path, df).count() == 0


def test_publish_and_cache(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "job_id string")
    held_ = spark.createDataFrame([("a",)], "job_id string")
    assert sinks.publish(rows, str(tmp_path / "p"), {"load": held_}) == 1 and sinks.publish(rows, str(tmp_path / "p"), {"load": held_}) == 0
    pages = spark.createDataFrame([("u", "x"), ("u", "x"), (None, "y")], "url string, html string")
    assert sinks.write_cache(pages, str(tmp_path / "c"), "url", "html") == 1


PAYLOADS = [('{"a":1}', [1]), ('﻿[{"a":1},{"a":2}]', [1, 2]), ('{"a":1}\n\n{"a":2}\r\n{"a":', [1, 2, None]), ('{\n "a": 3\n}', [3]), ('{\n "a": 3', [None]), ("", [None]), (None, [None]), ("[]", [])]


def test_records_of_files(spark):
    df = spark.createDataFrame([(k, p, 7) for k, (p, _) in enumerate(PAYLOADS)], "file_id int, payload string, extra int")
    got: dict = {k: [] for k in range(len(PAYLOADS))}
    for r in listings.file_records(df).orderBy("file_id", "rec_no").collect():
        got[r.file_id].append(None if r.body is None else json.loads(r.body)["a"])
    assert got == {k: want for k, (_, want) in enumerate(PAYLOADS)} and listings.file_records(df.limit(0)).count() == 0


def test_ends_in_any_form(spark):
    when = dt.datetime(2026, 1, 1)
    cases = {"2025-12-31T23:59:59Z": "trash", "2026-01-01T00:00:00Z": "trash", "2026-01-01T00:30:00+01:00": "trash", "2026-01-01 00:00:01": "advance", "2025-12-30": "trash", "31.12.2025": "advance", "soon": "advance", "": "advance", None: "quarantine"}
    df = spark.createDataFrame(list(enumerate(cases)), "k int, e string")
    got = [r[0] for r in df.orderBy("k").select(guards.expiration_guard(F.col("e"), F.lit(when))["action"]).collect()]
    assert got == list(cases.values())


def test_whole_flow_on_a_fixture(spark):
    page = "<html><body><main><h1>T</h1>" + "".join(f"<p>Paragraph {k} of an offer that is long enough to be kept.</p>" for k in range(5)) + "{}</main></body></html>"
    jji = {"guid": "1", "title": "T", "companyName": "C", "companyLogoThumbUrl": "l", "experienceLevel": "mid", "workplaceType": "remote", "employmentTypes": [], "publishedAt": "2025-12-01T00:00:00Z", "expiredAt": "2026-02-01T00:00:00Z"}
    bdj = {"id": "5", "url": "u", "position": "P", "city": "A", "remote": True, "employmentType": "contractor", "experienceLevel": "senior", "company": {"name": "N", "logo": {"url": "l"}}, "contractB2b": True, "contractEmployment": False, "contractOther": False, "denominatedSalaryLong": {"money": "1 - 2"}, "technologyTags": []}
    paid = {**bdj, "id": "6", "denominatedSalaryLong": {"money": "1 - 2", "currency": "PLN"}}
    state = '<p>Valid for</p><div><p>31.12.2025</p></div><script type="application/json">{"props":{"pageProps":{"data":{"job":{"publishedAt":"2025-11-01","endsAt":"2027-01-01"}}}}}</script>'
    files = [(1, "jji", None, json.dumps([jji, {**jji, "guid": "2", "publishedAt": None}])), (2, "bdj", "bdj-5", json.dumps(bdj)), (3, "bdj", "bdj-6", json.dumps(paid)), (4, "jji", "jji-9", json.dumps(jji)), (4, "jji", "jji-9", json.dumps(jji))]
    rows = [(k, s, j, "raw.job.json", p, dt.datetime(2025, 1, 1)) for k, s, j, p in files]
    rows += [(10 + k, j[:3], j, "raw.job.html", page.replace("{}", state if j == "bdj-6" else ""), dt.datetime(2025, 1, 2)) for k, j in enumerate(("jji-1", "jji-2", "bdj-5", "bdj-6"))]
    df = spark.createDataFrame(rows, "file_id bigint, source string, job_id string, artifact string, payload string, mtime timestamp")
    metas = spark.createDataFrame([(1, j, f"https://{j[:3]}.test/offer/{j}", f"cache/{j}", dt.datetime(2025, 1, 1)) for j in ("jji-1", "jji-2", "bdj-5", "bdj-6", "jji-9")], "meta_id bigint, job_id string, url string, cache_path string, scraped_at timestamp")
    jobs = pipeline.offers_from_files(df, metas)
    got = {r.job_id: r for r in pipeline.run(jobs, now(), least_quality=0.1).collect()}
    assert set(got) == {"jji-1", "jji-2", "bdj-5", "bdj-6", "jji-9"}
    assert {k: (r.decision.action, r.decision.guard) for k, r in got.items()} == {
        "jji-1": ("load", "quality"), "jji-2": ("quarantine", "meta"), "bdj-5": ("quarantine", "clean"), "bdj-6": ("trash", "expiration"), "jji-9": ("advance", "inputs")}
    assert got["bdj-6"].meta.published_at == "2025-11-01" and got["bdj-6"].meta.expires_at == "2025-12-31T00:00:00.000Z" and got["jji-1"].meta.canonical_url == "https://jji.test/offer/jji-1"
    assert got["bdj-5"].error == 'No entry at path "currency"' and got["jji-1"].combined.role.title == "T" and got["bdj-6"].html_json.app_json
    assert pipeline.run(pipeline.offers_from_files(df.limit(0), metas), now()).count() == 0


def test_small_rules(spark):
    one = lambda *c: list(spark.range(1).select(*c).first())
    lit = F.lit
    assert one(X.header_key(lit("  Last  Checked ")), X.offer_path(lit("https://b.com/companies/jobs/12-x?a=1#t")), X.offer_path(lit("https://b.com/companies/jobs/s/12-x")), X.offer_path(lit("https://b.com/jobs/12-x"))) == ["last_checked", "https://b.pl/companies/jobs/12-x", None, None]
    assert one(listings.advertising(lit("Żabka Polska S.A.")), listings.advertising(lit(None).cast("string"))) == [True, False]
    ends = lambda a, b, n: listings.cursor_ends(lit(a), lit(b).cast("int"), lit(n))
    assert one(ends(0, 100, 5), ends(0, None, 5), ends(100, 100, 5), ends(0, 10_000, 5), ends(0, 100, 0)) == [False, True, True, True, True]
    assert one(guards.answer_guard(lit(0.5))["action"], guards.answer_guard(lit(0.4))["action"], guards.answer_guard(lit(None).cast("double"))["message"]) == ["advance", "quarantine", "unreadable answer"]
    assert one(X.collapse_blank_lines(lit("a \r\n\n \n\t\n b\n\n\n"))) == ["a\n\nb\n\n"]
    assert H.page_end(H.parse("<div><p>Ważna do: </p><div><b>x</b><p> 1.2.2026 </p></div></div>")) == "1.2.2026" and H.page_end(H.parse("<p>Valid for</p><p>x</p>")) is None


@pytest.mark.parametrize("pages, want", [([(1, None, 5), (2, 3, 5), (3, 9, 5), (4, 9, 5)], [1, 2, 3]), ([(1, None, 5), (2, None, 0), (3, None, 5)], [1]), ([], [])])
def test_counted_pages(spark, pages, want):
    df = spark.createDataFrame(pages, "page int, total int, n int")
    assert sorted(r.page for r in listings.counted_pages(df, "page", "total", "n").collect()) == want
