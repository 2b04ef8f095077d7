import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaners, compaction, guards, pipeline, state, timestamps, units

JJI = {"guid": "1", "slug": "s", "title": "T", "companyName": "C", "companyLogoThumbUrl": "l", "experienceLevel": "mid", "workplaceType": " Remote ", "multilocation": [{"city": "A"}], "employmentTypes": [{"type": "b2b", "from": 100.0, "to": None, "currency": "PLN", "unit": "Month"}], "requiredSkills": [{"name": "Go", "level": 3}, {"name": "C", "level": 2}], "niceToHaveSkills": ["go ", "x"], "publishedAt": "p", "expiredAt": "e"}
NFJ = {"id": "1", "url": "u", "name": "N", "title": "T", "logo": {"original": None}, "posted": 1744805170123, "seniority": ["Mid"], "technology": "Go", "tiles": {"values": [{"type": "requirement", "value": " go"}, {"type": "x", "value": "no"}]}, "location": {"places": [{"city": " A "}, {"province": "a"}, {"city": "B", "url": "b"}]}, "salary": {"min": 5, "currency": "PLN"}}
BDJ = {"id": "1", "url": "u", "position": "P", "city": "A", "remote": True, "employmentType": "Contractor", "experienceLevel": "senior", "company": {"name": "N", "logo": {"url": "l"}}, "contractB2b": True, "contractEmployment": None, "contractOther": False, "denominatedSalaryLong": {"money": "from 9 000", "currency": "PLN"}, "technologyTags": ["a", "A"]}


def cleaned(spark, f, record):
    df = spark.createDataFrame([(json.dumps(record) if not isinstance(record, str) else record,)], "j string").withColumn("v", F.try_parse_json("j"))
    return f(df).select("job", "error").first()


def test_jji(spark):
    job = cleaned(spark, cleaners.clean_jji, JJI).job
    assert job.salaryB2B["from"] == "100" and job.salaryB2B.unit == "month" and job.salaryB2B.to is None
    assert job.role.seniority == "regular" and job.workplace.isRemote and job.reqTechnology == ["Go"] and job.optTechnology == ["go", "x"]


@pytest.mark.parametrize("change, error", [({"title": None}, '"title" is not string'), ({"requiredSkills": [None]}, "level"), ({"requiredSkills": ["a", {"name": "b", "level": 1}]}, None), ({"employmentTypes": [{"type": "b2b", "from": "1", "to": 1, "currency": None, "unit": None}]}, "from"), ({"multilocation": "x"}, "multilocation")])
def test_jji_rules(spark, change, error):
    row = cleaned(spark, cleaners.clean_jji, {**JJI, **change})
    assert (row.error is None) if error is None else error in row.error
    assert (row.job is None) == (error is not None)


def test_jji_missing_keys(spark):
    short = {k: v for k, v in JJI.items() if k not in ("requiredSkills", "niceToHaveSkills", "multilocation", "experienceLevel")}
    row = cleaned(spark, cleaners.clean_jji, short)
    assert row.error is None and row.job.reqTechnology == [] and row.job.workplace.cities == []
    assert cleaned(spark, cleaners.clean_jji, "{broken").error == "unreadable record"


def test_nfj(spark):
    job = cleaned(spark, cleaners.clean_nfj, NFJ).job
    assert job.workplace.cities == ["A", "B"] and job.reqTechnology == ["go"] and job.employer.logo is None
    assert job.salaryCoE["from"] == job.salaryCoE.to == job.salaryB2B.to == "5" and job.salaryB2B.unit == "month"
    both = cleaned(spark, cleaners.clean_nfj, {**NFJ, "seniority": ["Senior", "Lead"], "salary": {"type": "b2b", "from": 1, "to": 2, "period": "h"}}).job
    assert both.role.seniority == "senior, lead" and both.salaryCoE["from"] is None and both.salaryB2B.unit == "hour"


def test_bdj(spark):
    job = cleaned(spark, cleaners.clean_bdj, BDJ).job
    assert job.role.scope == "full-time" and job.salaryCoE["from"] == " 9 000" and job.salaryB2B["from"] is None and job.reqTechnology == ["a"]
    fixed = cleaned(spark, lambda d: cleaners.clean_bdj(d, crossed=False), {**BDJ, "denominatedSalaryLong": {"money": "1 - 2", "currency": "PLN"}}).job
    assert (fixed.salaryB2B["from"], fixed.salaryB2B.to) == ("1", "2")
    assert cleaned(spark, cleaners.clean_bdj, {k: v for k, v in BDJ.items() if k != "contractOther"}).error == 'No entry at path "contractOther"'


def test_guards(spark):
    now = F.lit("2026-01-01").cast("timestamp")
    act = lambda d: spark.range(1).select(d["action"]).first()[0]
    assert act(guards.content_guard(F.lit(None).cast("string"))) == "remove"
    assert act(guards.content_guard(F.lit("x" * 200))) == "quarantine" and act(guards.content_guard(F.lit("<p>" + "x" * 200))) == "advance"
    assert act(guards.expiration_guard(F.lit("garbage"), now)) == "advance" and act(guards.expiration_guard(F.lit("2025-01-01T00:00:00.000Z"), now)) == "trash"
    assert act(guards.expiration_guard(F.lit(None).cast("string"), now)) == "quarantine"
    assert act(guards.duplicate_guard(F.lit("U"), F.lit("u"), F.array(F.lit("u")))) == "trash" and act(guards.duplicate_guard(F.lit("U"), F.lit("u"), F.array().cast("array<string>"))) == "advance"
    a, b = guards.decision("advance", "a", "m"), guards.decision("trash", "b", "m")
    assert act(guards.first_stop(a, b, a)) == "trash"
    with pytest.raises(ValueError):
        guards.routed(spark.range(1), "elsewhere")


def test_stage_order():
    s = lambda n, i, o: pipeline.Stage(n, i, o, lambda d: d)
    assert [x.name for x in pipeline.stage_order([s("c", ("b",), "c"), s("b", ("a",), "b")])] == ["b", "c"]
    with pytest.raises(ValueError):
        pipeline.stage_order([s("x", ("y",), "z"), s("w", ("z",), "y")])
    with pytest.raises(ValueError):
        pipeline.stage_order([s("x", (), "a"), s("x", (), "b")])


def test_state(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], "k string, p string")
    old = spark.createDataFrame([("a", "1"), ("b", "9"), (None, "3")], "k string, p string")
    assert [r.k for r in state.changed(new, old, ["k"], "p").collect()] == ["b"]
    area = spark.createDataFrame([("a",), (None,)], "job_id string")
    rows = spark.createDataFrame([("a",), ("c",)], "job_id string")
    assert {r.job_id: r.skipped for r in state.unpublished(rows, {"staging": area, "trash": area}).collect()} == {"a": "staging", "c": None}


STAMPS = [
    ("2025-03-30T02:30:00", "jji", "2025-03-30T01:30:00+00:00"), ("2025-10-26 02:30", "jji", "2025-10-26T00:30:00+00:00"), ("26 października 2025 r.", "jji", "2025-10-25T22:00:00+00:00"), ("04/05/2025 1:06 PM", "ptc", "2025-04-05T17:06:00+00:00"),
    ("04/05/25", "bdj", "2025-05-03T23:00:00+00:00"), ("1744805170123456", "bdj", "2025-04-16T12:06:10.123456+00:00"), ("2025-08-23T21:03:41.570518999Z", "ptc", "2025-08-23T21:03:41.570518+00:00"), ("Sat, 14 Jun 2025 08:41:46 +0200", "bdj", "2025-06-14T06:41:46+00:00"),
    ("2025-07-01T00:00:00[America/New_York]", "bdj", "2025-07-01T04:00:00+00:00"), ("2025-01-20 10:18:52 CET", "ptc", "2025-01-20T09:18:52+00:00"), ("20250117T025910Z", "jji", "2025-01-17T02:59:10+00:00"), ("Mar 9, 2025 12:36 AM", "ptc", "2025-03-09T05:36:00+00:00"),
    ("30.03.2025 godz. 2.21", "jji", "2025-03-30T01:21:00+00:00"), ("31.02.2026", "jji", None), ("30/30/2025", "ptc", None), ("soon", "jji", None), ("", "jji", None), (None, "jji", None), ("0000-00-00 00:00:00", "jji", None), ("x" * 100000, "jji", None), ("2025-01-01 10:00:00 Nowhere/Land", "jji", None),
]
BOARDS = [("jji", "Europe/Warsaw", "DMY"), ("bdj", "Europe/London", "DMY"), ("ptc", "America/New_York", "MDY")]


def test_timestamps(spark):
    rows = [(k, s, v, 1) for k, (v, s, _) in enumerate(STAMPS)] + [(0, "jji", STAMPS[0][0], 1)]
    df = spark.createDataFrame(rows, "meta_id bigint, source string, published_at string, value int")
    boards = spark.createDataFrame(BOARDS, "source string, zone_name string, date_order string")
    got = {r.meta_id: r.utc_us for r in timestamps.normalise(df, boards, "meta_id", ["published_at"]).collect()}
    want = {k: None if w is None else int(dt.datetime.fromisoformat(w).timestamp() * 1000000) for k, (v, _, w) in enumerate(STAMPS) if v is not None}
    assert {k: None if v is None else v for k, v in got.items()} == pytest.approx(want)
    assert timestamps.normalise(df.limit(0), boards, "meta_id", ["published_at"]).count() == 0
    alone = timestamps.normalise(df.withColumn("source", F.lit(None).cast("string")), boards, "meta_id", ["published_at"])
    assert alone.where("utc_us is not null").count() > 5


def test_mixture_learns_an_undeclared_order():
    counts = pd.DataFrame({"form": ["num_either", "num_month", "iso"], "n": [100, 40, 50], "declared": [None] * 3})
    fitted = timestamps.fit_mixture(counts).set_index("form")
    assert fitted.reading["num_either"] == "month_first" and fitted.posterior["num_either"] > 0.9
    even = timestamps.fit_mixture(pd.DataFrame({"form": ["num_either"], "n": [10], "declared": [None]}))
    assert abs(even.posterior[0] - 0.5) < 1e-9


PAY = [
    ("10-15k PLN/month", None, None, None, None, (10000, 15000)), ("8,500", "11,500 PLN netto a month", None, None, None, (8500, 11500)), ("£230 + VAT/MD", None, None, None, None, (24295, None)), (None, "up to 3,5 tys. zł", None, "month", None, (None, 3500)),
    ("1 240 000", "1 290 000", "CZK", None, "Year", (17773, 18490)), ("100", None, "EUR", "hr", "month", (71736, None)), ("ab 10 eur an hour", None, None, "month", None, (7174, None)), ("competitive", None, "PLN", "month", None, (None, None)), ("100", None, "PLN", None, None, (None, None)),
    (None, None, "PLN", "month", None, (None, None)), ("", "", "PLN", "month", None, (None, None)), ("30,50", None, "zł", "h", None, (5124, None)), ("70 Fr. per man-day", None, None, None, None, (6630, None)), ("9" * 5000, None, "PLN", "month", None, None),
]


def test_units(spark):
    fx = spark.createDataFrame([("PLN", 1.0), ("EUR", 4.27), ("GBP", 5.03), ("CZK", 0.172), ("CHF", 4.51)], "currency string, r double").select("currency", F.col("r").cast("decimal(12,4)").alias("pln_per_unit"))
    um = spark.createDataFrame([("hour", 168, 1), ("day", 21, 1), ("week", 13, 3), ("month", 1, 1), ("year", 1, 12)], "unit_name string, month_mult int, month_div int")
    rows = [(k, *p[:5]) for k, p in enumerate(PAY)]
    df = spark.createDataFrame(rows, "id int, low string, high string, currency_text string, unit_text string, period_text string")
    got = {r.id: (r.lower, r.upper) for r in units.resolve_amounts(df, fx, um).collect()}
    assert {k: got[k] for k, p in enumerate(PAY) if p[5]} == {k: p[5] for k, p in enumerate(PAY) if p[5]}
    assert units.resolve_amounts(df.limit(0), fx, um).count() == 0


def test_guessed_units(spark):
    um = spark.createDataFrame([("hour", 168, 1), ("month", 1, 1), ("year", 1, 12)], "unit_name string, month_mult int, month_div int")
    rows = [(1, "coe", 10000, 12000, "PLN", "month", 1200000, 10000), (1, "b2b", None, None, "PLN", None, 8000, 10000), (2, "coe", None, None, "PLN", None, 8000, 10000), (3, "coe", 1000, 1000, "PLN", "month", 100000, 10000), (3, "b2b", None, None, "PLN", None, 350000, 10000), (4, "b2b", None, None, None, None, 1, None)]
    pay = spark.createDataFrame(rows, "offer_id bigint, contract_kind string, pln_month_from bigint, pln_month_to bigint, currency string, unit string, cents bigint, rate bigint")
    got = {r.offer_id: (r.guess, r.guess_unique) for r in units.guessed_units(pay, um).collect()}
    assert got == {1: ("hour", True), 2: (None, False), 3: ("year", False)}


FILES = [
    (1, "s", "j1", "raw.job.json", '{"a": 1, "b": [1.0]}'), (2, "s", "j1", "raw.job.json", '﻿{"b":[1],"a":1}\n'), (3, "s", None, "raw.job.json", '[{"a":1,"b":[1]},\n{"c":2}]'), (4, "s", None, "raw.job.json", '{"c": 2}\n{"d": 3}\n{"e"'), (5, "t", "j1", "raw.job.json", '{"a":1,"b":[1]}'),
    (6, "s", "j1", "raw.job.html", "<html> x\n y</html>\n"), (7, "s", "j1", "raw.job.html", "﻿<html>\tx y</html>"), (8, "s", "j2", "raw.job.html", "<html> x y</html>"), (9, "s", "j2", "raw.job.html", "<html> x"), (10, "s", "j2", "raw.job.json", None), (11, "s", None, None, None), (12, None, None, "raw.job.json", "[]"), (1, "s", "j1", "raw.job.json", '{"a": 1, "b": [1.0]}'),
]


def consolidated(spark, df, folder):
    df.repartition(5).write.parquet(f"{folder}/files")
    told = compaction.consolidate(spark, f"{folder}/files", f"{folder}/out")
    return told, spark.read.parquet(f"{folder}/files"), spark.read.parquet(f"{folder}/out")


def test_consolidation_keeps_each_record_once(spark, tmp_path):
    half = (20, "s", "j9", "raw.job.json", '{"x": "\\ud83d", "é": 1}')
    df = spark.createDataFrame([*FILES, FILES[0], FILES[5], half, (21, *half[1:])], "file_id bigint, source string, job_id string, artifact string, payload string").withColumn("key", F.lit(1)).withColumn("record", F.lit("x"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    told, files, out = consolidated(spark, df, tmp_path)
    kept = out.collect()
    assert told["records"] == len(kept) == len({r.key for r in kept}) == 7 and len(list((tmp_path / "out").glob("*.parquet"))) == 1
    assert sorted(r.file_id for r in compaction.redundant_files(files, out).collect()) == [2, 7, 9, 10, 11, 12, 21]
    assert {r.record for r in kept if r.scope == "j|s|"} >= {'{"a":1,"b":[1]}', '{"c":2}', '{"d":3}'}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before and sorted(p.name for p in tmp_path.iterdir()) == ["files", "out"]
    with pytest.raises(FileExistsError):
        compaction.consolidate(spark, str(tmp_path / "files"), str(tmp_path / "out"))


def test_consolidation_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "file_id bigint, source string, job_id string, artifact string, payload string")
    told, files, out = consolidated(spark, df, tmp_path)
    assert told["records"] == 0 and compaction.redundant_files(files, spark.read.schema(compaction.RECORD).parquet(str(tmp_path / "out"))).count() == 0


def test_a_bad_copy_is_not_published(spark, tmp_path, monkeypatch):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    monkeypatch.setattr(compaction, "_summary", lambda df, n=iter(range(9)): (next(n), 0))
    with pytest.raises(RuntimeError):
        compaction.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [p.name for p in tmp_path.iterdir()] == ["in"]


def test_compaction(spark, tmp_path):
    many = str(tmp_path / "many")
    spark.range(1000).withColumn("t", F.col("id").cast("string")).repartition(40).write.parquet(many)
    told = compaction.compact(spark, many, str(tmp_path / "few"), target_bytes=1 << 20)
    few = spark.read.parquet(str(tmp_path / "few"))
    assert told["rows"] == few.count() == 1000 and len(list((tmp_path / "few").glob("*.parquet"))) <= 2
    with pytest.raises(FileExistsError):
        compaction.compact(spark, many, str(tmp_path / "few"))
