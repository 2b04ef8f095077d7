import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import registry as R


def entries(spark, rows):
    return spark.createDataFrame(rows, R.ENTRY)


def test_sightings(spark):
    reg = entries(spark, [("a", None, "reliable", 12, 0, 5, 9, None), ("b", "x", "trash", 0, 3, 50, None, None)])
    seen = spark.createDataFrame([("a", "s2", 7), ("a", "s1", 7), ("b", "y", 10), ("c", "z", 1), (None, "n", 1)], "key string, source string, ts bigint")
    got = {r.key: (r.source, r.status, r.last_seen) for r in R.sighted(reg, seen).collect()}
    assert got == {"a": ("s1", "reliable", 7), "b": ("x", "trash", 50), "c": ("z", "known", 1)}
    assert R.sighted(reg.limit(0), seen.limit(0)).count() == 0


def test_leases(spark):
    now = F.lit(1000)
    reg = entries(spark, [("r1", None, "reliable", 10, 0, 900, 5, None), ("r2", None, "reliable", 10, 0, 900, None, None), ("k1", None, "known", 0, 0, 900, None, None), ("t", None, "trash", 0, 3, 900, None, None), ("l", None, "known", 0, 0, 900, None, "me")])
    ask = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.3), (4, 0.9), (5, 0.9)], "consumer bigint, pick double")
    assert {r.consumer: r.key for r in R.leased(reg, ask, now).collect()} == {1: "r2", 2: "r1", 3: None, 4: "k1", 5: None}
    assert R.leased(reg.limit(0), ask, now).where("key is not null").count() == 0 and R.leased(reg, ask.limit(0), now).count() == 0


def test_snapshot(spark, tmp_path):
    reg = entries(spark, [("a", None, "known", 0, 0, 1, None, None)])
    R.save(reg, str(tmp_path / "s"))
    assert R.load(spark, str(tmp_path / "s")).collect() == reg.collect()
    (tmp_path / "bad").write_text('{"key": "a", "version": 2}\n')
    with pytest.raises(Exception, match="another version"):
        R.load(spark, str(tmp_path / "bad")).collect()


def test_controls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "source string, n int")
    assert R.select_sources(df, " all", ("a", "b")).count() == R.select_sources(df, None, ("a",)).count() == 4
    assert R.select_sources(df, "a", ("a", "b")).count() == 2 and R.limit_per_source(df, 1, ["n"]).count() == 3
    with pytest.raises(ValueError):
        R.select_sources(df, "a,zzz", ("a", "b"))
    with pytest.raises(ValueError):
        R.limit_per_source(df, -1, ["n"])
    out, seen = R.counted(df, "run", big=F.col("n") > 2)
    assert out.count() == 4 and seen.get["big"] == 2


def test_paced_client():
    now, slept = [0.0], []
    call = R.paced(lambda x: x.upper(), 60, clock=lambda: now[0], sleep=slept.append)
    assert [call("a"), call("b")] == ["A", "B"] and slept == [60.0]


def test_json_quality(spark):
    texts = [json.dumps({"a": None, "b": {"c": "", "d": 1}, "e": [], "f": [None, "x"]}), "{}", "nope", None, "[" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.q for r in df.select("i", R.json_quality(F.col("t")).alias("q")).collect()}
    assert abs(got[0] - 4 / 8) < 1e-9 and got[1] == 0 and got[2] is None and got[3] is None and got[4] is None
