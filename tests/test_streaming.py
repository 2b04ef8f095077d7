from pyspark.sql import functions as F

from millrace.streaming import health, loop


def outcomes(text):
    s = health.fresh()
    for c in text:
        s = health.step(s, c == "+")
    return s


def test_health_rules():
    assert outcomes("+" * 10)["status"] == "reliable" and outcomes("+" * 9)["status"] == "known"
    assert outcomes("+" * 10 + "---")["status"] == "reliable" and outcomes("+" * 10 + "----")["status"] == "trash"
    assert outcomes("+" * 10 + "----+")["status"] == "reliable" and outcomes("--+--")["status"] == "known" and outcomes("---")["status"] == "trash"


def test_pause_and_poll():
    assert loop.pause(0) == 1 and loop.pause(50) == 50 and loop.pause(1e6) == 180
    now = [0.0]
    did = iter([True, False, False, False, False, False, False, False, False, False, False, False])
    calls = loop.poll(lambda: next(did), idle=10, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert 3 <= calls <= 8


def test_stream_writes_content_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    df.coalesce(1).write.parquet(src)
    go = lambda: loop.run_available(loop.read_folder(spark, src, df), lambda b: b, out, check, ["k"], "p")
    go()
    spark.createDataFrame([(2, "b"), (3, "c"), (1, "z")], "k int, p string").coalesce(1).write.mode("append").parquet(src)
    go()
    rows = sorted((r.k, r.p, r.batch) for r in spark.read.parquet(out).collect())
    assert rows == [(1, "a", 0), (1, "z", 1), (2, "b", 0), (3, "c", 1)]


def test_health_stream_equals_batch(spark, tmp_path):
    rows = [(f"k{i % 3}", i // 3, i, (i * 7) % 5 != 0) for i in range(90)]
    df = spark.createDataFrame(rows, "key string, ts bigint, event_id bigint, good boolean")
    want = {tuple(r) for r in health.health_batch(df).collect()}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = loop.read_folder(spark, str(tmp_path / "in"), df)
    q = health.health_stream(stream).writeStream.format("memory").queryName("health_out").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("health_out").collect()} == want
    assert spark.table("health_out").where(F.col("status") == "known").count() >= 0
