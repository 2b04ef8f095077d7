"""Where rows end: areas of jobs, records of errors, the cache. All writes are idempotent.

A keyed store is a folder of parquet, one partition per bucket of the key's hash. A write
compares contents first and rewrites only the buckets in which something differs, from a
checkpoint, so that a bucket is never read while it is replaced; a repeated write finds
nothing to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import key_path
from ..session import cut
from .pipeline import STAGES
from .state import unpublished

#: areas by the action that leads there; removed rows have none
AREA = {"load": "load", "quarantine": "quarantine", "trash": "trash", "advance": "staging"}


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What a store holds, in the columns of ``like``; nothing where it was never written."""
    if not _there(spark, path):
        return like.limit(0)
    return spark.read.schema(like.withColumn("bucket", F.lit(0)).schema).parquet(path).select(*like.columns)


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _replace(df: DataFrame, path: str) -> None:
    # one file per bucket; only buckets that are in df are replaced
    df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def put(rows: DataFrame, path: str, key: str, buckets: int = 16) -> int:
    """Inserts or replaces rows by key (unique, not null) and gives the number of those that were
    new or differed. Equal content is not written again."""
    spark = rows.sparkSession
    new = cut(_bucketed(rows.where(F.col(key).isNotNull()), key, buckets))
    old = _bucketed(stored(spark, path, rows), key, buckets)
    content = F.xxhash64(F.to_json(F.struct(*[c for c in rows.columns]), {"ignoreNullFields": "false"}))
    fresh = cut(new.withColumn("_h", content).join(old.select(key, content.alias("_h")), [key, "_h"], "left_anti").drop("_h"))
    n = fresh.count()
    if n:
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most as many as there are buckets
        kept = old.where(F.col("bucket").isin(touched)).join(fresh.select(key), key, "left_anti")
        _replace(cut(kept.select(*fresh.columns).unionByName(fresh)), path)
    return n


def drop(keys: DataFrame, path: str, key: str, like: DataFrame, buckets: int = 16) -> int:
    """Removes the rows of these keys and gives their number; missing ones are no error."""
    spark = keys.sparkSession
    old = _bucketed(stored(spark, path, like), key, buckets)
    gone = cut(old.join(keys.select(key).distinct(), key, "left_semi").select(key, "bucket"))
    n = gone.count()
    if n:
        touched = [r.bucket for r in gone.select("bucket").distinct().collect()]
        left = cut(old.where(F.col("bucket").isin(touched)).join(gone.select(key), key, "left_anti"))
        _replace(left, path)
        for b in set(touched) - {r.bucket for r in left.select("bucket").distinct().collect()}:
            truncate(spark, f"{path}/bucket={b}")
    return n


def truncate(spark: SparkSession, path: str) -> None:
    """Empties a store; a missing one is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def error_record(now: Column) -> Column:
    """What is kept beside a job that was quarantined or trashed: stage, guard, message, time and
    the cause below it (the rule of the cleaner that broke, if one did)."""
    stages = F.create_map(*[F.lit(x) for k, v in STAGES.items() for x in (k, v)])
    cause = F.when(F.col("decision.guard").isin("clean", "meta"), F.struct(F.lit("rule").alias("name"), F.col("decision.message").alias("message")))
    stopped = F.col("decision.action").isin("quarantine", "trash")
    return F.when(stopped, F.struct(F.element_at(stages, F.col("decision.guard")).alias("stage"), F.col("decision.guard").alias("name"), F.col("decision.message").alias("message"), now.alias("timestamp"), cause.alias("cause")))


def route(done: DataFrame, root: str, now: Column, payload: list[str], cache: str | None = None, buckets: int = 16) -> dict[str, int]:
    """Moves decided jobs (job_id, decision, cache_path, ..) to their areas below root, and gives
    how many rows each write changed.

    A job is in one area: it is put into the new one before it leaves the others, so that a
    run that is lost half way loses none. Jobs that wait stay in staging. Removed jobs leave
    all areas, and their page leaves the cache (by cache_path). Quarantined and trashed ones
    bear their error."""
    spark = done.sparkSession
    rows = cut(done.select("job_id", *payload, error_record(now).alias("error"), F.col("decision.action").alias("action"), *(["cache_path"] if cache else [])))
    out = {}
    for action, area in AREA.items():
        here = rows.where(F.col("action") == action).select("job_id", *payload, "error")
        out[area] = put(here, f"{root}/{area}", "job_id", buckets)
    gone = rows.where("action = 'remove'")
    for area in AREA.values():
        # whatever a job's area is now, it is in no other
        elsewhere = rows.where(F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in AREA.items() for x in kv]), F.col("action")), F.lit("")) != area)
        drop(elsewhere.select("job_id"), f"{root}/{area}", "job_id", rows.select("job_id", *payload, "error"), buckets)
    out["removed"] = gone.count()
    if cache:
        out["cache"] = drop(gone.where("cache_path is not null").select("cache_path"), cache, "cache_path", spark.createDataFrame([], "cache_path string, content string"), buckets)
    return out


def publish(rows: DataFrame, root: str, areas: dict[str, DataFrame], key: str = "job_id") -> int:
    """Writes to staging the rows whose key no area holds yet."""
    fresh = unpublished(rows, areas, key).where("skipped is null").drop("skipped")
    return put(fresh, f"{root}/staging", key)


def write_cache(rows: DataFrame, path: str, key: str, content: str) -> int:
    """Keeps contents by key, under the path that the key's hash gives."""
    keyed = rows.where(F.col(key).isNotNull()).groupBy(F.md5(key).alias("cache_key")).agg(F.max(content).alias("content"))
    return put(keyed.select("cache_key", key_path(F.col("cache_key")).alias("cache_path"), "content"), path, "cache_key")
