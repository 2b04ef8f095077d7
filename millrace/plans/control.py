"""Queries over the registry of sources and the controls of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry
from ..session import table

DAY = 86_400_000
NOW = 1_706_572_800_000  # 2024-01-30 in milliseconds, injected


def _registry(spark: SparkSession, d: str) -> DataFrame:
    """Users as sources: those with few errors are reliable, those with many are trash."""
    e = table(spark, d, "events").withColumn("ms", F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")))
    u = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("bad"), F.max("ms").alias("seen"))
    status = F.when(F.col("bad") * 100 < F.col("n") * 17, "reliable").when(F.col("bad") * 100 > F.col("n") * 25, "trash").otherwise("known")
    return u.select(F.col("user_id").cast("string").alias("key"), F.when(F.col("user_id") % 3 == 0, "a").alias("source"), status.alias("status"), (F.col("n") - F.col("bad")).alias("best_streak"), F.col("bad").alias("failures"), F.when(F.col("user_id") % 2 == 0, F.col("seen")).otherwise(F.col("seen") - 9 * DAY).alias("last_seen"), F.when(F.col("user_id") % 5 == 0, F.col("seen") - 1000).alias("last_used"), F.when(F.col("user_id") % 11 == 0, "someone").alias("leased_by"))


_REG = f"""WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS bad, epoch_us(max(ts)) // 1000 AS seen FROM events GROUP BY user_id),
r AS (SELECT user_id, user_id::VARCHAR AS key, CASE WHEN user_id % 3 = 0 THEN 'a' END AS source, CASE WHEN bad * 100 < n * 17 THEN 'reliable' WHEN bad * 100 > n * 25 THEN 'trash' ELSE 'known' END AS status, CASE WHEN user_id % 2 = 0 THEN seen ELSE seen - {9 * DAY} END AS last_seen, CASE WHEN user_id % 5 = 0 THEN seen - 1000 END AS last_used, CASE WHEN user_id % 11 = 0 THEN 'someone' END AS leased_by FROM u)"""


def registry_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The registry after customers were sighted under their numbers."""
    c = table(spark, d, "customer")
    seen = c.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("source"), (F.lit(NOW - 20 * DAY) + F.col("c_custkey") * 1000).alias("ts"))
    return registry.sighted(_registry(spark, d), seen).select("key", "source", "status", "last_seen")


def registry_stale(spark: SparkSession, d: str) -> DataFrame:
    """Entries that stay when stale ones leave."""
    return registry.evicted(_registry(spark, d), F.lit(NOW)).select("key", "status")


def registry_lease(spark: SparkSession, d: str) -> DataFrame:
    """Who is given which entry, by injected picks."""
    wants = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("consumer"), (F.col("n_nationkey") % 10 / 10.0).alias("pick"))
    return registry.leased(_registry(spark, d), wants, F.lit(NOW))


def select_sources(spark: SparkSession, d: str) -> DataFrame:
    """Offers of chosen sources, at most 20 of each."""
    o = registry.select_sources(table(spark, d, "offer").select("offer_id", "source").distinct(), "jji, nfj", ("jji", "nfj", "bdj", "ptc"))
    return registry.limit_per_source(o, 20, ["offer_id"])


def json_quality(spark: SparkSession, d: str) -> DataFrame:
    """Completeness of raw records of any shape."""
    f = table(spark, d, "raw_file").where("artifact = 'raw.job.json'").select("file_id", F.replace("payload", F.lit("\ufeff"), F.lit("")).alias("p")).distinct()
    return f.select("file_id", F.round(registry.json_quality(F.col("p")), 6).alias("quality"))


QUERIES = {f.__name__: f for f in (registry_upsert, registry_stale, registry_lease, select_sources, json_quality)}
SQL = {
    "registry_upsert": f"""{_REG}, s AS (SELECT c_custkey::VARCHAR AS key, c_mktsegment AS source, {NOW - 20 * DAY} + c_custkey * 1000 AS ts FROM customer)
SELECT coalesce(r.key, s.key) AS key, coalesce(r.source, s.source) AS source, coalesce(r.status, 'known') AS status, greatest(r.last_seen, s.ts) AS last_seen FROM r FULL JOIN s ON r.key = s.key""",
    "registry_stale": f"""{_REG} SELECT key, status FROM r WHERE status = 'reliable' OR {NOW} - greatest(coalesce(last_seen, 0), coalesce(last_used, 0)) < {7 * DAY}""",
    "registry_lease": f"""{_REG}, f AS (SELECT status, key, row_number() OVER (PARTITION BY status ORDER BY coalesce(last_used, -1), key) AS no FROM r WHERE (status = 'reliable' OR {NOW} - greatest(coalesce(last_seen, 0), coalesce(last_used, 0)) < {7 * DAY}) AND leased_by IS NULL AND status IN ('reliable', 'known')),
w AS (SELECT n_nationkey AS consumer, CASE WHEN n_nationkey % 10 / 10.0 < 0.7 THEN 'reliable' ELSE 'known' END AS status FROM nation), a AS (SELECT w.*, row_number() OVER (PARTITION BY status ORDER BY consumer) AS no FROM w),
g AS (SELECT a.consumer, a.status, f.key FROM a LEFT JOIN f USING (status, no)), l AS (SELECT status, key, row_number() OVER (PARTITION BY status ORDER BY no) AS no FROM f WHERE key NOT IN (SELECT key FROM g WHERE key IS NOT NULL)),
b AS (SELECT consumer, CASE WHEN status = 'reliable' THEN 'known' ELSE 'reliable' END AS status, row_number() OVER (PARTITION BY status ORDER BY consumer) AS no FROM g WHERE key IS NULL)
SELECT consumer::BIGINT AS consumer, key FROM g WHERE key IS NOT NULL UNION ALL SELECT b.consumer::BIGINT, l.key FROM b LEFT JOIN l USING (status, no)""",
    "select_sources": """SELECT offer_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY offer_id) AS n FROM (SELECT DISTINCT offer_id, source FROM offer WHERE source IN ('jji', 'nfj'))) WHERE n <= 20""",
}
