"""Queries that run as streams over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import guards
from ..session import shared_dir, table
from ..streaming import health, loop


def stream_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Pages through the content guard as a stream of what is there; repeated pages are
    written once."""
    base = f"{shared_dir(spark).rstrip('/')}/stream_{uuid.uuid4().hex[:10]}"
    pages = table(spark, d, "raw_page")
    stream = loop.read_folder(spark, f"{d}/raw_page.parque[t]", pages)
    step = lambda b: b.select("page_id", guards.content_guard(F.col("html"))["action"].alias("action")).distinct()
    loop.run_available(stream, step, f"{base}/out", f"{base}/checkpoint", ["page_id"], "action")
    return spark.read.parquet(f"{base}/out").select("page_id", "action").distinct()


def health_status(spark: SparkSession, d: str) -> DataFrame:
    """Health of every user as a source of events; errors are failures."""
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("ts"), "event_id", (F.col("event_type") != "error").alias("good"))
    return health.health_batch(e)


QUERIES = {f.__name__: f for f in (stream_pipeline, health_status)}
_FRESH = """{'g': G, 'n_good': 0::BIGINT, 'n_failed': 0::BIGINT, 'current': 0::BIGINT, 'best': 0::BIGINT, 'counted': 0::BIGINT, 'status': 'known'}"""
_GOOD = """{'g': x.g, 'n_good': a.n_good + 1, 'n_failed': a.n_failed, 'current': a.current + 1, 'best': greatest(a.best, a.current + 1), 'counted': 0::BIGINT, 'status': CASE WHEN greatest(a.best, a.current + 1) >= 10 THEN 'reliable' ELSE a.status END}"""
_BAD = """{'g': x.g, 'n_good': a.n_good, 'n_failed': a.n_failed + 1, 'current': 0::BIGINT, 'best': a.best, 'counted': CASE WHEN a.current > 0 THEN a.counted ELSE a.counted + 1 END, 'status': CASE WHEN a.current = 0 AND a.counted + 1 >= 3 THEN 'trash' ELSE a.status END}"""
SQL = {
    "health_status": f"""WITH s AS (SELECT user_id::VARCHAR AS key, list_reduce(list_prepend({_FRESH.replace("'g': G", "'g': true")}, list_transform(list(event_type <> 'error' ORDER BY ts, event_id), lambda g: {_FRESH.replace("'g': G", "'g': g")})), lambda a, x: CASE WHEN x.g THEN {_GOOD} ELSE {_BAD} END) AS r FROM events GROUP BY user_id)
SELECT key, r.n_good, r.n_failed, r.current, r.best, r.counted, r.status FROM s""",
    "stream_pipeline": """SELECT DISTINCT page_id, CASE WHEN contains(h, 'Application error: a client-side exception has occurred while loading justjoin.it') OR length(trim(h)) < 100 THEN 'remove' WHEN NOT regexp_matches(h, '(?i)<p[\\s>/]') THEN 'quarantine' ELSE 'advance' END AS action FROM (SELECT page_id, coalesce(html, '') AS h FROM raw_page)""",
}
