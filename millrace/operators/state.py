"""State of rows between runs: publishing, content-aware writes, moves between areas.

All are joins on narrow keys; contents are compared by hash, never shuffled whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AREAS = ("staging", "trash", "quarantine", "load")


def unpublished(rows: DataFrame, areas: dict[str, DataFrame], key: str = "job_id") -> DataFrame:
    """Rows with ``skipped``: the first area (in order) that holds their key, null for new
    ones. Keys of an area are made unique before the join."""
    known = reduce(DataFrame.unionByName, [d.select(key).distinct().withColumn("_area", F.lit(n)).withColumn("_no", F.lit(k)) for k, (n, d) in enumerate(areas.items())])
    first = known.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by("_area", "_no").alias("skipped"))
    return rows.join(first, key, "left")


def changed(new: DataFrame, old: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Rows of new whose content old doesn't hold under the same key: what a content-aware
    write has to write."""
    h = F.sha2(F.coalesce(F.col(payload), F.lit("")), 256)
    mine, theirs = new.withColumn("_h", h), old.select(*keys, h.alias("_h")).distinct()
    same = reduce(lambda a, b: a & b, [mine[k].eqNullSafe(theirs[k]) for k in [*keys, "_h"]])
    return mine.join(theirs, same, "left_anti").drop("_h")


def versions(files: DataFrame, keys: list[str], order: str, payload: str) -> DataFrame:
    """Marks rows as ``written`` that differ from the row before them under the same key."""
    w = Window.partitionBy(*keys).orderBy(order)
    h = F.md5(F.coalesce(payload, F.lit("")))
    return files.withColumn("_h", h).withColumn("written", ~F.coalesce(F.lag("_h").over(w) == F.col("_h"), F.lit(False))).drop("_h")


def repopulated(areas: dict[str, DataFrame], key: str = "job_id") -> DataFrame:
    """All rows of the areas back in one; a key that came before (in the areas' order, then
    by key) gets the suffix __from_<area>_<n>."""
    both = reduce(DataFrame.unionByName, [d.select(key).distinct().withColumn("area", F.lit(n)).withColumn("_no", F.lit(k)) for k, (n, d) in enumerate(areas.items())])
    n = F.row_number().over(Window.partitionBy(key).orderBy("_no"))
    return both.withColumn("_n", n).select(F.when(F.col("_n") == 1, F.col(key)).otherwise(F.concat(F.col(key), F.lit("__from_"), F.col("area"), F.lit("_"), F.col("_n").cast("string"))).alias(key), "area")


def first_wins(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def streaks(events: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """Per key: successes, failures, the longest run of successes, and a status. Ten in a row
    make a key reliable; three failures without a success between, beyond the one that broke
    a run, make it trash, a later run of successes keeps what was best."""
    w = Window.partitionBy(key).orderBy(*order)
    bad = failed.cast("int")
    marked = events.select(key, *order, bad.alias("_bad")).withColumn("_run", F.sum("_bad").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy(key, "_run").agg(F.sum(1 - F.col("_bad")).alias("good"), F.max("_bad").alias("_b"))
    return runs.groupBy(key).agg(F.sum("good").alias("n_good"), F.sum("_b").alias("n_failed"), F.max("good").alias("best_streak"), F.max_by("good", "_run").alias("last_streak"))


def recent(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The k newest rows of each key: what a cache of that size still holds."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
