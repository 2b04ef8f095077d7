"""A registry of keyed sources (such as proxies): sightings, leases, staleness, snapshots;
and the controls around runs: which sources, how many rows, how fast."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: columns of a registry entry
ENTRY = "key string, source string, status string, best_streak bigint, failures bigint, last_seen bigint, last_used bigint, leased_by string"
VERSION = 1


def sighted(registry: DataFrame, seen: DataFrame) -> DataFrame:
    """The registry after a list of sightings (key, source, ts): known entries get the later
    time and a source if they had none, new ones start as 'known'. Several sightings of a
    key in one list count as one, the latest; of equal times the smallest source."""
    new = seen.where("key is not null").groupBy("key").agg(F.max("ts").alias("_ts"), F.min_by("source", F.struct(-F.col("ts"), "source")).alias("_source"))
    both = registry.join(new, "key", "full_outer")
    return both.select(
        "key", F.coalesce("source", "_source").alias("source"), F.coalesce("status", F.lit("known")).alias("status"), F.coalesce("best_streak", F.lit(0)).cast("bigint").alias("best_streak"), F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        F.greatest("last_seen", "_ts").alias("last_seen"), "last_used", "leased_by")


def stale(now: Column, seen: Column, used: Column, days: int = 7) -> Column:
    """Whether the last sign of an entry is at least so many days (of milliseconds) old."""
    return (now - F.greatest(F.coalesce(seen, F.lit(0)), F.coalesce(used, F.lit(0)))) >= days * 86_400_000


def evicted(registry: DataFrame, now: Column) -> DataFrame:
    """Without stale entries; reliable ones stay."""
    return registry.where((F.col("status") == "reliable") | ~stale(now, F.col("last_seen"), F.col("last_used")))


def leased(registry: DataFrame, wants: DataFrame, now: Column, prefer: float = 0.7) -> DataFrame:
    """(consumer, key): free entries handed to consumers (consumer, pick), where ``pick`` is an
    injected random number: under ``prefer`` a reliable entry is wanted, else a known one.

    Each queue is in the order of last use (never used first, then by key), consumers in
    theirs; nobody gets an entry twice and trash and stale ones are never given. Who finds
    the wanted queue empty takes from the other, the rest get none. The number of a row in
    its queue is counted per partition of the sorted queue, so no queue is in one task."""
    free = evicted(registry, now).where("leased_by is null and status in ('reliable', 'known')")
    queue = numbered(free.select("status", "key", F.coalesce("last_used", F.lit(-1)).alias("o")), "status", ["o", "key"])
    asks = wants.withColumn("status", F.when(F.col("pick") < prefer, "reliable").otherwise("known"))
    first = numbered(asks.select("status", "consumer"), "status", ["consumer"]).join(queue.select("status", "no", "key"), ["status", "no"], "left")
    given = first.where("key is not null").select("consumer", "key")
    rest = first.where("key is null").select("consumer", F.when(F.col("status") == "reliable", "known").otherwise("reliable").alias("status"))
    left = numbered(queue.join(given.select("key"), "key", "left_anti").select("status", "key", "o"), "status", ["o", "key"])
    second = numbered(rest, "status", ["consumer"]).join(left.select("status", "no", "key"), ["status", "no"], "left").select("consumer", "key")
    return given.unionByName(second)


def numbered(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Rows numbered from 1 within ``by`` in an order, without one task per group: sorted by
    range, counted per partition, and offset by the counts before."""
    sorted_ = rows.repartitionByRange(*[F.col(c) for c in (by, *order)]).sortWithinPartitions(by, *order).withColumn("_part", F.spark_partition_id())
    w = Window.partitionBy(by, "_part").orderBy(*order)
    own = sorted_.withColumn("_k", F.row_number().over(w))
    size = sorted_.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = size.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return own.join(before, [by, "_part"]).withColumn("no", F.col("_k") + F.col("_before")).drop("_part", "_k", "_before")


def save(registry: DataFrame, path: str) -> None:
    """A snapshot with its version in every row."""
    registry.withColumn("version", F.lit(VERSION)).write.mode("overwrite").json(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot; rows that aren't json or of another version are an error."""
    rows = spark.read.schema(ENTRY + ", version int").option("mode", "FAILFAST").json(path)
    return rows.where(F.assert_true(F.col("version") == VERSION, "registry snapshot of another version").isNull()).drop("version")


def select_sources(rows: DataFrame, only: str | None, known: tuple[str, ...]) -> DataFrame:
    """Rows of the sources named in a comma list; blank or 'all' means all, an unknown name is
    an error. A plain predicate, so that partitions and row groups are pruned."""
    names = [x.strip() for x in (only or "").split(",") if x.strip()]
    if not names or names == ["all"]:
        return rows
    wrong = sorted(set(names) - set(known))
    if wrong:
        raise ValueError(f"unknown sources: {', '.join(wrong)}")
    return rows.where(F.col("source").isin(names))


def limit_per_source(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """At most n rows of each source, the first in an order."""
    if n < 0:
        raise ValueError("a limit can't be negative")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def counted(rows: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Rows with counters taken on the way; read them from the observation after an action."""
    seen = Observation(name)
    return rows.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in counters.items()]), seen


def paced(call: Callable[[str], str], least: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """A client that is called at most once in so many seconds."""
    last: list[float] = []

    def run(x: str) -> str:
        if last and clock() - last[0] < least:
            sleep(least - (clock() - last[0]))
        last[:] = [clock()]
        return call(x)

    return run


def nodes(value) -> Iterator[tuple[object, bool]]:
    """All nodes of a json value below its root, with whether they hold data."""
    todo = [value]
    while todo:
        here = todo.pop()
        below = list(here.values()) if isinstance(here, dict) else here if isinstance(here, list) else []
        for x in below:
            yield x, not (x is None or x == "" or x == [])
            todo.append(x)


def json_quality(text: Column) -> Column:
    """Share of nodes with data of any json text; 0 where nothing has, null where it is no
    json. For records of a fixed schema use ``schema.quality``, which needs no Python."""

    def measure(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            try:
                good = [ok for _, ok in nodes(json.loads(t))]
                out.append(sum(good) / len(good) if good else 0.0)
            except (TypeError, ValueError, RecursionError):
                out.append(None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(measure, "double")(text)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """The union of parts by name; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
