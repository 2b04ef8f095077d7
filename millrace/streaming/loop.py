"""The offer flow as a stream: micro-batches over a growing folder, written idempotently.

A batch is written under its number, so that a batch that runs again after a failure
replaces its own output; content that is stored already is not written again."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import changed


def read_folder(spark: SparkSession, path: str, like: DataFrame, per_batch: int | None = None) -> DataFrame:
    """A stream of the parquet files at path (a folder, file or pattern), oldest first."""
    source = spark.readStream.schema(like.schema).option("latestFirst", False)
    if per_batch:
        source = source.option("maxFilesPerTrigger", per_batch)
    return source.parquet(path)


def run_available(stream: DataFrame, step: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, keys: list[str], payload: str) -> None:
    """Processes what is there and ends. Every batch writes only rows whose content differs
    from what target holds under their keys."""

    def write(batch: DataFrame, number: int) -> None:
        out = step(batch)
        spark = batch.sparkSession
        path = f"{target}/batch={number}"
        try:
            old = spark.read.parquet(target).where(F.col("batch") < number)
            out = changed(out, old, keys, payload)
        except Exception as e:  # noqa: BLE001  no output yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        out.write.mode("overwrite").parquet(path)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def pause(since_progress: float, least: float = 1.0, most: float = 180.0) -> float:
    """Seconds to wait before the next look: as long as nothing has happened, within bounds."""
    return max(least, min(most, since_progress))


def poll(once: Callable[[], bool], idle: float = 3600.0, forever: bool = False, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> int:
    """Calls once() until nothing has happened for ``idle`` seconds (or for ever); gives the
    number of calls. once() tells whether it made progress."""
    last, calls = clock(), 0
    while True:
        calls += 1
        if once():
            last = clock()
        waited = clock() - last
        if waited >= idle and not forever:
            return calls
        sleep(pause(waited))
