"""Health of keyed sources as state over a stream of outcomes.

Per key: the running and the best streak of successes, failures since the last success,
and a status. Ten successes in a row make a key reliable; a failure first breaks a streak,
then counts; three that count make the key trash; one success promotes again a key whose
best streak was long enough."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STREAK, FAILURES = 10, 3
STATE = "n_good bigint, n_failed bigint, current bigint, best bigint, counted bigint, status string"
OUTPUT = "key string, " + STATE


def step(s: dict, good: bool) -> dict:
    """The state after one outcome."""
    s = dict(s)
    if good:
        s["n_good"] += 1
        s["current"] += 1
        s["counted"] = 0
        s["best"] = max(s["best"], s["current"])
        if s["best"] >= STREAK:
            s["status"] = "reliable"
    else:
        s["n_failed"] += 1
        if s["current"] > 0:
            s["current"] = 0
        else:
            s["counted"] += 1
            if s["counted"] >= FAILURES:
                s["status"] = "trash"
    return s


def fresh() -> dict:
    return {"n_good": 0, "n_failed": 0, "current": 0, "best": 0, "counted": 0, "status": "known"}


class Health(StatefulProcessor):
    """Keeps one state per key; rows of a batch are taken in the order of (ts, id)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("health", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s = dict(zip(fresh(), self.state.get())) if self.state.exists() else fresh()
        pdf = pd.concat(list(rows)).sort_values(["ts", "event_id"], kind="stable")
        for good in pdf["good"]:
            s = step(s, bool(good))
        self.state.update(tuple(s.values()))
        yield pd.DataFrame([{"key": key[0], **s}])

    def close(self) -> None:
        pass


def health_stream(outcomes: DataFrame) -> DataFrame:
    """(key, state..) after each batch of a stream of (key, ts, event_id, good). Needs the
    RocksDB state store."""
    return outcomes.groupBy("key").transformWithStateInPandas(Health(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")


def health_batch(outcomes: DataFrame) -> DataFrame:
    """The same over a table: a key's outcomes are sorted within its group and folded."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        s = fresh()
        for good in pdf.sort_values(["ts", "event_id"], kind="stable")["good"]:
            s = step(s, bool(good))
        return pd.DataFrame([{"key": pdf["key"].iloc[0], **s}])

    return outcomes.groupBy("key").applyInPandas(fold, OUTPUT)
