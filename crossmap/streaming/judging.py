"""Requests and answers of a judge as streams.

An open request waits in state for its answer. The first answer closes it; if none has come when event
time has passed the request's time by the timeout, it is closed without one, and its candidates are to be asked again one by
one. Answers to a closed request, late or double, are dropped. An answer that arrives before its request waits
for it. What leaves the stream is one row for each request, which the same functions parse as in a batch run.

The state store has to be RocksDB (`spark.sql.streaming.stateStore.providerClass`), and the checkpoint a shared folder.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from crossmap.operators import verdicts as V

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = ["framework_A", "framework_B", "batch_no"]
CLOSED = "framework_A STRING, framework_B STRING, batch_no BIGINT, n BIGINT, raw STRING, answered BOOLEAN"


class Waiting(StatefulProcessor):
    """Requests that wait for an answer, by batch."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.request = handle.getValueState("request", "n BIGINT, closed BOOLEAN")
        self.early = handle.getValueState("early", "raw STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows))
        asked, answers = found[found["n"].notna()], sorted(found["raw"].dropna())
        known = self.request.get() if self.request.exists() else None
        if known is not None and known[1]:
            return
        if known is None and len(asked):
            known = (int(asked["n"].iloc[0]), False)
            self.request.update(known)
            self.handle.registerTimer(int(asked["at"].iloc[0].timestamp() * 1000) + self.timeout_ms)
        if self.early.exists():
            answers = sorted([self.early.get()[0], *answers])
        if known is None:
            if answers:
                self.early.update((answers[0],))
        elif answers:
            yield self._closed(key, known[0], answers[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.request.get() if self.request.exists() else None
        if known is not None and not known[1]:
            yield self._closed(key, known[0], None)

    def _closed(self, key, n: int, raw: str | None) -> pd.DataFrame:
        self.request.update((n, True))
        self.early.clear()
        return pd.DataFrame([(*key, n, raw, raw is not None)], columns=[*BATCH, "n", "raw", "answered"])

    def close(self) -> None:
        pass


def closed_requests(requests: DataFrame, responses: DataFrame, timeout: str = "10 minutes", late: str = "0 seconds") -> DataFrame:
    """Stream of (framework_A, framework_B, batch_no, n, raw, answered) from streams of requests (…, n, at) and responses (…, raw, at)."""
    empty = F.lit(None)
    asked = requests.select(*BATCH, F.col("n").cast("bigint").alias("n"), empty.cast("string").alias("raw"), "at")
    answers = responses.select(*BATCH, empty.cast("bigint").alias("n"), "raw", "at")
    timeout_ms = int(pd.Timedelta(timeout).total_seconds() * 1000)
    both = asked.unionByName(answers).withWatermark("at", late)
    return both.groupBy(*BATCH).transformWithStateInPandas(Waiting(timeout_ms), CLOSED, "Append", "EventTime")


def parse_closed(closed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts of closed requests, and those whose answer is missing or invalid: what parse_responses gives in a batch run."""
    return V.parse_responses(closed.select(*BATCH, "n"), closed.filter("answered").select(*BATCH, "raw"))
