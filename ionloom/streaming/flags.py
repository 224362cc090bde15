"""Flags that expire: keyed state with a time to live, renewed by every sign of life."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
EVENTS = "key string, kind string"
ANSWERS = "key string, kind string, alive boolean"
SET, READ, CLEAR = "set", "read", "clear"


class ExpiringFlag(StatefulProcessor):
    """One flag a key.  ``set`` raises it, ``read`` asks for it, ``clear`` takes it down; set, and read of a raised flag, start its time anew.

    The state store drops a flag that had no sign of life for ``idle_ms``; a read of a dropped flag answers no and doesn't raise it.  The events
    of a batch count in the order set, read, clear, as a batch has no order of its own; other kinds and null keys are left out.
    """

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.raised = handle.getValueState("raised", "n long", self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kinds = pd.concat([r["kind"] for r in rows], ignore_index=True)
        alive = self.raised.exists()
        for kind in (SET, READ, CLEAR):
            n = int((kinds == kind).sum())
            if not n:
                continue
            if kind == CLEAR:
                self.raised.clear()
                alive = False
            elif kind == SET or alive:
                self.raised.update(((self.raised.get() or (0,))[0] + n,) if alive else (n,))
                alive = True
            yield pd.DataFrame({"key": [key[0]], "kind": [kind], "alive": [alive]})

    def close(self) -> None:
        pass


def answers(events: DataFrame, idle_ms: int) -> DataFrame:
    """key, kind and whether the flag is up, one row for each key and kind of a batch, from a stream of (key, kind)."""
    known = events.where("key is not null").where(events["kind"].isin(SET, READ, CLEAR)).select("key", "kind")
    return known.groupBy("key").transformWithStateInPandas(statefulProcessor=ExpiringFlag(idle_ms), outputStructType=ANSWERS, outputMode="Update", timeMode="ProcessingTime")


def start(events: DataFrame, idle_ms: int, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Answers every batch of ``events`` through ``sink``; state and progress are taken up again from ``checkpoint``.

    The query keeps the settings that it starts with: the store, and no batches without data, which keyed state with processing time would ask for
    without end (nothing is told when a flag expires, so none is needed).
    """
    spark = events.sparkSession
    before = {k: spark.conf.get(k) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        writer = answers(events, idle_ms).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
