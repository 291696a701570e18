"""Micro-batches by count or time: rows wait in keyed state until there are enough of them, or the first has waited long enough."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Of 100 rows or 5 seconds, as uploads are batched.
COUNT, WAIT_MS = 100, 5_000

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BATCH = "lane long, batch long, reason string, due_ms long, ids array<string>"


class Batcher(StatefulProcessor):
    """A lane's buffer. ``reason`` of a batch: ``count`` or ``time``; ``due_ms``: when its first row's wait ended or would have."""

    def __init__(self, count: int, wait_ms: int, ttl_ms: int, arrival: bool):
        self.count, self.wait_ms, self.ttl_ms, self.arrival = count, wait_ms, ttl_ms, arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "ts long, id string", ttlDurationMs=self.ttl_ms or None)
        self.made = handle.getValueState("made", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = [(int(ts), id_) for ts, id_ in self.held.get()]
        now = timerValues.getCurrentProcessingTimeInMs() if self.arrival else 0
        fresh = [(now if self.arrival else int(ts), id_) for part in rows for ts, id_ in zip(part["ts_ms"], part["id"], strict=True)]
        # those that wait came in earlier batches; the new ones are put in order of time
        waiting = before + sorted(fresh)
        out = []
        while waiting:
            due = waiting[0][0] + self.wait_ms
            ready = waiting[: self.count]
            late = next((i for i, (ts, _) in enumerate(ready) if ts > due), None)
            if late is not None:  # a later row shows that the wait was over before it came
                out.append(("time", due, ready[:late]))
                waiting = waiting[late:]
            elif len(ready) == self.count:
                out.append(("count", due, ready))
                waiting = waiting[self.count :]
            else:
                break
        self._keep(waiting)
        if out:
            yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = [(int(ts), id_) for ts, id_ in self.held.get()]
        if waiting and waiting[0][0] + self.wait_ms <= expiredTimerInfo.getExpiryTimeInMs():
            due = waiting[0][0] + self.wait_ms
            self._keep([])
            yield self._frame(key, [("time", due, waiting)])

    def close(self) -> None:
        pass

    def _keep(self, waiting: list[tuple[int, str]]) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if waiting:
            self.held.put(waiting)
            self.handle.registerTimer(waiting[0][0] + self.wait_ms)
        else:
            self.held.clear()

    def _frame(self, key, out: list[tuple]) -> pd.DataFrame:
        first = int(self.made.get()[0]) if self.made.exists() else 0
        self.made.update((first + len(out),))
        rows = [(int(key[0]), first + i, reason, due, [id_ for _, id_ in rows]) for i, (reason, due, rows) in enumerate(out)]
        return pd.DataFrame(rows, columns=["lane", "batch", "reason", "due_ms", "ids"])


def enable(spark: SparkSession) -> None:
    """Keyed timers and lists need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def lanes(id_: Column, number: int) -> Column:
    """Which of ``number`` buffers a row waits in: as many as there are writers to feed."""
    return F.pmod(F.xxhash64(id_), F.lit(number))


def batched(
    rows: DataFrame, number: int = 8, count: int = COUNT, wait_ms: int = WAIT_MS, late: str = "10 seconds", ttl_ms: int = 0, clock: str = "eventTime"
) -> DataFrame:
    """Batches ``lane, batch, reason, due_ms, ids`` of a stream ``rows(id, ts)``, of ``count`` rows or of what waited ``wait_ms``.

    By ``eventTime`` a wait is over when the watermark (the latest time, less ``late``) has passed it, or when a later
    row of the lane shows it; rows that come ``late`` are dropped, as everywhere behind a watermark. By
    ``processingTime`` a row's wait starts when it comes in, and ``ts`` counts for nothing. Each row is in one batch;
    within a lane batches are numbered. A lane's buffer holds fewer than ``count`` rows; what waits when the query stops is
    in its checkpoint and goes out when it starts again. ``ttl_ms`` forgets rows that the buffer has held so long by the
    clock; 0 forgets none.
    """
    enable(rows.sparkSession)
    id_ = F.col("id").cast("string")
    seen = rows.withWatermark("ts", late) if clock == "eventTime" else rows
    keyed = seen.select("ts", id_.alias("id"), lanes(id_, number).alias("lane"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    return keyed.groupBy("lane").transformWithStateInPandas(Batcher(count, wait_ms, ttl_ms, clock != "eventTime"), BATCH, "append", clock)
