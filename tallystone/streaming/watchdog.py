"""Supervision of workers: which are hung, and when each is restarted, over a log of health checks or a stream of them."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallystone.streaming.batches import enable

#: Process states in which a worker answers nothing.
UNRESPONSIVE = ("zombie", "disk-sleep", "dead")
MINUTE = 60_000_000


@dataclass(frozen=True)
class Limits:
    """Mean load of the last ``samples`` checks below which a worker is idle; minutes without progress; minutes between restarts."""

    idle: float = 1.0
    samples: int = 5
    stalled: float = 15
    cooldown: float = 5


@dataclass
class Worker:
    """What is known of a worker; times are microseconds. A restart forgets all but the restarts themselves."""

    loads: list[float] = field(default_factory=list)
    since: int | None = None
    progressed: int | None = None
    restarted: int | None = None
    restarts: int = 0

    def check(self, ts: int, load: float | None, status: str | None, progress: bool | None, limits: Limits) -> tuple | None:
        """The event of one health check: ``(ts, event, reason, restarts)``, or None for a sound worker.

        Hung is who is idle and has made no progress for longer than ``stalled`` (counted from the first check, if it made
        none), or who is unresponsive. A hung worker is restarted, unless its last restart is no longer ago than
        ``cooldown``. A check without a load doesn't count for the mean.
        """
        if self.since is None:
            self.since = ts
        if load is not None:
            self.loads = [*self.loads, load][-limits.samples :]
        if progress:
            self.progressed = ts
        idle = len(self.loads) == limits.samples and sum(self.loads) < limits.idle * limits.samples
        last = self.progressed if self.progressed is not None else self.since
        stalled = ts - last > limits.stalled * MINUTE
        reason = "unresponsive" if status in UNRESPONSIVE else "stalled" if idle and stalled else None
        if reason is None:
            return None
        if self.restarted is not None and ts - self.restarted <= limits.cooldown * MINUTE:
            return ts, "cooldown", reason, self.restarts
        self.loads, self.since, self.progressed = [], None, None
        self.restarted, self.restarts = ts, self.restarts + 1
        return ts, "restart", reason, self.restarts


_EVENTS = "worker string, us long, event string, reason string, restarts long"
_COLUMNS = ["worker", "us", "event", "reason", "restarts"]


def _checks(samples: DataFrame) -> DataFrame:
    return samples.select(
        F.col("worker").cast("string").alias("worker"), "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.col("id").cast("long").alias("id"),
        F.col("cpu").cast("double").alias("cpu"), "status", "progress",
    )


def _known(value):
    return None if pd.isna(value) else value


def _timed(events: DataFrame) -> DataFrame:
    return events.select("worker", F.timestamp_micros("us").alias("ts"), "event", "reason", "restarts")


def supervise(samples: DataFrame, limits: Limits | None = None) -> DataFrame:
    """``worker, ts, event, reason, restarts`` of a log ``samples(worker, ts, id, cpu, status, progress)``, in order of ts and id.

    An ordered fold, worker by worker, that holds one worker's state. Rows without a worker or a time are left out.
    """
    limits = limits or Limits()
    rows = _checks(samples).where("worker IS NOT NULL AND us IS NOT NULL")

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, worker = None, Worker()
        for part in parts:
            out = []
            for own, ts, cpu, status, progress in zip(part["worker"], part["us"], part["cpu"], part["status"], part["progress"], strict=True):
                if own != name:
                    name, worker = own, Worker()
                event = worker.check(int(ts), _known(cpu), status, _known(progress), limits)
                if event is not None:
                    out.append((own, *event))
            yield pd.DataFrame(out, columns=_COLUMNS)

    ordered = rows.drop("ts").repartition("worker").sortWithinPartitions("worker", "us", "id")
    return _timed(ordered.mapInPandas(fold, _EVENTS))


class Watch(StatefulProcessor):
    """A worker's checks wait in state until the watermark has passed them, so that they are taken in order."""

    def __init__(self, limits: Limits):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, id long, cpu double, status string, progress boolean")
        self.worker = handle.getValueState("worker", "state binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = [(int(us), int(id_), _known(cpu), status, _known(progress)) for part in rows for us, id_, cpu, status, progress in zip(part["us"], part["id"], part["cpu"], part["status"], part["progress"], strict=True)]
        self.waiting.appendList(fresh)
        for us, *_ in fresh:
            self.handle.registerTimer(us // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        rows = [tuple(r) for r in self.waiting.get()]
        ready = sorted((r for r in rows if r[0] // 1000 < now), key=lambda r: r[:2])
        if not ready:
            return
        worker = pickle.loads(self.worker.get()[0]) if self.worker.exists() else Worker()
        events = [worker.check(us, cpu, status, progress, self.limits) for us, _, cpu, status, progress in ready]
        self.worker.update((pickle.dumps(worker),))
        left = [r for r in rows if r[0] // 1000 >= now]
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        out = [(key[0], *e) for e in events if e is not None]
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)

    def close(self) -> None:
        pass


def supervise_stream(samples: DataFrame, limits: Limits | None = None, late: str = "1 minute") -> DataFrame:
    """The events of ``supervise`` over a stream, for checks that come no later than ``late`` behind the latest."""
    enable(samples.sparkSession)
    rows = _checks(samples.withWatermark("ts", late)).where("worker IS NOT NULL AND us IS NOT NULL")
    return _timed(rows.groupBy("worker").transformWithStateInPandas(Watch(limits or Limits()), _EVENTS, "append", "eventTime"))
