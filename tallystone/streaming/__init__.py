"""Polling loops as Structured Streaming: staged files are deduplicated and handed on in micro-batches; stale claims time out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def staged_files(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    """New files of a staging folder, at most so many in a batch (back-pressure)."""
    found = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_batch).schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("blobid"), "path", "length", "modificationTime")


def upload(staged: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, late: str = "7 days") -> StreamingQuery:
    """Each blob once, in batches every five seconds; ``once`` drains what there is and ends.

    Ids are remembered until files are ``late`` newer; a blob staged again after that is uploaded again, which changes nothing.
    """
    fresh = staged.withWatermark("modificationTime", late).dropDuplicatesWithinWatermark(["blobid"])
    writer = fresh.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def rates(events: DataFrame, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Operations by type in tumbling windows, late ones within the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


STALE = "pth string, claimed_by string, claimed_at timestamp"


def stale_claims(events: DataFrame, minutes: int = 30, late: str = "1 minute") -> DataFrame:
    """Claims of ``events(pth, action, worker, ts)`` that nothing finished in time, once each.

    ``claim`` starts a path's clock anew, any other action stops it; the clock runs on the events' own time.
    """

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            worker, at = state.get
            state.remove()
            yield pd.DataFrame({"pth": [key[0]], "claimed_by": [worker], "claimed_at": [pd.Timestamp(at, unit="us")]})
            return
        found = pd.concat(list(frames)).sort_values(["ts", "action"])
        last = found.iloc[-1]
        if last["action"] != "claim":
            state.remove()
            return
        at = last["ts"].value // 1000 if last["ts"].unit == "ns" else int(last["ts"].timestamp() * 1_000_000)
        state.update((last["worker"], at))
        state.setTimeoutTimestamp(max(at // 1000 + minutes * 60_000, state.getCurrentWatermarkMs() + 1))

    grouped = events.withWatermark("ts", late).groupBy("pth")
    return grouped.applyInPandasWithState(follow, STALE, "worker string, at long", "append", GroupStateTimeout.EventTimeTimeout)
