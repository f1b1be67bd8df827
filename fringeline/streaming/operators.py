"""Streaming forms of event matching, networks and gaps. Each equals its batch form on a finite input."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fringeline.operators.spatial import quake_frames
from fringeline.storage import shared_folder

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Epochs of a frame that a new one is paired with.
LAST = 3
#: Event time for which a frame's last epochs are kept: five years.
KEPT_MS = 5 * 366 * 86_400_000


def replay(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A Parquet table as a stream of its files; timestamps become instants so that watermarks apply."""
    schema = spark.read.parquet(path).schema
    # as a pattern, since a stream's plain path must be a folder and a table may be one file
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path[:-1]}[{path[-1]}]")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_end(stream: DataFrame) -> DataFrame:
    """Run an append stream over what is there, to Parquet in the shared folder, and read the result. State is kept by RocksDB, which operators with
    lists and timers ask for; the session's own choice of a store is set again once the query has started."""
    spark = stream.sparkSession
    own = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    base = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"
    try:
        query = stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    finally:
        if own is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, own)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def event_feed(feed: DataFrame, key: str, keep: Column, delay: str, today: Column, active_days: int = 10) -> DataFrame:
    """Events that pass a filter, once per key while the watermark holds it; ``active`` are those of less than so many days ago."""
    once = feed.filter(keep).withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])
    return once.withColumn("active", F.col("ts") > today - F.expr(f"interval {active_days} days"))


def events_with_frames(events: DataFrame, frames: DataFrame) -> DataFrame:
    """Events joined with the static table of frames that they may have moved."""
    return quake_frames(events, frames)


def coseismic_triggers(events: DataFrame, acquisitions: DataFrame, within: str, delay: str) -> DataFrame:
    """(frame, id, ts, acq_ts): acquisitions of a frame within a time after an event. Both sides are forgotten once their watermark has passed."""
    e = events.withWatermark("ts", delay).select("frame", "id", "ts")
    a = acquisitions.withWatermark("acq_ts", delay).select(F.col("frame").alias("a_frame"), "acq_ts")
    later = (F.col("acq_ts") > F.col("ts")) & (F.col("acq_ts") <= F.col("ts") + F.expr(f"interval {within}"))
    return e.join(a, (F.col("frame") == F.col("a_frame")) & later).select("frame", "id", "ts", "acq_ts")


class _LastEpochs(StatefulProcessor):
    """A frame's last epochs as a list, and the event time at which they go."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getListState("last", "epoch string")
        self.until = handle.getValueState("until", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = [e for (e,) in self.last.get()]
        out = []
        for day in sorted({d for p in rows for d in p["epoch"]}):
            if last and day.isoformat() <= last[-1]:
                continue  # late or repeated
            out += [(key[0], dt.date.fromisoformat(d), day) for d in last]
            last = [*last, day.isoformat()][-LAST:]
        self.last.put([(e,) for e in last])
        # one timer a frame: it moves on with every batch that has the frame
        if self.until.exists():
            self.handle.deleteTimer(self.until.get()[0])
        until = max(timerValues.getCurrentWatermarkInMs(), 0) + KEPT_MS
        self.handle.registerTimer(until)
        self.until.update((until,))
        yield pd.DataFrame(out, columns=["frame", "epoch1", "epoch2"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def incremental_network(epochs: DataFrame, delay: str) -> DataFrame:
    """epochs (frame, epoch, ts): each new epoch of a frame paired with the last three; the state is three dates a frame, in the RocksDB store (see
    run_to_end). Epochs that come later than the watermark allows are left out, and a frame's state goes, by an event-time timer, once it has seen none
    for KEPT_MS of event time. (A time to live would count the wall clock, and isn't allowed beside event time.)"""
    return epochs.withWatermark("ts", delay).groupBy("frame").transformWithStateInPandas(_LastEpochs(), "frame long, epoch1 date, epoch2 date", "Append", "EventTime")


def acquisition_runs(acquisitions: DataFrame, gap: str, delay: str) -> DataFrame:
    """Runs of acquisitions of a frame without a longer gap, once the watermark has passed their end."""
    runs = acquisitions.withWatermark("ts", delay).groupBy("frame", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return runs.select("frame", F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def tumbling(rows: DataFrame, by: str, size: str, delay: str, value: str) -> DataFrame:
    """Count and sum per key and closed window."""
    t = rows.withWatermark("ts", delay).groupBy(by, F.window("ts", size).alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return t.select(by, F.col("w.start").alias("start"), "n", "total")
