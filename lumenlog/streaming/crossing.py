"""The first crossing of the alert threshold, as keyed state with timers.

Every task reduces its part of a micro-batch to the ``min_count`` earliest events per
window before the shuffle, so a window that holds all of a batch sends a few rows per
task to its key.  The state of a window is the ``min_count`` earliest events seen and
whether it has alerted.  A window alerts once, in the batch in which its count reaches
the threshold; an event-time timer at its end drops the state once the watermark is
past it.  Rows of a window that is over are dropped, as by a windowed count.

The output is append-only and goes to Spark's file sink, whose commit log makes it
exactly-once over restarts.  State is in RocksDB with changelog checkpoints: a batch
uploads what it changed, not the whole state.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.patterns import ALERT_LEVEL, ALERT_MIN_COUNT, ALERT_WINDOW
from .jobs import DEFAULT_TRIGGER, STATE_CONF, start_with

OUTPUT = "window_start timestamp, window_end timestamp, level string, crossing_time timestamp, crossing_message string"
_EVENT = "start bigint, end bigint, at bigint, message string"


def earliest(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` first events (time, then message) of every window among a task's rows."""
    held: dict[tuple[int, int], list] = {}
    names = ["start", "end", "at", "message"]
    for b in batches:
        for start, end, at, message in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            events = held.setdefault((start, end), [])
            events.append((at, message))
            if len(events) > 64 + 2 * k:
                held[start, end] = heapq.nsmallest(k, events)
    rows = [(s, e, *x) for (s, e), events in held.items() for x in heapq.nsmallest(k, events)]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names)


class FirstCrossing(StatefulProcessor):
    """State per window: the earliest events as (times, messages), and ``alerted``."""

    def __init__(self, k: int, level: str):
        self.k, self.level = k, level

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("earliest", "at array<bigint>, message array<string>, alerted boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, end = key
        if timerValues.getCurrentWatermarkInMs() * 1000 >= end:     # the window is over
            return
        events, alerted = [], False
        if self.state.exists():
            at, message, alerted = self.state.get()
            events = list(zip(at, message, strict=True))
        else:
            self.handle.registerTimer(-(-end // 1000))
        if alerted:
            return
        events = heapq.nsmallest(self.k, [*events, *((r.at, r.message) for r in rows)])
        alerted = len(events) == self.k
        # after the alert the state only says that there was one
        kept = [] if alerted else events
        self.state.update(([a for a, _ in kept], [m for _, m in kept], alerted))
        if alerted:
            at, message = events[-1]
            yield Row(start=start, end=end, at=at, message=message)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_crossings(incidents: DataFrame, level: str = ALERT_LEVEL, min_count: int = ALERT_MIN_COUNT, duration: str = ALERT_WINDOW) -> DataFrame:
    """One row per window of a stream: the event at which its count reached ``min_count``,
    by event time and then message among the events that had come.  Null messages
    count as empty texts."""
    # the test on the level also reads the time, so it stays above the watermark: rows of other levels move it
    mine = F.coalesce(F.when(F.col("event_time").isNotNull(), F.col("level")), F.lit("")) == level
    window = F.window("event_time", duration)
    rows = (incidents.where(mine).withColumn("w", window)
            .select(F.unix_micros("w.start").alias("start"), F.unix_micros("w.end").alias("end"), F.unix_micros("event_time").alias("at"),
                    F.coalesce("message", F.lit("")).alias("message")))
    found = (rows.mapInArrow(lambda batches: earliest(batches, min_count), _EVENT)
             .groupBy("start", "end").transformWithState(FirstCrossing(min_count, level), _EVENT, "Append", "EventTime"))
    t = {c: F.timestamp_micros(c) for c in ("start", "end", "at")}
    return found.select(t["start"].alias("window_start"), t["end"].alias("window_end"), F.lit(level).alias("level"),
                        t["at"].alias("crossing_time"), F.col("message").alias("crossing_message"))


def start_first_crossings(incidents: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, query_name: str | None = None,
                          state_partitions: int | None = None, **rule) -> StreamingQuery:
    """Append the crossings to ``path``, partitioned by the window's date.  The state
    settings are read when the query first starts and then fixed by its checkpoint,
    so the session's own are put back."""
    out = first_crossings(incidents, **rule).withColumn("window_date", F.to_date("window_start"))
    w = out.writeStream.outputMode("append").format("parquet").partitionBy("window_date").option("checkpointLocation", checkpoint).option("path", path)
    if query_name:
        w = w.queryName(query_name)
    conf = STATE_CONF | ({"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {})
    return start_with(incidents.sparkSession, w.trigger(**(trigger or DEFAULT_TRIGGER)), conf)


def read_crossings(spark: SparkSession, path: str) -> DataFrame:
    """What the query has committed; empty before the first crossing."""
    from ..sources.files import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], OUTPUT)
    return spark.read.schema(OUTPUT + ", window_date date").parquet(path).drop("window_date")
