"""The two streaming queries and their wiring.

One definition (decode -> watermark -> enrich) feeds two independent
queries, each with its own checkpoint:

* enriched sink — stateless, append mode, native file sink partitioned by
  hour bucket.  Exactly-once through the sink's commit log, so a replayed
  batch does not duplicate rows; every task writes its own files.
* alert sink — 5-minute window count per level, update mode.  The alert
  rule runs inside ``foreachBatch`` on the emitted rows (never on the
  streaming plan, where a ``level`` filter would be pushed below the
  watermark).  Alerts are written to a table partitioned by ``batch_id``
  with dynamic partition overwrite, so a replayed batch replaces its own
  output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.patterns import ALERT_WINDOW, WATERMARK_DELAY
from ..functions.timefmt import render_ts
from ..operators.enrich import enrich, fixed_order
from ..operators.windows import alert_rule, flatten_window
from ..sinks.files import CSV_WRITE_OPTIONS, with_hour
from ..sources.codec import decode_by_schema, decode_framed, decode_plain

DEFAULT_TRIGGER = {"processingTime": "1 minute"}

# Alert table written by the alert sink (window_date and batch_id are the partition columns).
ALERT_TABLE_SCHEMA = ("window_start timestamp, window_end timestamp, level string, count long, "
                      "alert_text string, window_date date, batch_id long")


def incident_stream(wire: DataFrame, framed: bool = True,
                    watermark: str = WATERMARK_DELAY, registry: DataFrame | None = None) -> DataFrame:
    """Wire records -> enriched incidents with an event-time watermark.

    With ``registry`` (schema_id, version) every record is decoded by its schema's
    layout, through a stream-static join; the table is the one at the query's start
    (``streaming.intake`` reads it again in every batch)."""
    if registry is not None:
        decoded = decode_by_schema(wire, registry).select("event_time", "level", "message")
    else:
        decoded = decode_framed(wire) if framed else decode_plain(wire)
    return enrich(decoded.withWatermark("event_time", watermark))


def _trigger(w, trigger: dict | None):
    return w.trigger(**(trigger or DEFAULT_TRIGGER))


def start_enriched_sink(incidents: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                        hour: str = "ingest", trigger: dict | None = None,
                        query_name: str | None = None) -> StreamingQuery:
    """Append enriched rows to ``path`` partitioned by hour bucket.

    ``hour='ingest'`` buckets by processing time (fixed per micro-batch);
    ``'event'`` by event hour.  Row counts per batch are published as an
    observed metric (``batch_rows``) in the query progress — no second pass.
    """
    part = "ingest_hour" if hour == "ingest" else "event_hour"
    out = with_hour(fixed_order(incidents), "ingest" if hour == "ingest" else "event")
    out = out.observe("batch_rows", F.count(F.lit(1)).alias("rows"))
    if fmt == "csv":
        out = out.withColumn("event_time", render_ts(F.col("event_time")))
    w = (out.writeStream.outputMode("append").format(fmt).partitionBy(part)
         .option("checkpointLocation", checkpoint).option("path", path))
    if fmt == "csv":
        w = w.options(**CSV_WRITE_OPTIONS)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def window_count_stream(incidents: DataFrame, duration: str = ALERT_WINDOW) -> DataFrame:
    """Stateful count per (window, level); rows with a null time fall in no window."""
    return incidents.groupBy(F.window("event_time", duration), F.col("level")).count()


def alert_batch_writer(path: str, first_only: bool = False):
    """foreachBatch handler: apply the alert rule to the emitted counts and
    overwrite this batch's partitions of the alert table.

    By default a window alerts again every time its count changes (update
    mode re-emits it).  ``first_only`` keeps only the first crossing: an
    anti-join against windows already alerted by *earlier* batches (the
    batch's own partition is excluded, so a replay rewrites the same rows).
    The alert table holds at most one row per window and level per batch,
    so this lookup stays small next to the event stream.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        alerts = alert_rule(flatten_window(batch)).withColumn("window_date", F.to_date("window_start"))
        if first_only:
            # only the folders of the dates that this batch alerts on are read
            alerts = alerts.persist()
            days = alerts.agg(F.min("window_date").alias("lo"), F.max("window_date").alias("hi")).first()
            seen = (read_alert_table(batch.sparkSession, path)
                    .where(F.col("window_date").between(F.lit(days.lo), F.lit(days.hi)) & (F.col("batch_id") < batch_id))
                    .select("window_start", "level"))
            new = alerts.join(seen, ["window_start", "level"], "left_anti")
        else:
            new = alerts
        (new.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("window_date", "batch_id").parquet(path))
        if first_only:
            alerts.unpersist()
    return handle


def start_alert_sink(incidents: DataFrame, path: str, checkpoint: str,
                     trigger: dict | None = None, query_name: str | None = None,
                     first_only: bool = False, state_partitions: int | None = None, rocksdb: bool = False) -> StreamingQuery:
    """Start the stateful window count in update mode with the alert writer.

    ``state_partitions`` sets the number of state-store partitions and ``rocksdb`` keeps the
    state in RocksDB with changelog checkpoints: it may outgrow an executor's heap, and
    a batch uploads what it changed.  Both are read from the session when the query
    first starts and then fixed by the checkpoint, so they are applied for the start
    call only and the session's values are put back afterwards.
    """
    w = (window_count_stream(incidents).writeStream.outputMode("update")
         .foreachBatch(alert_batch_writer(path, first_only))
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return start_with(incidents.sparkSession, _trigger(w, trigger), (STATE_CONF if rocksdb else {}) | (
        {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}))


#: State in RocksDB, a batch's changes as its checkpoint.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start_with(spark: SparkSession, writer, conf: dict[str, str]) -> StreamingQuery:
    """Start a query under settings that a stream takes from the session at its first start."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_alert_table(spark: SparkSession, path: str) -> DataFrame:
    """Every alert emission; empty (not an error) before the first alert."""
    from ..sources.files import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], ALERT_TABLE_SCHEMA)
    return spark.read.schema(ALERT_TABLE_SCHEMA).parquet(path)


def final_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The last emission of every alerting window (= its final count).

    Counts only grow, so the row of the highest batch_id per window holds
    the final count.  A bounded top-1 per key (WindowGroupLimit).
    """
    from pyspark.sql import Window
    a = read_alert_table(spark, path)
    w = Window.partitionBy("window_start", "level").orderBy(F.col("batch_id").desc())
    return (a.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("window_start", "window_end", "level", "count", "alert_text"))


def run_both(spark: SparkSession, wire: DataFrame, root: str, framed: bool = True,
             trigger: dict | None = None, await_any: bool = True) -> list[StreamingQuery]:
    """Start the enriched sink and the alert sink over one definition.

    ``root`` is a folder on shared storage; each query gets its own
    checkpoint below it.  With ``await_any`` this blocks until either
    query ends (or fails).
    """
    incidents = incident_stream(wire, framed=framed)
    q1 = start_enriched_sink(incidents, f"{root}/enriched", f"{root}/_checkpoints/enriched",
                             trigger=trigger, query_name=None)
    q2 = start_alert_sink(incidents, f"{root}/alerts", f"{root}/_checkpoints/alerts",
                          trigger=trigger, query_name=None)
    if await_any:
        spark.streams.awaitAnyTermination()
    return [q1, q2]
