"""A log line per micro-batch: rows in, rows out, late rows dropped, watermark.

Spark reports these after every batch; the listener writes each report to a folder
named by query and batch, so a batch that is reported twice (a replay after a restart)
is one line.  The line is one row and is written by a small Spark job, so the log lies
on the same shared storage as the tables.  Rows dropped as late are counted by the
stateful operator, after its partial aggregation: one per window and key that a task
brings late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.files import path_exists

LINE = "run_id string, rows_in long, rows_observed long, state_rows long, late_rows long, watermark string, reported_at string"
LOG_SCHEMA = LINE + ", query string, batch_id long"


class BatchLog(StreamingQueryListener):
    """Writes a line per batch of every named query (or of those in ``queries``).

    Batches without input are not logged unless they dropped or kept state.  The line
    is written on the listener's own thread; a failed write ends in the driver's log
    and never in the query."""

    def __init__(self, spark: SparkSession, path: str, queries: set[str] | None = None):
        self.spark, self.path, self.queries = spark, path.rstrip("/"), queries

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.name or (self.queries is not None and p.name not in self.queries):
            return
        observed = [m["rows"] for m in p.observedMetrics.values() if "rows" in m]
        line = (str(p.runId), p.numInputRows, sum(observed) if observed else None, sum(s.numRowsTotal for s in p.stateOperators),
                sum(s.numRowsDroppedByWatermark for s in p.stateOperators), p.eventTime.get("watermark"), p.timestamp)
        if p.numInputRows or line[4]:
            (self.spark.createDataFrame([line], LINE).coalesce(1).write.mode("overwrite")
             .parquet(f"{self.path}/query={p.name}/batch_id={p.batchId}"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_batch_log(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def drain(spark: SparkSession) -> None:
    """Waits until the reports so far have been written (tests, end of a bounded run)."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
