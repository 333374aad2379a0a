"""Intake: decode by the registered schemas, split by the contract, log the batch.

One query over the wire.  For every micro-batch the handler reads the schema registry
again, so a schema registered while the query runs is known from the next batch on,
and decodes every record by its schema's layout.  One write in one pass routes the rows
to two tables, valid and quarantined.  A batch has a folder of its own in each and
replaces both folders whole: a batch that is done again, after a cut at any point and
also with a newer registry, leaves every row once.  Its line in ``batches`` comes last
and publishes it: ``read_valid`` and ``read_quarantine`` show published batches only.

A quarantined row keeps key and payload, so ``redecoded`` can decode it again once its
schema is registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import enrich
from ..operators.quality import quality_split
from ..schemas import ENRICHED_COLUMNS
from ..sources.codec import decode_by_schema
from ..sources.files import path_exists

REGISTRY_SCHEMA = "schema_id long, version string"
ROW_SCHEMA = ("event_time timestamp, level string, message string, incident_id string, service string, category string, "
              "schema_id long, version string, reason string, key binary, value binary, batch_id long, quality string")
COUNTS = ("rows", "valid", "quarantined", "unknown_schema")
BATCH_SCHEMA = ", ".join(f"{c} long" for c in (*COUNTS, "batch_id"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(schema_id, version) of every registered schema, as of now."""
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path).dropDuplicates(["schema_id"])


def checked(wire: DataFrame, registry: DataFrame) -> DataFrame:
    """Wire rows decoded by schema, with ``quality`` and ``reason``; a frame whose schema
    is not registered says so."""
    rows = quality_split(decode_by_schema(wire.select("key", "value"), registry, keep=["key", "value"]))
    unknown = F.col("schema_id").isNotNull() & F.col("version").isNull()
    return rows.withColumn("reason", F.when(unknown, "unknown_schema").otherwise(F.col("reason")))


def batch_writer(root: str, registry_path: str):
    """The foreachBatch handler: decode, split, write, publish."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen, bad = Observation(), F.col("quality") == "quarantine"
        count = lambda c: F.count(F.when(c, 1))       # noqa: E731
        rows = enrich(checked(batch, read_registry(spark, registry_path)), keep=["schema_id", "version", "reason", "key", "value", "quality"])
        payload = {c: F.when(bad, F.col(c)).alias(c) for c in ("key", "value")}       # valid rows leave it behind
        (rows.withColumns(payload)
         .observe(seen, F.count(F.lit(1)).alias("rows"), count(~bad).alias("valid"), count(bad).alias("quarantined"), count(F.col("reason") == "unknown_schema").alias("unknown_schema"))
         .write.mode("overwrite").partitionBy("quality").parquet(f"{root}/rows/batch_id={batch_id}"))
        line = spark.createDataFrame([tuple(seen.get[c] for c in COUNTS)], ", ".join(f"{c} long" for c in COUNTS))
        line.coalesce(1).write.mode("overwrite").parquet(f"{root}/batches/batch_id={batch_id}")
    return handle


def start_intake(wire: DataFrame, root: str, registry_path: str, checkpoint: str, trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    w = wire.writeStream.foreachBatch(batch_writer(root, registry_path)).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """A line per published batch: rows, valid, quarantined, of these with an unregistered schema."""
    if not path_exists(spark, f"{root}/batches"):
        return spark.createDataFrame([], BATCH_SCHEMA)
    return spark.read.schema(BATCH_SCHEMA).parquet(f"{root}/batches")


def _read(spark: SparkSession, root: str, quality: str) -> DataFrame:
    if not path_exists(spark, f"{root}/rows"):
        return spark.createDataFrame([], ROW_SCHEMA)
    # the batch is a partition column: folders of unpublished batches are not read
    rows = spark.read.schema(ROW_SCHEMA).parquet(f"{root}/rows").where(F.col("quality") == quality)
    return rows.join(read_batches(spark, root).select("batch_id"), "batch_id", "left_semi")


def read_valid(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "valid").select(*ENRICHED_COLUMNS, "schema_id", "version", "batch_id")


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "quarantine").select("event_time", "level", "message", "schema_id", "version", "reason", "key", "value", "batch_id")


def redecoded(spark: SparkSession, root: str, registry_path: str) -> DataFrame:
    """Quarantined rows of then unregistered schemas that are valid by the registry of now."""
    waiting = read_quarantine(spark, root).where(F.col("reason") == "unknown_schema")
    rows = checked(waiting, read_registry(spark, registry_path))
    return enrich(rows.where(F.col("quality") == "valid"), keep=["schema_id", "version"]).select(*ENRICHED_COLUMNS, "schema_id", "version")
