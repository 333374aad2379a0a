"""Streaming sources of wire records.

``read_kafka`` is the production source.  The Kafka connector jar is not
part of the PySpark install used for tests, so tests drive the same
pipeline through ``read_wire_files`` — a file source yielding the same
``key binary, value binary`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import WIRE_SCHEMA

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


def read_kafka(spark: SparkSession, bootstrap: str, topic: str,
               starting_offsets: str = "latest", fail_on_data_loss: bool = False,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to ``topic``; returns the Kafka source columns (key, value, topic, ...).

    Offsets live in the query's checkpoint, so a restarted query resumes
    where it stopped; ``fail_on_data_loss=False`` skips offsets the broker
    has already deleted.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def read_wire_files(spark: SparkSession, path: str, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Stand-in source: files holding (key binary, value binary) rows."""
    r = spark.readStream.schema(WIRE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
