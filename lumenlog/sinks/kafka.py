"""Publish log events to Kafka as framed JSON (batch or streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.codec import to_wire


def write_kafka(events: DataFrame, bootstrap: str, topic: str, schema_id: int = 1,
                key_col: str | None = "action") -> None:
    """Batch publish: one framed record per row, action name as the key."""
    (to_wire(events, schema_id=schema_id, key_col=key_col)
     .write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap)
     .option("topic", topic)
     .save())


def start_kafka_stream(events: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                       schema_id: int = 1, key_col: str | None = "action") -> StreamingQuery:
    """Streaming publish with its own checkpoint."""
    return (to_wire(events, schema_id=schema_id, key_col=key_col)
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start())
