"""Declared schemas (no inference anywhere in the engine).

Fixed values: the field names and their order are the wire and file contract.
"""

from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType, TimestampType

# JSON body of one log event on the wire; all three keys are required by the
# producer contract but nullable here, because decoding is permissive.
LOG_EVENT_SCHEMA = StructType([
    StructField("timestamp", StringType(), True),
    StructField("level", StringType(), True),
    StructField("message", StringType(), True),
])

# Kafka-shaped wire record (the subset the engine reads).
WIRE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
])

# Enriched incident, in the fixed output column order of the sink.
ENRICHED_COLUMNS = ["event_time", "level", "message", "incident_id", "service", "category"]
ENRICHED_SCHEMA = StructType([
    StructField("event_time", TimestampType(), True),
    StructField("level", StringType(), True),
    StructField("message", StringType(), True),
    StructField("incident_id", StringType(), True),
    StructField("service", StringType(), True),
    StructField("category", StringType(), True),
])

# Chat request: new message, incident context and prior turns.
CHAT_REQUEST_SCHEMA = StructType([
    StructField("message", StringType(), True),
    StructField("incident_context", ArrayType(StructType([
        StructField("event_time", StringType(), True),
        StructField("message", StringType(), True),
    ])), True),
    StructField("history", ArrayType(StructType([
        StructField("role", StringType(), True),
        StructField("content", StringType(), True),
    ])), True),
])
