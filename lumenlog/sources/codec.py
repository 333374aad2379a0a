"""Wire codec: framed JSON values <-> log events, as native expressions.

A framed value is one magic byte (0x00), a 4-byte big-endian schema id and
the UTF-8 JSON body.  Everything here is a column expression — no Python
UDF, no registry client — so decoding stays inside whole-stage codegen on
batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.patterns import FRAME_HEADER_BYTES, FRAME_MAGIC_HEX
from ..functions.timefmt import parse_event_time, render_iso
from ..schemas import LOG_EVENT_SCHEMA


# --- frame parts ---------------------------------------------------------------

def frame_magic(value: Column) -> Column:
    """Hex text of the first byte (``00`` for a valid frame)."""
    return F.hex(F.substring(value, 1, 1))


def frame_schema_id(value: Column) -> Column:
    """Schema id from bytes 2..5 (big-endian); null when the value is too short."""
    head = F.substring(value, 2, 4)
    return F.when(F.octet_length(value) >= FRAME_HEADER_BYTES,
                  F.conv(F.hex(head), 16, 10).cast("long"))


def frame_body(value: Column) -> Column:
    """JSON text after the 5-byte header."""
    return F.substr(value, F.lit(FRAME_HEADER_BYTES + 1)).cast("string")


# --- decode ----------------------------------------------------------------------

def _events_from_struct(data: Column) -> list[Column]:
    return [parse_event_time(data.getField("timestamp")).alias("event_time"),
            data.getField("level").alias("level"),
            data.getField("message").alias("message")]


def decode_framed(wire: DataFrame, check_magic: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Framed values -> (event_time, level, message).

    Malformed bodies, short or null values decode to all-null rows (the
    JSON parse is permissive); an unparseable time becomes null.  With
    ``check_magic`` a value whose first byte is not 0x00 also decodes to
    nulls (the registry-aware path).
    """
    body = frame_body(F.col("value"))
    if check_magic:
        body = F.when(frame_magic(F.col("value")) == FRAME_MAGIC_HEX, body)
    data = F.from_json(body, LOG_EVENT_SCHEMA)
    return wire.select(*_events_from_struct(data), *[F.col(c) for c in (keep or [])])


def decode_plain(wire: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Unframed JSON values -> (event_time, level, message)."""
    data = F.from_json(F.col("value").cast("string"), LOG_EVENT_SCHEMA)
    return wire.select(*_events_from_struct(data), *[F.col(c) for c in (keep or [])])


#: Registered layouts: version -> names of the time, level and message fields.
EVENT_LAYOUTS = {"v1": ("timestamp", "level", "message"), "v2": ("time", "severity", "text")}


def decode_by_schema(wire: DataFrame, registry: DataFrame, keep: list[str] | None = None,
                     layouts: dict[str, tuple[str, str, str]] | None = None) -> DataFrame:
    """Registry-aware decode: split the frame, join the schema id to a
    ``registry(schema_id, version)`` table and parse the body by the layout of
    that version.

    The registry has one row per registered schema, so Spark's size check
    (``spark.sql.autoBroadcastJoinThreshold``) broadcasts it; a registry
    over the threshold falls back to a shuffle join.  Unknown ids, versions
    without a layout and wrong magic bytes decode to nulls.
    """
    v = F.col("value")
    framed = wire.select("*", frame_magic(v).alias("magic"), frame_schema_id(v).alias("schema_id"))
    joined = framed.join(registry.select("schema_id", "version"), "schema_id", "left")
    data = F.lit(None).cast(LOG_EVENT_SCHEMA)
    for version, names in (layouts or EVENT_LAYOUTS).items():
        mine = (F.col("magic") == FRAME_MAGIC_HEX) & (F.col("version") == version)
        body = F.from_json(frame_body(v), StructType([StructField(n, StringType(), True) for n in names]))
        data = F.when(mine, F.struct(*[body.getField(n).alias(f.name) for n, f in zip(names, LOG_EVENT_SCHEMA.fields, strict=True)])).otherwise(data)
    return joined.withColumn("_data", data).select(*_events_from_struct(F.col("_data")), "schema_id", "version",
                                                   *[F.col(c) for c in (keep or [])])


# --- encode ----------------------------------------------------------------------

def event_json(event_time: Column, level: Column, message: Column) -> Column:
    """JSON body of one event; time as ISO-8601 with offset."""
    return F.to_json(F.struct(render_iso(event_time).alias("timestamp"),
                              level.alias("level"), message.alias("message")))


def frame(body_text: Column, schema_id) -> Column:
    """0x00 + 4-byte big-endian schema id + UTF-8 body."""
    sid = schema_id if isinstance(schema_id, Column) else F.lit(schema_id)
    header = F.unhex(F.concat(F.lit(FRAME_MAGIC_HEX), F.lpad(F.hex(sid.cast("long")), 8, "0")))
    return F.concat(header, F.encode(body_text, "UTF-8"))


def to_wire(events: DataFrame, schema_id=1, key_col: str | None = "action",
            framed: bool = True, keep: list[str] | None = None) -> DataFrame:
    """(event_time, level, message[, action]) -> (key binary, value binary)."""
    body = event_json(F.col("event_time"), F.col("level"), F.col("message"))
    value = frame(body, schema_id) if framed else F.encode(body, "UTF-8")
    key = F.encode(F.col(key_col), "UTF-8") if key_col else F.lit(None).cast("binary")
    return events.select(key.alias("key"), value.alias("value"), *[F.col(c) for c in (keep or [])])


def record_key(wire: DataFrame) -> Column:
    """Action name carried as the record key."""
    return F.col("key").cast("string")
