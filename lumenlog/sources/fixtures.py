"""Incident log events derived from the driver's ``events`` table.

The driver tables carry no incident text, so each ``events`` row is turned
into one log event: a compressed event time (30 days -> 12 hours, so that
5-minute windows are dense), a level, a record key (action) and a message.

A message is a list of independent parts.  Each part is there or not by its
own rule on the row's ``props`` number, and its values come from the row
(``value``, ``props``, ``user_id``, ``event_type``), so every combination of
extraction markers occurs.  The derivation is a single narrow projection (no
shuffle) and scales with ``events``.

The rule is stated in FIXTURES.md §2; the DuckDB twin in
``lumenlog.plans.oracle`` states it again on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc

BASE_TIME = "2024-01-01 00:00:00"
TIME_COMPRESSION = 60
SERVICES = 13
LEVEL_OF_EVENT_TYPE = {"error": "ERROR", "click": "WARNING"}   # otherwise INFO


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def message_parts() -> list[Column]:
    """The parts of a message, in order; a part that is absent is null."""
    k, cents, user, kind = (F.col(c) for c in ("k", "cents", "user_id", "event_type"))
    service = _text("Service: node-", user % SERVICES)
    load = F.when(F.col("value") < 5, "Light Load").when(F.col("value") < 20, "Steady Load").otherwise("Heavy Load")
    return [
        _text(kind, " reading ", cents),
        F.when(k % 3 != 0, _text("INC-", user, "K", k)),
        # a word after the name hides it from the service pattern
        F.when((k % 7 != 0) & (k % 5 == 0), _text(service, " degraded")).when(k % 7 != 0, service),
        F.when(k % 4 == 1, _text("Category: ", load)),
        F.when(k % 6 == 2, _text("Affected users: ", user)),
        F.when(k % 8 < 3, _text("Duration: ", k, " minutes")).when(k % 8 == 3, _text("Recovery time: ", k, " minutes")),
        F.when(k % 9 < 4, _text("SYS-", user)),
        F.when(k % 10 == 4, _text("Severity: ", F.when(F.col("value") < 10, "Minor").otherwise("Major"))),
        F.when(k % 11 == 5, _text("Assigned to: crew.", user % 7)),
        F.when(k % 11 == 6, _text("Resolved by: crew.", user % 7)),
        F.when(k % 11 == 7, _text("Escalated to: crew.", user % 7)),
        F.when(k % 12 == 3, _text("Attack type: odd ", kind, ", Source IP: 198.51.100.", k)),
        F.when(k % 13 == 1, _text("Database: store", user % 5, ", Records affected: ", cents)),
        F.when(k % 14 == 2, _text("Load increased by ", k, "%")),
        F.when(k % 15 == 4, _text("CPU: ", k, "%, Memory: ", k, "%, Disk: ", k, "%")),
    ]


def incidents_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> log events.

    Output: event_id, event_time (timestamp, UTC), level, action, message.
    """
    t0 = f"unix_micros(timestamp'{BASE_TIME}')"
    event_time = F.expr(
        f"timestamp_micros({t0} + (unix_micros(cast(ts as timestamp)) - {t0}) div {TIME_COMPRESSION})")
    level = F.lit("INFO")
    for event_type, lvl in LEVEL_OF_EVENT_TYPE.items():
        level = F.when(F.col("event_type") == event_type, lvl).otherwise(level)
    k = F.coalesce(F.regexp_extract("props", r"(\d+)", 1).try_cast("int"), F.lit(0))
    # filters on the message stop above the generator; pushed below the number's extraction
    # they would repeat it for each of its uses in the message
    rows = events.select("event_id", event_time.alias("event_time"), level.alias("level"), "event_type", "user_id", "value",
                         F.explode(F.array(k)).alias("k"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    action = _text(F.col("event_type"), F.when(F.col("message").contains("INC-"), "_case").otherwise("_note"))
    return (rows.withColumn("message", F.concat_ws(", ", *message_parts()))
            .select("event_id", "event_time", "level", action.alias("action"), "message"))


# --- fixed values: dirty-topic rule -------------------------------------------
# Which derived wire records are damaged, by event_id (first match wins):
CUT_BODY_EVERY = 101        # JSON body cut after CUT_BODY_BYTES bytes (malformed)
CUT_BODY_BYTES = 20
NO_LEVEL_EVERY = 103        # body without the "level" key
BAD_TIME_EVERY = 107        # timestamp text "nope"
SCHEMA_V2_EVERY = 109       # framed with schema id 2 instead of 1
BAD_TIME_TEXT = "nope"


def wire_records(incidents: DataFrame, damage: bool = True, layouts: bool = False) -> DataFrame:
    """The topic as it arrives: (key, value, event_id) with framed JSON values.

    Derived one-to-one from the incidents.  With ``damage`` a fixed share of
    records is damaged by the dirty-topic rule above, so that decoding and
    quarantine have real work on every scale factor.  With ``layouts`` the records
    of schema 2 use that schema's field names.
    """
    from ..functions.timefmt import render_iso
    from .codec import frame, to_wire

    if not damage:
        return to_wire(incidents, key_col="action", keep=["event_id"])
    eid = F.col("event_id")
    ts_text = F.when(eid % BAD_TIME_EVERY == 0, F.lit(BAD_TIME_TEXT)).otherwise(render_iso(F.col("event_time")))
    def bodies(time, level, message):
        t, m = ts_text.alias(time), F.col("message").alias(message)
        return F.to_json(F.struct(t, F.col("level").alias(level), m)), F.to_json(F.struct(t, m))

    full, no_level = bodies("timestamp", "level", "message")
    if layouts:
        second = eid % SCHEMA_V2_EVERY == 0
        full, no_level = (F.when(second, b).otherwise(a) for a, b in zip((full, no_level), bodies("time", "severity", "text"), strict=True))
    body = (F.when(eid % CUT_BODY_EVERY == 0, F.substring(full, 1, CUT_BODY_BYTES))
            .when(eid % NO_LEVEL_EVERY == 0, no_level)
            .otherwise(full))
    schema_id = F.when(eid % SCHEMA_V2_EVERY == 0, F.lit(2)).otherwise(F.lit(1))
    return incidents.select(F.encode(F.col("action"), "UTF-8").alias("key"),
                            frame(body, schema_id).alias("value"), eid)


def feed_text(enriched: DataFrame) -> DataFrame:
    """The feed as a CSV reader sees it: event_time as text.

    Even ids carry ISO text with offset, odd ids plain text; the fraction
    is present only when not zero.  Damaged by rule: ``event_id % 7 == 3``
    unreadable text, ``event_id % 11 == 5`` empty (missing).
    """
    from ..functions.timefmt import render_iso, render_ts

    eid = F.col("event_id")
    t = F.col("event_time")
    text = (F.when(eid % 7 == 3, F.lit("not-a-time"))
            .when(eid % 11 == 5, F.lit(None).cast("string"))
            .when(eid % 2 == 0, render_iso(t))
            .otherwise(render_ts(t)))
    return enriched.withColumn("event_time", text)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events derived from ``{sf_dir}/events.parquet``."""
    pin_utc(spark)
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return incidents_from_events(events)
