"""Enrichment: extract incident id, service and category from the message.

Stateless projections — valid on batch and streaming frames alike, one
scan-project stage, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions.patterns import TEMPLATE_FIELD_PATTERNS
from ..schemas import ENRICHED_COLUMNS


def enrich(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(event_time, level, message, ...) -> six-column enriched incident.

    ``keep`` lists extra input columns to carry after the fixed six
    (e.g. ``event_id`` as a deterministic tie-break key).
    """
    msg = F.col("message")
    extra = [F.col(c) for c in (keep or [])]
    return events.select(
        F.col("event_time"), F.col("level"), msg,
        X.incident_id(msg).alias("incident_id"),
        X.service(msg).alias("service"),
        X.category(msg).alias("category"),
        *extra,
    )


def enrich_extended(enriched: DataFrame) -> DataFrame:
    """Add the legacy columns recovered from the message:
    affected_users, duration (minutes), system_id, is_critical."""
    msg = F.col("message")
    return enriched.select(
        "*",
        X.affected_users(msg).alias("affected_users"),
        X.duration_minutes(msg).alias("duration"),
        X.system_id(msg).alias("system_id"),
        X.is_critical(F.col("level")).alias("is_critical"),
    )


def enrich_template_fields(enriched: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Opt-in: one column per remaining template field (severity, assignee, ...)."""
    names = fields or list(TEMPLATE_FIELD_PATTERNS)
    msg = F.col("message")
    return enriched.select("*", *[X.template_field(msg, n).alias(n) for n in names])


def enrich_service_prose(enriched: DataFrame, prefixes: list[str]) -> DataFrame:
    """Opt-in: ``service_any``, also from messages that name the service behind one of ``prefixes``."""
    return enriched.withColumn("service_any", X.service_with_prose(F.col("message"), prefixes))


def fixed_order(enriched: DataFrame) -> DataFrame:
    """The sink's fixed six-column order."""
    return enriched.select(*ENRICHED_COLUMNS)
