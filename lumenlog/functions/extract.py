"""Column expressions that pull fields out of the message text.

All are JVM-side ``regexp_extract`` expressions (whole-stage codegen); an
empty match becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def extract_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """Group ``group`` of the first match of ``pattern``; null when absent."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def extract_int(text: Column, pattern: str) -> Column:
    """Whole number captured by ``pattern``; null when absent or out of range."""
    return extract_or_null(text, pattern).try_cast("int")


def incident_id(message: Column) -> Column:
    return extract_or_null(message, P.INCIDENT_ID_PATTERN)


def service(message: Column) -> Column:
    return extract_or_null(message, P.SERVICE_PATTERN)


def category(message: Column) -> Column:
    return extract_or_null(message, P.CATEGORY_PATTERN)


def affected_users(message: Column) -> Column:
    return extract_int(message, P.AFFECTED_USERS_PATTERN)


def duration_minutes(message: Column) -> Column:
    return extract_int(message, P.DURATION_PATTERN)


def system_id(message: Column) -> Column:
    return extract_or_null(message, P.SYSTEM_ID_PATTERN)


def is_critical(level: Column) -> Column:
    """Chosen definition: an ERROR-level event is critical."""
    return level == F.lit(P.ALERT_LEVEL)


def template_field(message: Column, name: str) -> Column:
    pattern = P.TEMPLATE_FIELD_PATTERNS[name]
    if name in P.TEMPLATE_INT_FIELDS:
        return extract_int(message, pattern)
    return extract_or_null(message, pattern)


def service_with_prose(message: Column, prefixes: list[str]) -> Column:
    """The named service, or else the word behind the first of ``prefixes`` (plain text, in
    the caller's order) that the message holds: messages that tell the service in prose."""
    found = [template_field(message, "service_lenient")]
    for prefix in prefixes:
        quoted = "\\Q" + prefix.replace("\\E", "\\E\\\\E\\Q") + "\\E"
        found.append(F.nullif(F.regexp_extract(message, quoted + r"([\w-]+)", 1), F.lit("")))
    return F.coalesce(*found)
