"""Timestamp parsing and rendering expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column) -> Column:
    """ISO-8601 text (with or without fraction / offset) to timestamp.

    ``try_to_timestamp`` keeps ANSI mode from failing the query on a bad
    value: the result is null instead.
    """
    return F.try_to_timestamp(text)


def _render(ts: Column, date_part: str, suffix: str = "") -> Column:
    """``date_part`` + ``.ffffff`` only when the fraction is not zero + ``suffix``."""
    whole = F.date_format(ts, f"{date_part}{suffix}")
    frac = F.date_format(ts, f"{date_part}.SSSSSS{suffix}")
    return F.when(F.unix_micros(ts.cast("timestamp")) % 1_000_000 == 0, whole).otherwise(frac)


def render_ts(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]``: how a time prints in text outputs
    (prompt lines, alert text).  The session zone is UTC."""
    return _render(ts, "yyyy-MM-dd HH:mm:ss")


def render_iso_local(ts: Column) -> Column:
    """ISO-8601 without offset (``yyyy-MM-ddTHH:mm:ss[.ffffff]``), as Python's
    ``datetime.isoformat()`` prints a naive time in JSON responses."""
    return _render(ts, "yyyy-MM-dd'T'HH:mm:ss")


def render_iso(ts: Column) -> Column:
    """ISO-8601 with an explicit UTC offset (``+00:00``), fraction only when not zero."""
    return _render(ts, "yyyy-MM-dd'T'HH:mm:ss", "xxx")


def to_utc_wallclock(df):
    """Emit every TIMESTAMP column as timestamp_ntz (UTC wall clock)."""
    from pyspark.sql.types import TimestampType
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
