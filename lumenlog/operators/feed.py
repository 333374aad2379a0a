"""The incident feed: cleaning, filters, ordering, distinct lists, latest row.

All operators are lazy DataFrame transforms; none collects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.timefmt import parse_event_time, render_iso_local

ALL = "All"


def clean_feed(raw: DataFrame, time_col: str = "event_time", drop_bad_time: bool = True) -> DataFrame:
    """Parse a text event time, turn NaN into null, drop rows without a time.

    Unparseable times become null (no exception under ANSI mode); with
    ``drop_bad_time`` those rows are dropped, as the read API does.
    Already-typed time columns pass through.
    """
    cols = []
    for f in raw.schema.fields:
        c = F.col(f.name)
        if f.name == time_col and f.dataType.typeName() == "string":
            c = parse_event_time(c)
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), None).otherwise(c)
        cols.append(c.alias(f.name))
    out = raw.select(*cols)
    return out.where(F.col(time_col).isNotNull()) if drop_bad_time else out


def strict_times(raw: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Strict parse: a malformed time fails the query; missing times are kept."""
    return raw.withColumn(time_col, F.to_timestamp(F.col(time_col)))


def newest_first(df: DataFrame, tiebreak: list[str] | None = None) -> list[Column]:
    keys = [F.col("event_time").desc_nulls_last()]
    keys += [F.col(c).asc_nulls_last() for c in (tiebreak or [])]
    return keys


def feed_recent(df: DataFrame, n: int | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Feed newest first; with ``n`` a top-n report (TakeOrderedAndProject)."""
    out = df.orderBy(*newest_first(df, tiebreak))
    return out.limit(n) if n is not None else out


def filter_feed(df: DataFrame, level: str = ALL, service: str = ALL) -> DataFrame:
    """Level and service filters; ``All`` means no filter.  Pushed to the scan."""
    if level != ALL:
        df = df.where(F.col("level") == level)
    if service != ALL:
        df = df.where(F.col("service") == service)
    return df


def distinct_levels(df: DataFrame) -> DataFrame:
    """Distinct levels, null kept (the filter list)."""
    return df.select("level").distinct()


def distinct_services(df: DataFrame) -> DataFrame:
    return df.where(F.col("service").isNotNull()).select("service").distinct()


def distinct_incident_ids(df: DataFrame) -> DataFrame:
    return df.where(F.col("incident_id").isNotNull()).select("incident_id").distinct()


def has_incident_ids(df: DataFrame) -> DataFrame:
    """One row: does any row carry an incident id?  One found row ends the scan."""
    found = df.where(F.col("incident_id").isNotNull()).select("incident_id").limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("has_incident_ids"))


def latest_per_incident(df: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Latest row of every incident id (ties: ``tiebreak`` ascending).

    A grouped ``min_by`` over an ordering key (time present first, newest
    first, then the tie-break columns).  It aggregates partially in every
    task before the shuffle, so a heavily repeated id ships one row per
    task, never its whole group.
    """
    tiebreak = tiebreak or ["message"]
    row = F.struct(*[F.col(c) for c in df.columns])
    t = F.col("event_time")
    order = F.struct(t.isNull().alias("_o0"), (-F.unix_micros(t.cast("timestamp"))).alias("_o1"),
                     *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)])
    return (df.where(F.col("incident_id").isNotNull())
            .groupBy("incident_id").agg(F.min_by(row, order).alias("_r"))
            .select(*[F.col("_r").getField(c).alias(c) for c in df.columns]))


def lookup_incident(df: DataFrame, incident_id, tiebreak: list[str] | None = None) -> DataFrame:
    """Latest row for one id (empty when the id is unknown).

    ``incident_id`` is a string or a Column (e.g. a scalar subquery).
    """
    key = F.lit(incident_id) if isinstance(incident_id, str) else incident_id
    return latest_per_incident(df.where(F.col("incident_id") == key), tiebreak)


def feed_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON record per row; times as ISO-8601 text, nulls written as null."""
    columns = columns or ["event_time", "level", "message", "incident_id", "service", "category"]
    fields = [render_iso_local(F.col(c)).alias(c) if c == "event_time" else F.col(c) for c in columns]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))
