"""Distributed file sinks for enriched incidents.

Each task writes its own part files; nothing is funnelled through one task
or the driver.  The hour bucket is a partition column, so readers prune by
hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import render_ts

HOUR_FORMAT = "yyyy-MM-dd_HH"

# Text written exactly: header per part file, doubled quotes, no trimming of
# leading/trailing whitespace (Spark's CSV writer trims by default).
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def ingest_hour() -> Column:
    """Processing-time hour bucket (fixed for one micro-batch / one job)."""
    return F.date_format(F.current_timestamp(), HOUR_FORMAT)


def event_hour(ts: str = "event_time") -> Column:
    """Event-time hour bucket: deterministic on replay."""
    return F.date_format(F.date_trunc("hour", F.col(ts)), HOUR_FORMAT)


def with_hour(df: DataFrame, by: str = "event") -> DataFrame:
    col = event_hour() if by == "event" else ingest_hour()
    name = "event_hour" if by == "event" else "ingest_hour"
    return df.withColumn(name, col)


def write_incidents(df: DataFrame, path: str, fmt: str = "parquet", hour: str = "event",
                    mode: str = "append", max_records_per_file: int | None = None) -> None:
    """Write enriched rows partitioned by hour bucket.

    CSV output renders ``event_time`` as text (microseconds kept) with a
    header per part file and doubled quotes.  The hour column becomes the
    partition directory.  Every task writes its own file for each hour
    present in its rows (no shuffle); ``max_records_per_file`` bounds file
    size and ``compact`` merges small files per hour afterwards.
    """
    part = "event_hour" if hour == "event" else "ingest_hour"
    out = with_hour(df, hour)
    if fmt == "csv":
        out = out.select(*[render_ts(F.col(c)).alias(c) if c == "event_time" else F.col(c)
                           for c in out.columns])
    w = out.write.mode(mode).partitionBy(part)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if fmt == "csv":
        w.options(**CSV_WRITE_OPTIONS).csv(path)
    else:
        w.parquet(path)


def compact(spark, src: str, dst: str, fmt: str = "parquet", files_per_hour: int | None = None,
            target_bytes: int = 128 << 20) -> None:
    """Rewrite small per-batch files into fewer files per hour bucket.

    A separate batch job; the shuffle is by hour bucket and a spread key, so an
    hour goes to as many tasks as its share of ``target_bytes`` files asks for
    (``files_per_hour`` sets the number instead).
    """
    from ..sources.files import list_files, read_incident_dir
    df = read_incident_dir(spark, src, fmt=fmt)
    if fmt == "csv":
        from ..operators.feed import clean_feed
        df = clean_feed(df, drop_bad_time=False)
    found = list_files(spark, src, f".{fmt}")
    hours = len({name.rsplit("/", 1)[0] for name, _ in found}) or 1
    if files_per_hour is None:
        files_per_hour = max(1, -(-sum(size for _, size in found) // (hours * target_bytes)))
    spread = F.pmod(F.xxhash64("message", "event_time"), F.lit(files_per_hour))
    out = with_hour(df, "event").repartition(hours * files_per_hour, "event_hour", spread).drop("event_hour")
    write_incidents(out, dst, fmt=fmt, mode="overwrite")


def write_quality_split(checked: DataFrame, path: str, mode: str = "append") -> None:
    """Route valid and quarantined rows in one pass: ``quality=valid`` and
    ``quality=quarantine`` partition folders under ``path`` (Parquet)."""
    checked.write.mode(mode).partitionBy("quality").parquet(path)
