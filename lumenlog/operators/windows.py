"""Event-time window counts and the alert rule.

``window_counts`` is the same expression on batch and streaming input
(partial + final hash aggregation; streaming adds the state store).  The
alert rule is a plain filter applied to the *output* of the count: on a
stream it must run inside ``foreachBatch`` (see ``streaming.jobs``), because
a filter on ``level`` placed on the streaming plan is pushed below
``withWatermark`` and changes which rows advance the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import ALERT_LEVEL, ALERT_MIN_COUNT, ALERT_WINDOW
from ..functions.timefmt import render_ts


def window_counts(enriched: DataFrame, duration: str = ALERT_WINDOW) -> DataFrame:
    """Count per tumbling event-time window and level.

    Rows with a null event_time fall in no window and are not counted.
    Output: window_start, window_end, level, count.
    """
    agg = (enriched
           .groupBy(F.window("event_time", duration).alias("window"), F.col("level"))
           .agg(F.count(F.lit(1)).alias("count")))
    return flatten_window(agg)


def flatten_window(agg: DataFrame) -> DataFrame:
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "level", "count",
    )


def alert_rule(counts: DataFrame, level: str = ALERT_LEVEL, min_count: int = ALERT_MIN_COUNT) -> DataFrame:
    """Windows whose count of ``level`` rows reached ``min_count``, with alert text."""
    return (counts
            .where((F.col("level") == level) & (F.col("count") >= min_count))
            .select("window_start", "window_end", "level", "count",
                    alert_text(F.col("count"), F.col("level"),
                               F.col("window_start"), F.col("window_end")).alias("alert_text")))


def alert_text(count, level, start, end):
    return F.format_string("Alert: %d %s events from %s to %s",
                           count, level, render_ts(start), render_ts(end))


def alerts(enriched: DataFrame) -> DataFrame:
    """Batch form: window counts, then the alert rule."""
    return alert_rule(window_counts(enriched))


def alerts_first_crossing(enriched: DataFrame, level: str = ALERT_LEVEL,
                          min_count: int = ALERT_MIN_COUNT,
                          duration: str = ALERT_WINDOW, tiebreak: str = "event_id") -> DataFrame:
    """One alert per window: the event at which the count first reaches ``min_count``.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit
    before the shuffle, so each task ships at most ``min_count`` rows per
    window — a hot window never lands whole in one task.
    """
    w = Window.partitionBy("window_start").orderBy(F.col("event_time"), F.col(tiebreak))
    hits = (enriched
            .where((F.col("level") == level) & F.col("event_time").isNotNull())
            .select(F.window("event_time", duration).alias("window"), "event_time", tiebreak)
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "event_time", tiebreak)
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= min_count)
            .where(F.col("rn") == min_count))
    return hits.select("window_start", "window_end", F.lit(level).alias("level"),
                       F.col("event_time").alias("crossing_time"),
                       F.col(tiebreak).alias(f"crossing_{tiebreak}"))


def hourly_rollup(enriched: DataFrame) -> DataFrame:
    """Rows per event hour and level (the event-time twin of the hourly file bucket)."""
    return (enriched.where(F.col("event_time").isNotNull())
            .groupBy(F.date_trunc("hour", "event_time").alias("event_hour"), "level")
            .agg(F.count(F.lit(1)).alias("count")))
