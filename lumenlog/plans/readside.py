"""Read-side questions over a stored enriched-incident folder.

The same operators as the registered queries, applied to what the
streaming job wrote (Parquet or CSV, hour-partitioned) instead of the
derived fixture.  Each report is ``DataFrame -> DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import correlate as CR
from ..operators import feed as FD
from ..operators import kpis as KP
from ..operators import prompts as PR
from ..operators import windows as WN
from ..sources.files import read_incident_dir


def load_feed(spark: SparkSession, path: str, fmt: str = "parquet",
              hour_range: tuple[str, str] | None = None, hour_col: str = "ingest_hour") -> DataFrame:
    """Stored incidents as the feed: times parsed, rows without a time dropped."""
    df = read_incident_dir(spark, path, fmt=fmt, hour_range=hour_range, hour_col=hour_col)
    return FD.clean_feed(df)


#: Every report gets (the filtered feed, the whole feed).  Counts and
#: correlated rows are of the whole feed; primaries come from the filtered one.
REPORTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "kpis": lambda f, whole: KP.kpis(whole),
    "feed": lambda f, whole: FD.feed_recent(f),
    "feed_json": lambda f, whole: FD.feed_json(f),
    "has_incident_ids": lambda f, whole: FD.has_incident_ids(f),
    "levels": lambda f, whole: FD.distinct_levels(whole),
    "services": lambda f, whole: FD.distinct_services(whole),
    "incident_ids": lambda f, whole: FD.distinct_incident_ids(f),
    "latest": lambda f, whole: FD.latest_per_incident(f),
    "window_counts": lambda f, whole: WN.window_counts(whole),
    "alerts": lambda f, whole: WN.alerts(whole),
    "correlate_counts": lambda f, whole: CR.correlate_counts(_latest(f), whole),
    "correlate_pairs": lambda f, whole: CR.correlate_pairs(_latest(f), whole),
    "rca_prompts": lambda f, whole: PR.rca_prompt(_latest(f), whole),
    "rca_prompts_full": lambda f, whole: PR.rca_prompt_full(_latest(f), whole),
    "single_prompts": lambda f, whole: PR.single_prompt(_latest(f)),
}

#: Reports on one incident, looked up by its id in the filtered feed.
ONE_REPORTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "incident": lambda p, whole: p,
    "correlated": lambda p, whole: CR.correlate_one(p, whole).orderBy(F.col("event_time").desc()),
    "correlated_oldest_first": lambda p, whole: CR.correlate_one(p, whole).orderBy("event_time"),
    "rca_prompt": lambda p, whole: PR.rca_prompt_one(p, whole),
    "rca_prompt_full": lambda p, whole: PR.rca_prompt_one(p, whole, full=True),
    "single_prompt": lambda p, whole: PR.single_prompt(p),
}


def _tie(feed: DataFrame) -> list[str]:
    return ["event_id"] if "event_id" in feed.columns else ["message"]


def _latest(feed: DataFrame) -> DataFrame:
    return FD.latest_per_incident(feed, _tie(feed))


def report(feed: DataFrame, name: str, level: str = FD.ALL, service: str = FD.ALL,
           incident_id: str | None = None) -> DataFrame:
    """Run report ``name`` with optional level and service filters; the reports of
    ``ONE_REPORTS`` need an incident id."""
    chosen = FD.filter_feed(feed, level=level, service=service)
    if name in ONE_REPORTS:
        if incident_id is None:
            raise ValueError(f"report {name} needs an incident id")
        return ONE_REPORTS[name](FD.lookup_incident(chosen, incident_id, _tie(feed)), feed)
    return REPORTS[name](chosen, feed)
