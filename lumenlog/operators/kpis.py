"""Headline counts over the feed.

A single global aggregate: partial aggregation in every task, one tiny
final merge.  Over empty input it returns one row of zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpis(df: DataFrame, approx_services: bool = False) -> DataFrame:
    """total, critical (level ERROR), warning (level WARNING), services (distinct, nulls ignored).

    Level match is exact.  ``approx_services`` swaps the exact distinct
    count for HyperLogLog++.
    """
    zero = F.lit(0).cast("long")
    if "service" not in df.columns:
        services = zero
    else:
        services = (F.approx_count_distinct("service") if approx_services
                    else F.count_distinct(F.col("service")))
    has_level = "level" in df.columns
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count_if(F.col("level") == "ERROR") if has_level else zero).alias("critical"),
        (F.count_if(F.col("level") == "WARNING") if has_level else zero).alias("warning"),
        services.alias("services"),
    )


def kpis_legacy(ext: DataFrame) -> DataFrame:
    """Older dashboard: critical from the boolean column, case-insensitive ERROR level.

    A column the frame lacks gives null (shown as N/A) instead of failing.
    """
    na = F.lit(None).cast("long")
    cols = ext.columns
    return ext.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count_if(F.col("is_critical")) if "is_critical" in cols else na).alias("critical"),
        (F.count_if(F.upper(F.col("level")) == "ERROR") if "level" in cols else na).alias("error"),
        (F.count_distinct(F.col("service")) if "service" in cols else na).alias("services"),
    )
