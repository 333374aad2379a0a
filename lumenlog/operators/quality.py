"""Required-field contract as a data-quality split.

The producer contract requires ``timestamp``, ``level`` and ``message``.
Decoding is permissive, so the contract is checked after it: each row gets
``quality`` = valid / quarantine and the first failing ``reason``.  One
pass; callers route the two classes with a filter or a partitioned write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED = ("event_time", "level", "message")


def quality_split(decoded: DataFrame) -> DataFrame:
    reason = F.when(F.col("message").isNull() & F.col("level").isNull() & F.col("event_time").isNull(),
                    F.lit("unreadable"))
    for c in REQUIRED:
        reason = reason.when(F.col(c).isNull(), F.lit(f"missing_{c}"))
    return decoded.select(
        "*",
        F.when(reason.isNull(), F.lit("valid")).otherwise(F.lit("quarantine")).alias("quality"),
        reason.alias("reason"),
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("quality") == "valid").drop("quality", "reason")


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("quality") == "quarantine")
