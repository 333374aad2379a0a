"""Bag union of incident frames written by different job versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_versions(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing from a frame reads as null.

    No dedup (a bag union), no shuffle.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
