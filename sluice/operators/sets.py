"""Set operations over feed frames (O-21, O-22)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """O-21: UNION ALL by position; duplicates kept."""
    return reduce(DataFrame.union, frames)


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """O-22: vertical concat by column name; a column missing on one side is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
