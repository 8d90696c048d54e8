"""Append-only table writes (O-28, O-29).

Appends match columns by name and reject a frame with a different column
set, so a schema drift in a feed fails its load instead of shifting
columns.  Re-running a date range appends it again: loads are not
idempotent by design, exactly like the feed protocol's daily pulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_table(df: DataFrame, table: str, fmt: str | None = None, path: str | None = None) -> None:
    """O-28 / O-29: append to a catalog table, created on first write.

    ``fmt`` names the table format (default: the session's default source);
    ``path`` makes it an external table at that location.
    """
    w = df.write.mode("append")
    if fmt:
        w = w.format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to a path-based table (no catalog)."""
    df.write.mode("append").format(fmt).save(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.refreshTable(table)
    return spark.table(table)
