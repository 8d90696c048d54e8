"""Feed request filters applied to rows (O-11, O-12, O-13, O-23).

The feed protocol sends these as query parameters; here they are ordinary
predicates, so on a parquet table they reach the scan as pushed filters.
``'All'`` means no filter and is decided on the driver, leaving no
predicate in the plan at all.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_path

ALL = "All"  # fixed value: the protocol's "no filter" word


def filter_status(df: DataFrame, column: str, status: str | None = ALL) -> DataFrame:
    """O-11: ``status=All`` keeps everything, else rows whose status equals it."""
    if status is None or status == ALL:
        return df
    return df.where(F.col(column) == F.lit(status))


def filter_search(df: DataFrame, search_by: str | None, search_str: str | None = ALL) -> DataFrame:
    """O-13: ``searchStr=All`` keeps everything, else ``search_by`` column == value."""
    if search_str is None or search_str == ALL or not search_by:
        return df
    return df.where(F.col(search_by) == F.lit(search_str))


def _mdy(s: str | None) -> _dt.date | None:
    if not s:
        return None
    return _dt.datetime.strptime(s, "%m-%d-%Y").date()


def filter_dates(df: DataFrame, column: str, from_date: str | None, to_date: str | None = None,
                 text_format: str = "MM-dd-yyyy") -> DataFrame:
    """O-12: inclusive window given as 'MM-dd-yyyy' text; open-ended without ``to_date``.

    On a date/timestamp column the bounds are literals compared with the
    bare column (pushable to parquet); a text column is parsed with
    ``text_format`` first.
    """
    lo, hi = _mdy(from_date), _mdy(to_date)
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        c = F.col(column)
        conds = []
        if lo:
            conds.append(c >= F.lit(_dt.datetime.combine(lo, _dt.time())).cast(dtype))
        if hi:
            conds.append(c < F.lit(_dt.datetime.combine(hi + _dt.timedelta(days=1), _dt.time())).cast(dtype))
    else:
        c = F.col(column) if isinstance(dtype, T.DateType) else F.try_to_date(F.col(column), text_format)
        conds = ([c >= F.lit(lo)] if lo else []) + ([c <= F.lit(hi)] if hi else [])
    for cond in conds:
        df = df.where(cond)
    return df


def cap_records_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column | str] | Column | str,
                        n: int, rank_column: str | None = None) -> DataFrame:
    """O-23 across payloads: at most ``n`` rows per key, first by ``order``, ties by the other columns.

    For ``n`` up to spark.sql.optimizer.windowGroupLimitThreshold,
    ``row_number() <= n`` lets Spark plan a partial WindowGroupLimit before
    the shuffle, so a hot key sends at most ``n`` rows per map task.  Larger
    caps are ranked across tasks: rows are range-partitioned by key, order and
    content, each range is ranked by itself, and a row's rank is that plus the
    key's rows in the ranges before (one count for each key and range).  No
    task sorts a hot key whole, and both ways give the same rows.
    Within one payload use ``parse_documents(max_records=n)``, which is a
    slice of the parsed array and needs no shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    names = df.columns
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields
            if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rn = rank_column or "_rn"
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        ranked = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*by, *ties)))
    else:
        spark = df.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        cut = df.repartitionByRange(parts, *keys, *by, *ties).withColumn("_range", F.spark_partition_id())
        path = scratch_path(spark, "cap")
        cut.write.parquet(path)  # the ranges stay as they are, also when an executor is lost
        cut = spark.read.schema(cut.schema).parquet(path)
        counts = cut.groupBy(*keys, "_range").count()
        before = counts.select(*keys, "_range", (F.sum("count").over(
            Window.partitionBy(*keys).orderBy("_range")) - F.col("count")).alias("_before"))
        same = F.col("c._range") == F.col("b._range")
        for k in keys:
            same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"b.{k}"))
        ranked = (cut.alias("c").join(before.alias("b"), same).select("c.*", "b._before")
                  .withColumn(rn, F.col("_before") + F.row_number().over(
                      Window.partitionBy(*keys, "_range").orderBy(*by, *ties))))
    return ranked.where(F.col(rn) <= int(n)).select(*names, *([rn] if rank_column else []))
