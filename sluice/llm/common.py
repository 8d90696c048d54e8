"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: what reads the result survives the loss of any
    executor, and expensive or order-dependent steps run once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` also changes other letters)."""
    return (F.when(F.octet_length(col) == F.char_length(col), F.lower(col))
            .otherwise(F.translate(col, _UPPER, _UPPER.lower())))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def with_row_index(df: DataFrame, *order: Column, index: str = "row_index") -> DataFrame:
    """Number the rows 0, 1, ... in the global order, without a one-task window.

    The rows are range-partitioned and sorted; a row's number is its place in
    its partition plus the sizes of the partitions before it.  Only those
    sizes (one row for each partition) meet in one task.
    """
    part = (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("__pid", F.spark_partition_id())
            .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    part = materialise(part, "row-index")
    sizes = part.groupBy(F.col("__pid").alias("__of")).count()
    before = sizes.select("__of", (F.expr("sum(count) over (order by __of)") - F.col("count")).alias("__before"))
    return (part.join(F.broadcast(before), F.col("__pid") == F.col("__of"))
            .withColumn(index, F.col("__before") + F.col("__at"))
            .drop("__pid", "__at", "__of", "__before"))


def keep_rows(docs: DataFrame, id_col: str, digest: Column, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (key, digest, twin), with their own columns.

    A row is found by its id and the digest of its text.  ``twin`` marks those
    that may fit several rows, of which any one stays; there are none unless
    the table repeats rows.
    """
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"), digest.alias("__digest"))
    kept = kept.select(F.col("key").alias("__key"), F.col("digest").alias("__of"), F.col("twin").alias("__twin"))
    same = F.col("__id").eqNullSafe(F.col("__key")) & (F.col("__digest") == F.col("__of"))
    twins = kept.where("__twin")
    if twins.isEmpty():
        return rows.join(kept, same, "left_semi").select("__row.*")
    one = rows.join(twins, same, "left_semi").groupBy("__id", "__digest").agg(F.first("__row").alias("__row"))
    return (rows.join(kept.where("not __twin"), same, "left_semi").select("__row")
            .unionAll(one.select("__row")).select("__row.*"))


@contextmanager
def small_batches(spark: SparkSession, limit: int):
    """Arrow batches of about ``limit`` bytes at most for the steps that run inside; the session is as before afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, f"{limit}b")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def byte_slices(batch, column: int, limit: int = 4 << 20):
    """Cut an Arrow batch into slices of about ``limit`` bytes of the given text column (a row is never cut)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()  # else a worker holds on to the largest batch it has seen


def texts_as_bytes(column) -> list[bytes]:
    """A string column's values as UTF-8 bytes; null counts as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
