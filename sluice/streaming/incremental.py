"""O-37: load newly landed payloads, each landed file exactly once.

The landing table is a file stream source; its checkpoint remembers which
files were processed, so ``trigger(availableNow=True)`` parses only what
arrived since the last run and then stops (a scheduled daily increment).

Each micro-batch's records are written to ``<table>/query=<id>/batch_id=<n>``
with overwrite: if a batch is replayed after a failure, it replaces its own
output instead of appending it twice, so the table holds every record
exactly once.  The id is the streaming query's own, kept in its checkpoint: a
second query on the same table, or a lost checkpoint, starts a folder of its own
and never replaces what is there.  With a manifest it does not read files again
either: the manifest is a table of the files (path, length, time) that each
batch loaded, written with the batch in the same folders, and every batch
leaves out what other folders of it name.  Malformed payloads go to the
quarantine the same way.  A file counts as new whatever its age.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.xml import document_status, explode_records, parse_documents, quarantine
from sluice.session import default_parallelism
from sluice.sources.files import decode_documents, stream_document_files
from sluice.sources.split import split_documents
from sluice.sources.storage import make_dir
from sluice.plans.catalog import DEFAULT_ROW_TAGS, feed_columns, feed_schema
from sluice.sources.fetch import PAYLOAD_SCHEMA
from sluice.sources.landing import LANDING_PARTITIONS

QUERY_COLUMN = "query"
BATCH_COLUMN = "batch_id"
FILE = "_file"
#: The file source forgets files older than this, counted from the newest one it has seen; its default is a week.
NO_AGE_LIMIT = "1000000d"


def incremental_load(spark: SparkSession, landing_path: str, endpoint: str, table_path: str,
                     checkpoint: str, *, quarantine_path: str | None = None, log_path: str | None = None,
                     row_tags: Sequence[str] | None = None,
                     max_files_per_trigger: int | None = 1000, files: bool = False,
                     glob: str = "*.xml", every: str | None = None,
                     split_bytes: int | None = None, manifest_path: str | None = None):
    """Run one availableNow pass; returns the number of micro-batches run.

    ``log_path`` gets a run log: a row for each payload with its status, record
    count and message, in the same folders as the records.

    ``landing_path`` is the landing table (parquet, see ``sources.landing``),
    or with ``files=True`` a folder where each document is its own file
    (read as bytes and decoded strictly, see ``sources.files``: a file whose bytes do
    not fit its encoding is logged as failed; the file name becomes the request id).  A backlog is worked
    off in micro-batches of at most ``max_files_per_trigger`` files, each
    committed on its own.  With ``every`` (e.g. ``"5 minutes"``) the query
    keeps running on a processing-time trigger and is returned instead.
    With ``split_bytes``, dropped files above it are split at record
    boundaries and the parts spread over tasks before parsing (a shuffle of
    the batch's bodies, so it is opt-in for feeds that drop large files;
    landed payloads were already split when fetched).

    With ``manifest_path`` files that another checkpoint on it has loaded are left out: a lost
    checkpoint doubles nothing but the one batch that was written when it was lost, if its manifest
    was not.
    """
    cols = feed_columns(endpoint)
    tags = row_tags or DEFAULT_ROW_TAGS
    if files:
        reader = spark.readStream
    else:
        # Only this feed's subtree of the landing table is listed per trigger;
        # its endpoint is then a constant, not a partition column.
        reader = spark.readStream.schema(
            T.StructType([f for f in PAYLOAD_SCHEMA.fields if f.name != "endpoint"]))
    reader = reader.option("maxFileAge", NO_AGE_LIMIT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if files:
        src = stream_document_files(reader, landing_path, glob).select(
            F.col("file_name").alias("request_id"), F.lit(None).cast("bigint").alias("mlsSid"), "content",
            F.struct(F.col("file_path").alias("path"), "length", "modified").alias(FILE))
    else:
        feed_dir = f"{landing_path.rstrip('/')}/endpoint={endpoint}"
        make_dir(spark, feed_dir)
        src = reader.parquet(feed_dir)
        if manifest_path:
            src = src.withColumn(FILE, F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
                                                F.col("_metadata.file_modification_time").alias("modified")))
        src = src.withColumn("endpoint", F.lit(endpoint))
    seen: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Set by the stream for the job it runs; the same in every run on one checkpoint.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"{QUERY_COLUMN}={query}/{BATCH_COLUMN}={batch_id}"
        if manifest_path:
            seen_before = read_manifest(batch.sparkSession, manifest_path).where(
                ~((F.col(QUERY_COLUMN) == query) & (F.col(BATCH_COLUMN) == batch_id)))
            batch = batch.join(seen_before.select(F.struct("path", "length", "modified").alias(FILE)).distinct(), FILE, "left_anti")
        mine = batch.select(f"{FILE}.*").distinct() if manifest_path else None
        if files:
            batch = decode_documents(batch)
        if files and split_bytes:
            batch = split_documents(batch, split_bytes, tags)
            batch = batch.repartition(default_parallelism(batch.sparkSession), "request_id", "part")
        # A micro-batch reads a fixed list of files, so the records (full
        # parse) and the quarantine (light status pass) read it separately
        # instead of caching the parsed documents.
        (explode_records(parse_documents(batch, cols, tags, keep=[]), cols)
            .write.mode("overwrite").parquet(f"{table_path}/{place}"))
        status = document_status(batch, tags, keep=["request_id", "mlsSid", "error"], probe=cols[0])
        if quarantine_path:
            (quarantine(status, keep=["request_id", "mlsSid"]).write.mode("overwrite")
             .parquet(f"{quarantine_path}/{place}"))
        if log_path:
            message = (F.when(~F.col("fetched"), F.concat(F.lit("ERROR: fetch: "), F.coalesce("error", F.lit("no payload"))))
                       .when(F.col("malformed"), F.lit("ERROR: malformed document")).otherwise(F.lit("")))
            # The parts of a split document count as one payload.
            (status.groupBy("request_id", "mlsSid")
             .agg(F.min("fetched").alias("fetched"), F.max("malformed").alias("malformed"), F.sum("n_records").alias("n"),
                  F.max("error").alias("error"))
             .select("request_id", F.lit(endpoint).alias("endpoint"), "mlsSid",
                     F.when(message == "", F.lit("success")).otherwise(F.lit("failed")).alias("status"),
                     F.when(message == "", F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("rows"),
                     message.alias("message"), F.current_timestamp().alias("finished_at"))
             .write.mode("overwrite").parquet(f"{log_path}/{place}"))
        if manifest_path:
            mine.write.mode("overwrite").parquet(f"{manifest_path}/{place}")
        seen.append(batch_id)

    writer = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return len(seen)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """(path, length, modified, query, batch_id) of the files that the batches loaded."""
    schema = f"path string, length bigint, modified timestamp, {QUERY_COLUMN} string, {BATCH_COLUMN} bigint"
    try:
        return spark.read.schema(schema).parquet(manifest_path)
    except Exception as e:  # nothing loaded yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_incremental(spark: SparkSession, table_path: str, endpoint: str,
                     with_batch: bool = False) -> DataFrame:
    """The incrementally loaded table (declared schema)."""
    schema = T.StructType([*feed_schema(endpoint).fields, T.StructField(QUERY_COLUMN, T.StringType()),
                           T.StructField(BATCH_COLUMN, T.LongType())])
    try:
        df = spark.read.schema(schema).parquet(table_path)
    except Exception as e:  # nothing landed yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    return df if with_batch else df.drop(QUERY_COLUMN, BATCH_COLUMN)


__all__ = ["incremental_load", "read_incremental", "LANDING_PARTITIONS"]
