"""O-30: the landing area for raw payloads.

Payloads are appended to a parquet table partitioned by endpoint and load
date, and kept for replay: parsing reads this table (partition pruning
picks one feed and day), so fetches are never repeated to re-parse, and a
retried fetch task cannot double records because the landing write is
committed once per job.  Payloads landed by other systems as one file per
document are read with ``read_landed_files``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.fetch import PAYLOAD_SCHEMA
from sluice.sources.files import read_document_files
from sluice.sources.storage import open_filesystem, qualified, remove_dir
from sluice.sources.transport import safe_file_name

LANDING_PARTITIONS = ["endpoint", "load_date"]
# Small row groups bound the parquet reader's batch (it never spans row
# groups), so a batch of large documents cannot grow to 4096 bodies.
LANDING_ROW_GROUP_BYTES = 64 * 1024 * 1024


def land_payloads(payloads: DataFrame, path: str) -> None:
    """Append payload rows to the landing table at ``path``."""
    have = set(payloads.columns)
    defaults = {"part": 0, "first_record": 0}   # an unsplit payload is part 0 of its request
    cols = [(F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
            for f in PAYLOAD_SCHEMA.fields]
    (payloads.select(*cols).write.mode("append").partitionBy(*LANDING_PARTITIONS)
             .option("parquet.block.size", LANDING_ROW_GROUP_BYTES).parquet(path))


_PLAIN = re.compile(r"^[A-Za-z0-9._-]+$")


def partition_path(path: str, endpoint: str | None = None, load_date=None) -> str:
    """Directory (or glob) holding the given partitions, so Spark lists only
    those files instead of the whole landing history."""
    e = "*" if endpoint is None else str(endpoint)
    d = "*" if load_date is None else str(load_date)
    if (endpoint is None and load_date is None) or not (_PLAIN.match(e) or e == "*") \
            or not (_PLAIN.match(d) or d == "*"):
        return path
    return f"{path}/endpoint={e}/load_date={d}"


def read_landed(spark: SparkSession, path: str, endpoint: str | None = None,
                load_date=None, run_id: str | None = None) -> DataFrame:
    """Landed payloads; ``endpoint`` / ``load_date`` select partition
    directories (only they are listed), ``run_id`` keeps one run's payloads
    (pushed to the parquet reader)."""
    where = partition_path(path, endpoint, load_date)
    try:
        df = spark.read.schema(PAYLOAD_SCHEMA).option("basePath", path).parquet(where)
    except Exception as e:  # nothing landed for these partitions yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], PAYLOAD_SCHEMA)
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    if endpoint is not None:
        df = df.where(F.col("endpoint") == endpoint)
    if load_date is not None:
        df = df.where(F.col("load_date") == F.to_date(F.lit(str(load_date))))
    return df


def loaded_partitions(landed: DataFrame, run_log: DataFrame, before) -> DataFrame:
    """(endpoint, load_date, requests) of the landing partitions from before the day ``before`` whose payloads are all loaded.

    A partition is loaded if the log has each of its requests as ``success``
    in the run that landed it; one failed, missing or unknown request keeps
    the partition whole, to be loaded again.
    """
    asked = (landed.where(F.col("load_date") < F.to_date(F.lit(str(before))))
             .select("endpoint", "load_date", "run_id", "request_id").distinct())
    done = (run_log.groupBy(F.col("endpoint").alias("_endpoint"), F.col("run_id").alias("_run"), F.col("request_id").alias("_request"))
            .agg(F.min(F.col("status") == "success").alias("loaded")))
    found = asked.join(done, (F.col("endpoint") == F.col("_endpoint")) & F.col("run_id").eqNullSafe(F.col("_run"))
                       & F.col("request_id").eqNullSafe(F.col("_request")), "left")
    return (found.groupBy("endpoint", "load_date")
            .agg(F.count("*").alias("requests"), F.min(F.coalesce("loaded", F.lit(False))).alias("loaded"))
            .where("loaded").drop("loaded"))


def drop_loaded(spark: SparkSession, path: str, run_log: DataFrame, *, keep_days: int, as_of) -> list[tuple[str, str]]:
    """O-30: remove landing partitions older than ``keep_days`` days whose payloads are all loaded; returns those removed.

    A load never reads such a partition again (the run log says it is done), so
    removing it is safe at any time; a call that was interrupted goes on with
    the next one.  Only whole partition folders go, one Hadoop call for each;
    their names reach the driver, no payload does.
    """
    before = spark.range(1).select(F.date_sub(F.to_date(F.lit(str(as_of))), int(keep_days)).cast("string")).first()[0]
    gone = []
    for r in loaded_partitions(read_landed(spark, path), run_log, before).orderBy("endpoint", "load_date").collect():
        if not _PLAIN.match(r["endpoint"]):
            raise ValueError(f"not a partition name to remove: {r['endpoint']}")
        if remove_dir(spark, f"{path.rstrip('/')}/endpoint={r['endpoint']}/load_date={r['load_date']}"):
            gone.append((r["endpoint"], str(r["load_date"])))
    return gone


def read_landed_files(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """One row per landed document file: (file_name, file_path, body, error); see ``sources.files``."""
    return read_document_files(spark, path, glob).select("file_name", "file_path", "body", "error")


def _writer(root: str):
    import pandas as pd

    def run(batches):
        filesystem, base = open_filesystem(root)
        made = set()
        for pdf in batches:
            out = []
            for endpoint, name, data in zip(pdf["endpoint"], pdf["landing_name"], pdf["content"]):
                d = f"{base}/{endpoint}"
                if d not in made:
                    filesystem.create_dir(d, recursive=True)
                    made.add(d)
                # Same name -> same bytes: a retried task rewrites the same file.
                with filesystem.open_output_stream(f"{d}/{safe_file_name(name)}") as f:
                    f.write(data)
                out.append((endpoint, name, len(data)))
            yield pd.DataFrame(out, columns=["endpoint", "landing_name", "bytes"])
    return run


def export_documents(payloads: DataFrame, root: str) -> DataFrame:
    """Write each payload body as its own file ``<root>/<endpoint>/<landing_name>``
    (the name made safe with ``transport.safe_file_name``)
    (what a file-drop feed delivers): the body in UTF-8, or a binary column
    ``content`` as it is.  Lazy: returns (endpoint, landing_name, bytes) and
    writes when that frame is evaluated."""
    root = qualified(payloads.sparkSession, root)
    content = F.col("content") if "content" in payloads.columns else F.col("body").cast("binary")
    return (payloads.where(content.isNotNull())
                    .select("endpoint", "landing_name", content.alias("content"))
                    .mapInPandas(_writer(root), "endpoint string, landing_name string, bytes long"))
