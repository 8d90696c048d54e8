"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every sluice job relies on.  The XML parser matches element
# names through the analyzer's case rule, so case sensitivity must be on
# for ``<A>`` and ``<a>`` to stay different fields.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of documents are large: a worker takes them in by bytes, not by the thousand.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608b",
    # A micro-batch names its files one by one: they are looked up by some tasks, not by one task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def build_session(master: str | None = None, app: str = "sluice",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Prepare a session built elsewhere: set the runtime settings and ship the
    package.  Call it once; operators only check (:func:`require_conf`)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)


def require_conf(spark: SparkSession) -> None:
    """Raise where the XML parser would mix up fields that differ in case only."""
    if str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() != "true":
        raise ValueError("set spark.sql.caseSensitive=true (sluice.session.build_session or apply_conf does): "
                         "the XML reader would take <A> and <a> for one field")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Ship ``sluice`` to the executors' Python workers, once per application.

    Python steps run in worker processes that import ``sluice``.  The driver
    hands the zip to Spark's own file server (``addPyFile``); no shared folder is
    involved.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # no driver-side context (Spark Connect): install the package instead
        return
    if app in _SHIPPED:
        return
    import os
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    # The context's own folder on the driver: Spark serves the file from there and removes it at the end.
    target = os.path.join(sc._temp_dir, f"sluice-pkg-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session (one JVM, as in tests) may do without: it gets a
    private folder, registered as the checkpoint dir.  On a cluster a folder of
    one machine would lose data, so a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a driver-side context (Spark Connect)
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            d = None
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc is None or not re.match(r"local(\[[^,]*(,\d+)?\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/sluice/{purpose}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the session (shuffle partitions when no context is reachable)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
