"""Feed loads and the run log (O-31 .. O-36).

A load is: landed payloads of a feed -> full parse -> records appended to
the feed's table -> one run-log row per request.  Failures are data: a
failed fetch, a malformed document or a failed write marks the affected
requests ``failed`` with an ``ERROR: ...`` message, and the other requests
and feeds go on.  An all-feed run writes each feed's records in its own
job over the same landed payloads (partition pruning reads each feed's
part); a few of these jobs are submitted at a time, so the tail of one does not
idle the cluster.  The run log of all feeds comes from one light status pass.
Every asked feed is in the log, also one without requests.

Payloads are landed before they are loaded: loads read them more than once, and
a fetch must not run again.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.jsonapi import parse_api, project_api_result
from sluice.operators.xml import document_status, explode_records, parse_documents, quarantine
from sluice.plans.catalog import DEFAULT_ROW_TAGS, FEED_ORDER, UnknownFeed, feed_columns, table_name_of
from sluice.plans.requests import JOB_SPEC
from sluice.session import scratch_path
from sluice.sinks.tables import append_path, append_table

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("feed_ordinal", T.IntegerType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("mlsSid", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("fetch_started_at", T.TimestampType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
])

SUCCESS, FAILED = "success", "failed"
#: Append jobs of different feeds submitted at a time.
JOBS = 4
JOB_COLUMNS = [c.split()[0] for c in JOB_SPEC.split(", ")]


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _col_or(df: DataFrame, name: str, default, dtype: str):
    return F.col(name).cast(dtype) if name in df.columns else F.lit(default).cast(dtype)


def _write(records: DataFrame, table: str | None, path: str | None, fmt: str | None) -> str | None:
    """Append; return the error text instead of raising."""
    try:
        if table:
            append_table(records, table, fmt=fmt, path=path)
        elif path:
            append_path(records, path, fmt or "parquet")
        return None
    except Exception as e:  # any write failure is reported per request
        return f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"


def _landed(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own, unless it is one: only a scan of files (with projections and
    filters that give the same again) can be read again without running anything else again."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        names, todo = set(), [plan]
        while todo:
            node = todo.pop()
            names.add(node.getClass().getSimpleName())
            todo += [node.children().apply(i) for i in range(node.children().size())]
        if plan.deterministic() and names <= {"Project", "Filter", "LogicalRelation", "LocalRelation", "Union"}:
            return df
    except AttributeError:  # no plan to look at (Spark Connect)
        pass
    path = scratch_path(df.sparkSession, "landed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_feed(spark: SparkSession, payloads: DataFrame, endpoint: str, *, table: str | None = None,
              path: str | None = None, fmt: str | None = None, row_tags: Sequence[str] | None = None,
              max_records: int | None = None, run_id: str | None = None,
              feed_ordinal: int | None = None, quarantine_path: str | None = None,
              log_path: str | None = None, check_tags: bool = False) -> DataFrame:
    """O-31: load one feed's payloads; returns its run-log rows (materialised).

    ``table`` defaults to the feed id without '-' and '.'.  ``payloads``
    may hold several feeds; only ``endpoint``'s rows are read.  With
    ``log_path`` the run log is appended there and read back (lineage cut by
    the written table); otherwise it is cached.  ``check_tags`` counts
    children of the root that no configured row tag matched and reports
    them in the message (an extra XPath pass over well-formed documents).
    """
    return load_feeds(spark, payloads, [endpoint],
                      tables={endpoint: table} if table else None,
                      paths={endpoint: path} if path else None, fmt=fmt,
                      row_tags={endpoint: row_tags} if row_tags else None, max_records=max_records,
                      run_id=run_id, feed_ordinals={endpoint: feed_ordinal},
                      quarantine_path=quarantine_path, log_path=log_path, check_tags=check_tags)


def load_feeds(spark: SparkSession, payloads: DataFrame, endpoints: Sequence[str] | None = None, *,
               tables: dict[str, str] | None = None, paths: dict[str, str] | None = None,
               fmt: str | None = None, row_tags: dict[str, Sequence[str]] | None = None,
               max_records: int | None = None, run_id: str | None = None,
               feed_ordinals: dict[str, int | None] | None = None,
               quarantine_path: str | None = None, log_path: str | None = None,
               check_tags: bool = False, journal_path: str | None = None) -> DataFrame:
    """O-31..O-33: load every feed's payloads, each isolated; one run log.

    Per feed, the records come from the full parse of its payloads and are
    appended to its table (one job per feed: each feed has its own table).
    The run log of all feeds then comes from a single light status pass
    (``xml.document_status``) over the same payloads -- no parsed document
    is cached.  Payloads that are not a table yet (a live fetch, a query) are
    written to one first, so that nothing is fetched or computed twice.

    With ``journal_path`` every append is noted there before it starts and after
    it ended, so that the log of a run whose driver was lost in between can be
    made up for (``recover_log``).
    """
    endpoints = list(endpoints or FEED_ORDER)
    if "endpoint" not in payloads.columns:
        if len(endpoints) != 1:
            raise ValueError("payloads without an endpoint column can feed one endpoint only")
        payloads = payloads.withColumn("endpoint", F.lit(endpoints[0]))
    jobs = [{"ordinal": (feed_ordinals or {}).get(e, n), "endpoint": e, "tags": (row_tags or {}).get(e),
             "table": (tables or {}).get(e), "path": (paths or {}).get(e), "max_records": max_records}
            for n, e in enumerate(endpoints)]
    return _load(spark, payloads, jobs, "endpoint", fmt=fmt, run_id=run_id, quarantine_path=quarantine_path,
                 log_path=log_path, check_tags=check_tags, journal_path=journal_path)


def load_jobs(spark: SparkSession, payloads: DataFrame, jobs: Sequence[dict], *, fmt: str | None = None,
              run_id: str | None = None, quarantine_path: str | None = None, log_path: str | None = None,
              check_tags: bool = False, journal_path: str | None = None) -> DataFrame:
    """O-32: load a list of jobs, each from its own payloads (``feed_ordinal`` = the job's ordinal).

    A job is a dict of ``ordinal``, ``endpoint`` and, if wanted, ``tags``,
    ``table`` or ``path`` and ``max_records``.  The same feed may be asked
    several times; every job has its own rows in the run log.  Otherwise as
    ``load_feeds``.
    """
    return _load(spark, payloads, jobs, "feed_ordinal", fmt=fmt, run_id=run_id, quarantine_path=quarantine_path,
                 log_path=log_path, check_tags=check_tags, journal_path=journal_path)


def _source(payloads: DataFrame, key: str) -> DataFrame:
    """The columns that a load reads, as a table."""
    return _landed(payloads.select(
        _col_or(payloads, "request_id", None, "string").alias("request_id"),
        F.coalesce(_col_or(payloads, "part", 0, "int"), F.lit(0)).alias("part"),
        F.coalesce(_col_or(payloads, "first_record", 0, "bigint"), F.lit(0)).alias("first_record"),
        _col_or(payloads, "mlsSid", None, "bigint").alias("mlsSid"),
        _col_or(payloads, "error", None, "string").alias("error"),
        _col_or(payloads, "fetch_started_at", None, "timestamp").alias("fetch_started_at"),
        _col_or(payloads, "fetched_at", None, "timestamp").alias("fetched_at"),
        *([F.col("feed_ordinal").cast("int").alias("feed_ordinal")] if key == "feed_ordinal" else []),
        F.col("endpoint").cast("string").alias("endpoint"), F.col("body")))


def _load(spark: SparkSession, payloads: DataFrame, jobs: Sequence[dict], key: str, *, fmt: str | None, run_id: str | None,
          quarantine_path: str | None, log_path: str | None, check_tags: bool, journal_path: str | None) -> DataFrame:
    """The jobs' appends and their run log; ``key`` tells a payload's job: its endpoint or its feed_ordinal."""
    run_id = run_id or uuid.uuid4().hex
    # Parts of one split document share the request id; the log adds them up.
    split = "part" in payloads.columns
    src = _source(payloads, key)
    unknown, groups, targets = [], {}, {}

    def append(todo: list[dict]) -> list[tuple]:
        done = []
        for job in todo:
            started = _now()
            if journal_path:
                _note(spark, journal_path, run_id, key, job, STARTED, None)
            error = _write(job["records"], job["table"], job["path"], fmt)
            if journal_path:
                _note(spark, journal_path, run_id, key, job, DONE, error)
            done.append((job["endpoint"], job["ordinal"], error, started, _now()))
        return done

    for job in jobs:
        job = {"tags": None, "table": None, "path": None, "max_records": None} | job
        try:
            cols = feed_columns(job["endpoint"])
        except UnknownFeed:
            unknown.append((job["endpoint"], job["ordinal"]))
            continue
        job["tags"] = tags = tuple(job["tags"] or DEFAULT_ROW_TAGS)
        if job["table"] is None and job["path"] is None:
            job["table"] = table_name_of(job["endpoint"])
        of = job["endpoint"] if key == "endpoint" else job["ordinal"]
        job["records"] = explode_records(parse_documents(src.where(F.col(key) == of), cols, tags, keep=[],
                                                         max_records=job["max_records"]), cols)
        # Appends to one target follow each other: their commits would clash.
        targets.setdefault((job["table"], job["path"]), []).append(job)
        groups.setdefault((tags, cols[0], job["max_records"]), []).append(of)
    with ThreadPoolExecutor(max_workers=JOBS) as pool:
        # Threads only submit jobs; rows stay on the executors.
        target = inheritable_thread_target(spark)(append) if len(targets) > 1 else append
        feeds = [done for part in pool.map(lambda todo: target(todo), targets.values()) for done in part]
    return _run_log(spark, src, feeds, groups, key, split=split, run_id=run_id, unknown=unknown, quarantine_path=quarantine_path,
                    log_path=log_path, check_tags=check_tags)


def _run_log(spark: SparkSession, src: DataFrame, feeds: list[tuple], groups: dict, key: str, *, split: bool, run_id: str,
             unknown: list[tuple] = (), quarantine_path: str | None = None, log_path: str | None = None,
             check_tags: bool = False) -> DataFrame:
    """The run log of jobs (endpoint, ordinal, write error, started, finished) whose appends are over."""
    parts = []
    if feeds:
        # One status pass for all jobs: a union of scans, one per row-tag set and cap.
        status = None
        keep = ["request_id", "mlsSid", "error", "endpoint", "fetch_started_at", "fetched_at",
                *(["feed_ordinal"] if key == "feed_ordinal" else [])]
        for (tags, probe, max_records), members in groups.items():
            part = document_status(src.where(F.col(key).isin(sorted(set(members)))), list(tags),
                                   keep=keep,
                                   max_records=max_records, check_tags=check_tags, probe=probe)
            if not check_tags:
                part = part.withColumn("untagged", F.lit(0))
            status = part if status is None else status.unionByName(part)
        if split:
            # a request's parts: at most (document size / split size) rows each
            status = (status.groupBy(*keep)
                            .agg(F.max("fetched").alias("fetched"), F.max("malformed").alias("malformed"),
                                 F.sum("n_records").alias("n_records"), F.sum("untagged").alias("untagged")))
        info = spark.createDataFrame(
            feeds, "endpoint string, feed_ordinal int, write_error string, started_at timestamp, finished_at timestamp")
        # one row per request: cheap to keep while the quarantine and the log read it
        status = status.join(info if key == "endpoint" else info.drop("endpoint"), key).persist(StorageLevel.MEMORY_AND_DISK)
        quarantine_note = ""
        if quarantine_path:
            bad = quarantine(status.withColumn("run_id", F.lit(run_id)), ["run_id", "endpoint", "request_id", "mlsSid"])
            q_error = _write(bad, None, quarantine_path, "parquet")
            quarantine_note = f" (quarantine not written: {q_error})" if q_error else ""
        failed = F.col("write_error").isNotNull() | ~F.col("fetched") | F.col("malformed")
        message = (F.when(F.col("write_error").isNotNull(), F.concat(F.lit("ERROR: write: "), "write_error"))
                    .when(~F.col("fetched"),
                          F.concat(F.lit("ERROR: fetch: "), F.coalesce(F.col("error"), F.lit("no payload"))))
                    .when(F.col("malformed"), F.lit("ERROR: malformed document" + quarantine_note))
                    .when(F.col("untagged") > 0, F.format_string(
                        "WARNING: %d records under unconfigured row tags", F.col("untagged")))
                    .otherwise(F.lit("")))
        parts.append(status.select(
            F.lit(run_id).alias("run_id"), F.col("feed_ordinal").cast("int").alias("feed_ordinal"),
            "request_id", "endpoint", "mlsSid",
            F.when(failed, F.lit(FAILED)).otherwise(F.lit(SUCCESS)).alias("status"),
            F.when(failed, F.lit(0)).otherwise(F.col("n_records")).cast("bigint").alias("rows"),
            message.alias("message"), "fetch_started_at", "fetched_at", "started_at", "finished_at"))
        # A job nobody asked a request of has its result, too.
        idle = info.join(status.select(key).distinct(), key, "left_anti")
        parts.append(idle.select(
            F.lit(run_id).alias("run_id"), "feed_ordinal", F.lit(None).cast("string").alias("request_id"), "endpoint",
            F.lit(None).cast("bigint").alias("mlsSid"),
            F.when(F.col("write_error").isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
            F.lit(0).cast("bigint").alias("rows"),
            F.coalesce(F.concat(F.lit("ERROR: write: "), "write_error"), F.lit("no requests")).alias("message"),
            F.lit(None).cast("timestamp").alias("fetch_started_at"), F.lit(None).cast("timestamp").alias("fetched_at"),
            "started_at", "finished_at"))
    for endpoint, ordinal in unknown:
        own = src.where(F.col("part") == 0)
        own = own.where(F.col("feed_ordinal") == ordinal) if key == "feed_ordinal" else own
        parts.append(_failed_log(own, endpoint, run_id, ordinal, _now(), "ERROR: unknown feed"))
    log = parts[0]
    for more in parts[1:]:
        log = log.unionByName(more)
    log = _materialise(spark, log, log_path, run_id)
    if feeds:
        status.unpersist()
    return log


JOURNAL = ("run_id string, key string, ordinal int, endpoint string, tags array<string>, max_records bigint, state string, "
           "error string, at timestamp")
STARTED, DONE = "started", "done"
INTERRUPTED = "interrupted: the append may or may not be in the table"


def _note(spark: SparkSession, journal_path: str, run_id: str, key: str, job: dict, state: str, error: str | None) -> None:
    row = (run_id, key, job["ordinal"], job["endpoint"], list(job["tags"]), job["max_records"], state, error, _now())
    # A folder for each note: jobs that end at the same time do not disturb each other's commits.
    spark.createDataFrame([row], JOURNAL).coalesce(1).write.parquet(f"{journal_path}/note={uuid.uuid4().hex}")


def recover_log(spark: SparkSession, payloads: DataFrame, journal_path: str, log_path: str, *, run_id: str,
                quarantine_path: str | None = None) -> DataFrame:
    """O-34: make up for the run log of a run whose driver was lost between its appends and its log.

    ``payloads`` are that run's landed payloads.  Jobs in the journal without
    rows in the log get them now, from the same light status pass: those whose
    append had ended as they ended, those whose append had only started as
    failed (``INTERRUPTED``; what to do with their rows is the operator's
    decision).  Jobs that are in the log are left alone, so a second call adds
    nothing.  Returns the run's whole log.
    """
    journal = spark.read.schema(JOURNAL).parquet(journal_path).where(F.col("run_id") == run_id)
    done = F.col("state") == DONE
    jobs = journal.groupBy("key", "ordinal", "endpoint").agg(
        F.first("tags").alias("tags"), F.first("max_records").alias("max_records"), F.max(done).alias("over"),
        F.max(F.when(done, F.col("error"))).alias("error"), F.min("at").alias("started"), F.max("at").alias("finished"))
    try:
        logged = spark.read.schema(RUN_LOG_SCHEMA).parquet(log_path)
    except Exception as e:  # no log at all yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        logged = spark.createDataFrame([], RUN_LOG_SCHEMA)
    mine = logged.where(F.col("run_id") == run_id).select(F.col("feed_ordinal").alias("ordinal")).distinct()
    missing = jobs.join(mine, "ordinal", "left_anti").orderBy("ordinal").collect()     # one row a job
    for key in sorted({j["key"] for j in missing}):
        own = [j for j in missing if j["key"] == key]
        groups: dict = {}
        for j in own:
            of = j["endpoint"] if key == "endpoint" else j["ordinal"]
            groups.setdefault((tuple(j["tags"]), feed_columns(j["endpoint"])[0], j["max_records"]), []).append(of)
        feeds = [(j["endpoint"], j["ordinal"], j["error"] if j["over"] else INTERRUPTED, j["started"], j["finished"]) for j in own]
        _run_log(spark, _source(payloads, key), feeds, groups, key, split="part" in payloads.columns, run_id=run_id,
                 quarantine_path=quarantine_path, log_path=log_path)
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(log_path).where(F.col("run_id") == run_id)


def _materialise(spark: SparkSession, log: DataFrame, log_path: str | None,
                 run_id: str | None = None) -> DataFrame:
    """Fix the (small) run log once: its timestamps and statuses describe
    this run, so it must not be re-derived later.

    Appended to ``log_path`` and read back when given; else cached and
    counted: if its blocks are lost it is recomputed from the landed
    payloads, which stay on durable storage.  A long-lived application
    releases a cached log with ``log.unpersist()`` once it has used it.
    """
    if log_path:
        append_path(log, log_path)
        return spark.read.schema(RUN_LOG_SCHEMA).parquet(log_path).where(F.col("run_id") == run_id)
    log = log.persist(StorageLevel.MEMORY_AND_DISK)
    log.count()
    return log


def _failed_log(payloads: DataFrame, endpoint: str, run_id: str, feed_ordinal: int | None,
                started: _dt.datetime, message: str) -> DataFrame:
    mine = payloads.where(F.col("endpoint") == endpoint) if "endpoint" in payloads.columns else payloads
    return mine.select(
        F.lit(run_id).alias("run_id"), F.lit(feed_ordinal).cast("int").alias("feed_ordinal"),
        _col_or(mine, "request_id", None, "string").alias("request_id"), F.lit(endpoint).alias("endpoint"),
        _col_or(mine, "mlsSid", None, "bigint").alias("mlsSid"), F.lit(FAILED).alias("status"),
        F.lit(0).cast("bigint").alias("rows"), F.lit(message).alias("message"),
        F.lit(None).cast("timestamp").alias("fetch_started_at"), F.lit(None).cast("timestamp").alias("fetched_at"),
        F.lit(started).alias("started_at"), F.lit(_now()).alias("finished_at"))


def feed_summary(run_log: DataFrame) -> DataFrame:
    """One row per asked feed in run order: 'success' or 'ERROR: <n> of <m> requests failed'.

    ``elapsed_sec`` is the feed's own time: from its first request to its last
    answer, and its own append; not the time it waited for other feeds.
    """
    failed = F.sum(F.when(F.col("status") == FAILED, 1).otherwise(0))
    # A failed feed without a request counts as one; an idle feed has none.
    asked = F.sum(F.when(F.col("request_id").isNotNull() | (F.col("status") == FAILED), 1).otherwise(0))
    seconds = lambda c: F.col(c).cast("double")
    fetch = F.coalesce(F.max(seconds("fetched_at")) - F.min(seconds("fetch_started_at")), F.lit(0.0))
    load = F.max(seconds("finished_at")) - F.min(seconds("started_at"))
    return (run_log.groupBy("run_id", "feed_ordinal", "endpoint")
                   .agg(asked.alias("requests"), failed.alias("failed_requests"),
                        F.sum("rows").alias("rows"),
                        F.min(F.coalesce("fetch_started_at", "started_at")).alias("started_at"),
                        F.max("finished_at").alias("finished_at"), (fetch + load).alias("elapsed_sec"))
                   .withColumn("result", F.when(F.col("failed_requests") == 0, F.lit(SUCCESS))
                               .otherwise(F.format_string("ERROR: %d of %d requests failed",
                                                          F.col("failed_requests"), F.col("requests"))))
                   .orderBy("feed_ordinal"))


def feed_results(run_log: DataFrame) -> list[str]:
    """O-32: one result per feed, in run order: 'success' or 'ERROR: ...'
    (one short string per feed reaches the driver)."""
    return [r.result for r in feed_summary(run_log).select("feed_ordinal", "result").collect()]


def load_json_api(spark: SparkSession, payloads: DataFrame, table: str | None = None, *,
                  path: str | None = None, fmt: str | None = None,
                  run_id: str | None = None, quarantine_path: str | None = None) -> tuple[str, str, DataFrame]:
    """O-35: API payloads -> projection -> one append; (status, message, run log).

    All or nothing, like one API job: any failed fetch, malformed payload or
    missing field fails the run and nothing is written.  The check and the write
    both read the landed payloads (a fetch is landed first), one parse each.
    """
    run_id = run_id or uuid.uuid4().hex
    started = _now()
    src = _landed(payloads.select(_col_or(payloads, "request_id", None, "string").alias("request_id"),
                                  _col_or(payloads, "error", None, "string").alias("error"),
                                  _col_or(payloads, "fetch_started_at", None, "timestamp").alias("fetch_started_at"),
                                  _col_or(payloads, "fetched_at", None, "timestamp").alias("fetched_at"), "body"))
    parsed = parse_api(src)
    problem = (F.when(~F.col("fetched"), F.concat(F.lit("fetch: "), F.coalesce("error", F.lit("no payload"))))
                .when(F.col("malformed"), F.lit("malformed payload"))
                .when(F.size("missing") > 0, F.concat(F.lit("missing field "), F.array_join("missing", ", "))))
    # One row per payload, without the parsed values: the check, the quarantine and the log read it.
    seen = parsed.select("request_id", "fetch_started_at", "fetched_at", problem.alias("problem"))
    seen = seen.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = seen.where(F.col("problem").isNotNull())
        first = bad.orderBy("request_id", "problem").select("problem").first()
        if first is not None and quarantine_path:
            _write(bad.select(F.lit(run_id).alias("run_id"), F.lit("api").alias("endpoint"), "request_id",
                              F.col("problem").alias("reason")), None, quarantine_path, "parquet")
        err = _write(project_api_result(parsed), table, path, fmt) if first is None else first["problem"]
        status = SUCCESS if err is None else FAILED
        message = f"{seen.count()} payloads appended" if err is None else f"nothing appended: {err}"
        log = seen.select(
            F.lit(run_id).alias("run_id"), F.lit(0).cast("int").alias("feed_ordinal"),
            "request_id", F.lit("api").alias("endpoint"), F.lit(None).cast("bigint").alias("mlsSid"),
            F.lit(status).alias("status"), F.lit(1 if err is None else 0).cast("bigint").alias("rows"),
            F.when(F.col("problem").isNotNull(), F.concat(F.lit("ERROR: "), "problem"))
             .otherwise(F.lit("" if err is None else f"ERROR: {message}")).alias("message"),
            "fetch_started_at", "fetched_at", F.lit(started).alias("started_at"), F.lit(_now()).alias("finished_at"))
        log = _materialise(spark, log, None)
    finally:
        seen.unpersist()
    return status, message, log


def run_feeds(spark: SparkSession, *, env: str, endpoints: Sequence[str] | None = None,
              from_date: str | None = None, to_date: str | None = None, max_records: int | None = None, **settings) -> DataFrame:
    """The all-feed job: plan -> fetch on executors -> land -> load each feed, in one environment and window.

    One job per endpoint in the given order (an endpoint given twice is two
    jobs); ``settings`` are those of ``run_jobs``, whose run log it returns.
    """
    wanted = list(endpoints or FEED_ORDER)
    specs = spark.createDataFrame([(i, env, e, from_date or "", to_date or "", max_records) for i, e in enumerate(wanted)],
                                  JOB_SPEC)
    return run_jobs(spark, specs, **settings)


def run_jobs(spark: SparkSession, specs: DataFrame, *, landing_path: str, transport=None, answers: DataFrame | None = None,
             as_of=None, feeds: DataFrame | None = None, sources: DataFrame | None = None,
             tables: dict[str, str] | None = None, paths: dict[str, str] | None = None, fmt: str | None = None,
             row_tags: dict[str, Sequence[str]] | None = None, concurrency: int | None = None,
             run_id: str | None = None, quarantine_path: str | None = None, log_table: str | None = None,
             check_tags: bool = False, split_bytes: int | None = None, discover_tags: bool = False,
             journal_path: str | None = None) -> DataFrame:
    """O-32: a run given as a table of job specs (``plans.requests.JOB_SPEC``), each with its own result.

    Every job has its environment, feed, window and record cap; jobs may ask
    for the same feed.  Payloads come from ``transport`` or, without one, from
    a table of ``answers`` (``sources.fetch.replay_payloads``).  Returns the
    run log: one row per request, one for each job without requests and a
    failed one for each that the catalog does not know.  With ``log_table``
    the log is also appended there.  The specs (one row a job) are read by the
    driver, as each job is an append of its own.
    """
    from sluice.plans.catalog import feed_catalog, source_ids
    from sluice.plans.requests import plan_jobs
    from sluice.sources.fetch import fetch_payloads, replay_payloads
    from sluice.sources.landing import land_payloads, read_landed
    from sluice.sources.split import DEFAULT_SPLIT_BYTES

    if (transport is None) == (answers is None):
        raise ValueError("give either a transport or a table of answers")
    run_id = run_id or uuid.uuid4().hex
    started = _now()
    # One run date for the plan and for reading the landing partitions back.
    as_of = str(as_of) if as_of is not None else started.date().isoformat()
    feeds = feeds if feeds is not None else feed_catalog(spark)
    sources = sources if sources is not None else source_ids(spark)
    asked = sorted(specs.collect(), key=lambda j: j["ordinal"])
    if len({j["ordinal"] for j in asked}) < len(asked):
        raise ValueError("job specs need distinct ordinals")
    specs = spark.createDataFrame([tuple(j[c] for c in JOB_COLUMNS) for j in asked], JOB_SPEC)
    requests = plan_jobs(feeds, sources, specs, as_of=as_of)
    split = DEFAULT_SPLIT_BYTES if split_bytes is None else (split_bytes or None)
    # Parts count the records of the tags that the load takes: discovered ones are all children of the root.
    if discover_tags:
        requests = requests.withColumn("row_tags", F.array().cast("array<string>"))
    elif row_tags is not None:
        given = F.lit(None).cast("array<string>")
        for e, tags in row_tags.items():
            if tags:
                given = F.when(F.col("endpoint") == e, F.array(*map(F.lit, tags))).otherwise(given)
        requests = requests.withColumn("row_tags", given)
    payloads = (fetch_payloads(requests, transport, concurrency=concurrency, run_id=run_id, split_bytes=split)
                if transport is not None else replay_payloads(requests, answers, run_id, split))
    land_payloads(payloads, landing_path)
    landed = read_landed(spark, landing_path, load_date=as_of, run_id=run_id)
    # Per-feed settings come from the catalog (configuration, bounded by
    # #environments x #feeds) unless given explicitly.
    config = {(r.env, r.endpoint): r for r in feeds.select("env", "endpoint", "row_tags", "table_name").collect()}
    found: dict[str, list[str]] = {}
    if discover_tags:
        # records are any direct child of the root: add the tags the payloads use
        from sluice.sources.tags import discover_row_tags
        found = discover_row_tags(landed)
    jobs, missed = [], []
    for j in asked:
        e = j["endpoint"]
        if e not in FEED_ORDER or (j["env"], e) not in config:
            missed.append((j["env"], e, j["ordinal"]))
            continue
        own = config[j["env"], e]
        tags = (row_tags or {}).get(e) if row_tags is not None else own.row_tags
        tags = list(dict.fromkeys([*(tags or []), *found.get(e, [])]))
        table = ((tables or {}).get(e) if tables is not None or paths is not None else own.table_name)
        jobs.append({"ordinal": j["ordinal"], "endpoint": e, "tags": tags, "table": table, "path": (paths or {}).get(e),
                     "max_records": j["maxRecords"]})
    log = load_jobs(spark, landed, jobs, fmt=fmt, run_id=run_id, quarantine_path=quarantine_path,
                    check_tags=check_tags, journal_path=journal_path) if jobs else None
    missing = spark.createDataFrame(missed, "env string, endpoint string, feed_ordinal int").select(
        F.lit(run_id).alias("run_id"), "feed_ordinal", F.lit(None).cast("string").alias("request_id"),
        "endpoint", F.lit(None).cast("bigint").alias("mlsSid"), F.lit(FAILED).alias("status"),
        F.lit(0).cast("bigint").alias("rows"), F.lit("ERROR: unknown feed").alias("message"),
        F.lit(None).cast("timestamp").alias("fetch_started_at"), F.lit(None).cast("timestamp").alias("fetched_at"),
        F.lit(started).alias("started_at"), F.lit(_now()).alias("finished_at"))
    out = missing if log is None else log.unionByName(missing)
    if log_table:
        append_table(out, log_table)
    return out
