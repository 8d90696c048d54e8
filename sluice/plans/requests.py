"""Request plan: one row per payload to fetch (O-06, O-08, O-09, O-10).

feeds (catalog, bounded) x source ids x one date window, optionally
repeated ``passes`` times.  The expansion is an equi-join on ``env``
against the catalog; the strategy is Spark's, from the catalog's size in
bytes (a few environments x feeds: a broadcast, so the source ids are never
shuffled on a key with two values; adaptive execution splits it otherwise).
No cross join appears in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import as_of_col, default_window
from sluice.functions.names import fill_template, landing_name, table_name

TOKEN_SLOT = "{1}"

REQUEST_COLUMNS = [
    "request_id", "feed_ordinal", "id_ordinal", "pass", "env", "endpoint", "mlsSid",
    "fromDate", "toDate", "url", "landing_name", "table_name", "row_tags", "load_date",
]


def plan_requests(feeds: DataFrame, sources: DataFrame, *, env: str | None = None,
                  endpoints: list[str] | None = None, from_date=None, to_date=None,
                  as_of=None, passes: int = 1, distinct_ids: bool = False,
                  window_days: int | None = None) -> DataFrame:
    """Expand feeds x source ids into requests.

    ``feeds`` is the catalog (``plans.catalog.feed_catalog``); ``sources``
    has (env, mlsSid[, id_ordinal]).  Duplicate ids give duplicate
    requests unless ``distinct_ids``.  ``passes`` > 1 repeats every request
    (a JSON API answering with a different sample per call).

    ``window_days`` splits the window of feeds whose template takes a
    ``toDate`` into consecutive sub-windows of that many days, each written
    like the default window (``fromDate`` = the previous boundary, ``toDate``
    = the next): a hot source's long window becomes several smaller
    responses fetched in parallel.  Feeds without ``toDate`` keep one request.
    """
    if env is not None:
        feeds = feeds.where(F.col("env") == env)
        sources = sources.where(F.col("env") == env)
    if endpoints is not None:
        feeds = feeds.where(F.col("endpoint").isin(list(endpoints)))
    if "id_ordinal" not in sources.columns:
        sources = sources.withColumn("id_ordinal", F.lit(0))
    if distinct_ids:
        sources = sources.dropDuplicates(["env", "mlsSid"])
    frm, to = default_window(from_date, to_date, as_of)
    req = sources.join(feeds, "env")
    if passes > 1:
        req = req.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(int(passes)))))
    else:
        req = req.withColumn("pass", F.lit(1))
    return _as_requests(req.withColumn("fromDate", frm).withColumn("toDate", to), as_of, window_days)


#: One row per job: its place in the run, what it loads, its window (blank: the day before to the run date) and record cap.
JOB_SPEC = "ordinal int, env string, endpoint string, fromDate string, toDate string, maxRecords bigint"


def plan_jobs(feeds: DataFrame, sources: DataFrame, specs: DataFrame, *, as_of=None, window_days: int | None = None) -> DataFrame:
    """O-32 / O-10: the requests of a table of job specs (``JOB_SPEC``), each with its own environment, window and cap.

    An equi-join with the catalog on (env, endpoint) and with the ids on env.
    A job asked twice is planned twice: its requests differ in ``feed_ordinal``,
    the job's ordinal.  Jobs the catalog does not know have no requests
    (``unknown_requests`` finds them).
    """
    if "id_ordinal" not in sources.columns:
        sources = sources.withColumn("id_ordinal", F.lit(0))
    jobs = specs.select(F.col("ordinal").cast("int").alias("feed_ordinal"), "env", "endpoint", F.col("fromDate").alias("_from"),
                        F.col("toDate").alias("_to"), F.col("maxRecords").alias("max_records"))
    frm, to = default_window(F.col("_from"), F.col("_to"), as_of)
    req = (jobs.join(feeds.drop("feed_ordinal"), ["env", "endpoint"]).join(sources, "env")
           .withColumn("pass", F.lit(1)).withColumn("fromDate", frm).withColumn("toDate", to))
    return _as_requests(req, as_of, window_days, "max_records")


def _as_requests(req: DataFrame, as_of, window_days: int | None, *more: str) -> DataFrame:
    run_day = as_of_col(as_of)
    req = req.withColumn("load_date", run_day)
    req = _split_window(req, int(window_days)) if window_days else req.withColumn("_split", F.lit(False))
    url = fill_template(F.col("template"), {0: F.col("base_url"), 2: F.col("mlsSid"),
                                             3: F.col("fromDate"), 4: F.col("toDate")})
    return req.select(
        F.concat_ws(":", "env", "endpoint", F.col("mlsSid").cast("string"),
                    F.col("id_ordinal").cast("string"), F.col("pass").cast("string"),
                    "fromDate", "toDate").alias("request_id"),
        "feed_ordinal", "id_ordinal", "pass", "env", "endpoint", "mlsSid", "fromDate", "toDate",
        url.alias("url"),
        # a sub-window of a split request gets its own landing file
        F.when(F.col("_split"), F.regexp_replace(landing_name(F.col("endpoint"), F.col("mlsSid"), run_day),
                                                 r"\.xml$", F.concat(F.lit("."), F.translate("fromDate", "-", ""),
                                                                      F.lit(".xml"))))
         .otherwise(landing_name(F.col("endpoint"), F.col("mlsSid"), run_day)).alias("landing_name"),
        table_name(F.col("endpoint")).alias("table_name"),
        "row_tags", "load_date", *more,
    )


def _split_window(req: DataFrame, days: int) -> DataFrame:
    lo, hi = F.to_date("fromDate", "MM-dd-yyyy"), F.to_date("toDate", "MM-dd-yyyy")
    starts = F.sequence(lo, F.date_sub(hi, 1), F.expr(f"INTERVAL {days} DAYS"))
    splittable = F.col("template").contains("{4}") & (F.datediff(hi, lo) > days)
    req = (req.withColumn("_split", splittable)
              .withColumn("_start", F.explode(F.when(F.col("_split"), starts).otherwise(F.array(lo)))))
    end = F.when(F.col("_split"), F.least(F.date_add("_start", days), hi)).otherwise(hi)
    return (req.withColumn("toDate", F.date_format(end, "MM-dd-yyyy"))
               .withColumn("fromDate", F.date_format("_start", "MM-dd-yyyy"))
               .drop("_start"))


def plan_api_requests(spark: SparkSession, url: str | DataFrame, passes: int = 2, endpoint: str = "api",
                      as_of=None) -> DataFrame:
    """O-02: an API URL fetched ``passes`` times (each call may answer with a
    different sample), or many: a DataFrame (name, url) gives every name its own
    requests.  Same columns as ``plan_requests``."""
    if isinstance(url, str):
        base = spark.range(1).select(F.lit("").alias("_name"), F.lit(url).alias("url"))
    else:
        base = url.select(F.concat(F.lit("."), F.col("name").cast("string")).alias("_name"), "url")
    run_day = as_of_col(as_of)
    return (base.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(int(passes)))))
                .select(F.concat(F.lit(endpoint), F.col("_name"), F.lit(":"), F.col("pass").cast("string"))
                        .alias("request_id"),
                        F.lit(0).alias("feed_ordinal"), F.lit(0).alias("id_ordinal"), "pass",
                        F.lit(None).cast("string").alias("env"), F.lit(endpoint).alias("endpoint"),
                        F.lit(None).cast("bigint").alias("mlsSid"), F.lit(None).cast("string").alias("fromDate"),
                        F.lit(None).cast("string").alias("toDate"), "url",
                        F.concat(F.lit(endpoint), F.col("_name"), F.lit("."), F.col("pass").cast("string"), F.lit(".json"))
                        .alias("landing_name"),
                        table_name(F.lit(endpoint)).alias("table_name"),
                        F.array().cast("array<string>").alias("row_tags"), run_day.alias("load_date")))


def unknown_requests(wanted: DataFrame, feeds: DataFrame) -> DataFrame:
    """O-07 misses: requested (env, endpoint) pairs absent from the catalog."""
    return wanted.join(feeds.select("env", "endpoint"), ["env", "endpoint"], "left_anti")


_FROM = "coalesce(nullif(:fromDate, ''), date_format(date_sub(to_date(:asOf), 1), 'MM-dd-yyyy'))"
_TO = "coalesce(nullif(:toDate, ''), date_format(to_date(:asOf), 'MM-dd-yyyy'))"
PLAN_SQL = f"""
SELECT concat_ws(':', s.env, f.endpoint, CAST(s.mlsSid AS STRING), CAST(s.id_ordinal AS STRING),
                 '1', {_FROM}, {_TO}) AS request_id,
       f.feed_ordinal, s.id_ordinal, 1 AS pass, s.env, f.endpoint, s.mlsSid, {_FROM} AS fromDate, {_TO} AS toDate,
       replace(replace(replace(replace(f.template, '{{{{0}}}}', f.base_url), '{{{{2}}}}', CAST(s.mlsSid AS STRING)),
               '{{{{3}}}}', {_FROM}), '{{{{4}}}}', {_TO}) AS url
FROM {{sources}} s
JOIN {{feeds}} f ON s.env = f.env
WHERE s.env = :env AND (:endpoint = 'All' OR f.endpoint = :endpoint)
"""


def plan_requests_sql(spark: SparkSession, feeds: DataFrame, sources: DataFrame, *, env: str,
                      endpoint: str = "All", from_date: str = "", to_date: str = "",
                      as_of: str | None = None) -> DataFrame:
    """O-10 for SQL users: the job parameters bound as named parameter markers."""
    import datetime as _dt
    return spark.sql(PLAN_SQL, args={
        "env": env, "endpoint": endpoint, "fromDate": from_date or "", "toDate": to_date or "",
        "asOf": as_of or _dt.date.today().isoformat(),
    }, feeds=feeds, sources=sources)
