"""O-01 / O-02: fetch payloads for a request plan on executors.

The request plan is a DataFrame; ``repartition(concurrency)`` bounds how
many requests are in flight at once (one per task, ``DEFAULT_CONCURRENCY``
unless the caller knows what the feed server takes), which replaces the
thread-pool limit of a driver-side loop.  Every request yields exactly one
payload row: a failed or non-200 fetch keeps a null body and its error,
so it shows up in the run log instead of vanishing.  Land the result
(``sources.landing.land_payloads``) before parsing, so a task retry can
never double a request's records.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.catalog import DEFAULT_ROW_TAGS
from sluice.sources.split import DEFAULT_SPLIT_BYTES, split_documents, split_rows

FETCH_INPUT = ["request_id", "feed_ordinal", "endpoint", "mlsSid", "fromDate", "toDate", "url",
               "landing_name", "load_date"]

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("first_record", T.LongType()),
    T.StructField("feed_ordinal", T.IntegerType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("mlsSid", T.LongType()),
    T.StructField("fromDate", T.StringType()),
    T.StructField("toDate", T.StringType()),
    T.StructField("landing_name", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("fetch_started_at", T.TimestampType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("load_date", T.DateType()),
])

#: Requests in flight unless told otherwise: a feed server is not a storage system.
DEFAULT_CONCURRENCY = 4

# Rows / body bytes handed back to Spark per Arrow batch: bodies can be large,
# so a batch is closed at whichever bound is reached first.
_OUT_ROWS = 16
_OUT_BYTES = 64 * 1024 * 1024


def _fetcher(transport, run_id, split_bytes):
    import pandas as pd

    names = [f.name for f in PAYLOAD_SCHEMA.fields]

    def run(batches):
        for pdf in batches:
            out, size = [], 0
            for req in pdf.to_dict("records"):
                started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
                try:
                    status, body, error = transport(req)
                except Exception as e:  # transport bugs must not kill the task
                    status, body, error = None, None, f"{type(e).__name__}: {e}"
                row = {
                    "run_id": run_id, "request_id": req["request_id"], "part": 0, "first_record": 0,
                    "feed_ordinal": req["feed_ordinal"], "endpoint": req["endpoint"], "mlsSid": req["mlsSid"],
                    "fromDate": req["fromDate"], "toDate": req["toDate"],
                    "landing_name": req["landing_name"],
                    "http_status": status, "error": error, "body": body,
                    "fetch_started_at": started,
                    "fetched_at": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
                    "load_date": req["load_date"],
                }
                tags = req.get("row_tags")
                tags = DEFAULT_ROW_TAGS if tags is None else list(tags)
                out.extend(split_rows([row], split_bytes, tags) if split_bytes and body else [row])
                size += len(body) if body else 0
                if len(out) >= _OUT_ROWS or size >= _OUT_BYTES:
                    yield _frame(pd, out, names)
                    out, size = [], 0
            if out:
                yield _frame(pd, out, names)
    return run


def _frame(pd, rows, names):
    df = pd.DataFrame(rows, columns=names)
    df["http_status"] = df["http_status"].astype("Int32")
    df["part"] = df["part"].astype("Int32")
    df["first_record"] = df["first_record"].astype("Int64")
    df["feed_ordinal"] = df["feed_ordinal"].astype("Int32")
    df["mlsSid"] = df["mlsSid"].astype("Int64")
    return df


def fetch_payloads(requests: DataFrame, transport, concurrency: int | None = None,
                   run_id: str | None = None, split_bytes: int | None = DEFAULT_SPLIT_BYTES) -> DataFrame:
    """One payload row per request, fetched by ``transport`` inside tasks.

    Filter the request plan before calling this: predicates cannot pass
    through the fetch, so a filter on its output still fetches everything.
    A body above ``split_bytes`` is split at record boundaries into parts
    (``part`` 0, 1, ...) so that its parse spreads over several tasks
    (``sources.split``); None keeps every body whole.  The parts count the
    records of the request's ``row_tags`` (every child of the root, if empty).
    """
    reqs = requests.select(*FETCH_INPUT, *[c for c in ("row_tags",) if c in requests.columns])
    # Round robin: every task gets its even share of each feed's requests.
    reqs = reqs.repartition(int(concurrency or DEFAULT_CONCURRENCY))
    return reqs.mapInPandas(_fetcher(transport, run_id, split_bytes), PAYLOAD_SCHEMA)


def replay_payloads(requests: DataFrame, answers: DataFrame, run_id: str | None = None,
                    split_bytes: int | None = None) -> DataFrame:
    """One payload row per request without any transport: an equi-join with a table of answers.

    ``answers`` has (endpoint, landing_name, body) - payloads landed before, or
    made by another job - and may have http_status and error.  A request
    without an answer is a 404, as a missing file is; answers under one name
    are loaded each.
    """
    have = lambda c, default: F.col(c) if c in answers.columns else default
    given = answers.select("endpoint", "landing_name", "body", F.lit(True).alias("_found"),
                           have("http_status", F.lit(200)).cast("int").alias("_status"),
                           have("error", F.lit(None)).cast("string").alias("_error"))
    now = F.current_timestamp()
    joined = requests.join(given, ["endpoint", "landing_name"], "left")
    found = F.coalesce("_found", F.lit(False))
    values = {"run_id": F.lit(run_id), "part": F.lit(0), "first_record": F.lit(0),
              "http_status": F.when(found, F.col("_status")).otherwise(F.lit(404)),
              "error": F.when(found, F.col("_error")).otherwise(F.concat(F.lit("not found: "), "landing_name")),
              "fetch_started_at": now, "fetched_at": now}
    out = joined.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in PAYLOAD_SCHEMA.fields])
    return split_documents(out, split_bytes).select(*PAYLOAD_SCHEMA.fieldNames()) if split_bytes else out
