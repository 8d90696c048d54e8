"""Feed workloads over the TPC-H-like test tables.

The feed protocol has no public sample data, so payloads are derived from
the driver's tables: rows are serialised into XML / JSON documents with
Spark's own writers (``to_xml`` / ``to_json``), then loaded back through the
sluice operators.  Every query reads whole tables and its work grows with
them.  Documents group rows by a unique key range (``DOC_ROWS`` records at
most), so no document can grow with a skewed key.

Each query has a DuckDB statement in ``ORACLE_SQL`` computing the same
result straight from the tables.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import default_window
from sluice.functions.names import landing_name, table_name, xml_text
from sluice.loads import feed_summary, load_feed, load_feeds, load_json_api, run_feeds, run_jobs
from sluice.operators import filters as FL
from sluice.operators.jsonapi import (infer_json_schema, parse_api, parse_json, parse_json_elements, project_api_result,
                                      read_json_files)
from sluice.operators.sets import concat_by_name, union_all
from sluice.operators.xml import (build_documents, document_status, empty_feed_frame, parse_documents, parse_records,
                                  parse_tagged_records, quarantine, to_declared)
from sluice.plans.catalog import (FEED_ORDER, FEED_URL_TEMPLATES, example_base_url, feed_catalog,
                                  feed_columns)
from sluice.plans.requests import plan_api_requests, plan_requests, plan_requests_sql, unknown_requests
from sluice.session import default_parallelism, scratch_path
from sluice.sinks.tables import append_table
from sluice.sources.fetch import fetch_payloads, replay_payloads
from sluice.sources.landing import drop_loaded, export_documents, land_payloads, read_landed, read_landed_files
from sluice.sources.split import split_documents
from sluice.sources.storage import qualified
from sluice.sources.tags import discover_row_tags
from sluice.sources.transport import FileTransport
from sluice.streaming.incremental import incremental_load, read_incremental

DOC_ROWS = 64          # records per document built from a unique key range
AS_OF = "2022-06-17"   # fixed run date of the planning queries
LISTINGS = "listings-3.0"
AGENTS_ALL = "agents-all-1.0"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Payload builders
# --------------------------------------------------------------------------

# listings-3.0 field <- expression over orders x customer x nation
LISTING_FIELDS = {
    "mlsSid": "CAST(c_nationkey AS STRING)",
    "listAgentId": "CAST(o_custkey AS STRING)",
    "listAgentFirstName": "c_name",
    "dom": "o_orderpriority",
    "dateList": "date_format(o_orderdate, 'MM-dd-yyyy')",
    "listPrice": "format_string('%.2f', o_totalprice)",
    "state": "n_name",
    "bank": "c_mktsegment",
    "statusCode": "o_orderstatus",
    "listingId": "CAST(o_orderkey AS STRING)",
}
LISTING_FIELDS_SQL = {
    "mlsSid": "CAST(c_nationkey AS VARCHAR)",
    "listAgentId": "CAST(o_custkey AS VARCHAR)",
    "listAgentFirstName": "c_name",
    "dom": "o_orderpriority",
    "dateList": "strftime(o_orderdate, '%m-%d-%Y')",
    "listPrice": "printf('%.2f', o_totalprice)",
    "state": "n_name",
    "bank": "c_mktsegment",
    "statusCode": "o_orderstatus",
    "listingId": "CAST(o_orderkey AS VARCHAR)",
}


def listing_payloads(spark: SparkSession, d: str, key_range: int = DOC_ROWS) -> DataFrame:
    """listings-3.0 documents: one request per (source id = nation, order-key range);
    a document holds the source's orders among ``key_range`` consecutive keys."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("c_nationkey").cast("bigint").alias("src"),
                     F.expr(f"o_orderkey div {int(key_range)}").alias("chunk"),
                     *[F.expr(e).alias(k) for k, e in _listing_order()]))
    docs = build_documents(rows, ["src", "chunk"], [k for k, _ in _listing_order()])
    return docs.select(
        F.concat_ws(":", F.col("src").cast("string"), F.col("chunk").cast("string")).alias("request_id"),
        F.lit(LISTINGS).alias("endpoint"), F.col("src").alias("mlsSid"), "chunk", "body")


def _listing_order():
    # listingId first: documents sort their records by the first field.
    first = [("listingId", LISTING_FIELDS["listingId"])]
    return first + [(k, v) for k, v in LISTING_FIELDS.items() if k != "listingId"]


def listing_oracle(where: str = "") -> str:
    cols = ", ".join(f"{LISTING_FIELDS_SQL[c]} AS {c}" if c in LISTING_FIELDS_SQL else f"CAST(NULL AS VARCHAR) AS {c}"
                     for c in feed_columns(LISTINGS))
    return (f"SELECT {cols} FROM orders JOIN customer ON o_custkey = c_custkey "
            f"JOIN nation ON c_nationkey = n_nationkey {where}")


def row_documents(df: DataFrame, key: str | None = None, rows: int = DOC_ROWS) -> DataFrame:
    """Documents of at most ``rows`` records.  With a unique ``key`` the
    grouping is ``key div rows``; tables without one (lineitem) use the
    scan position, which is stable for a given set of input files."""
    doc = F.expr(f"`{key}` div {rows}") if key else F.floor(F.monotonically_increasing_id() / rows)
    return build_documents(df.withColumn("_doc", doc), "_doc", df.columns).withColumnRenamed("_doc", "doc")


def cast_back(df: DataFrame, like: DataFrame) -> DataFrame:
    """Parsed strings back to the source column types (compare values, not text)."""
    types = {f.name: f.dataType for f in like.schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

def q_feed_listings30(spark: SparkSession, d: str) -> DataFrame:
    """O-03/O-14/O-16: listings-3.0 payloads -> the feed's 40-column string table."""
    return parse_records(listing_payloads(spark, d), feed_columns(LISTINGS))


def _roundtrip(spark: SparkSession, d: str, name: str, key: str | None) -> DataFrame:
    src = table(spark, d, name)
    docs = row_documents(src, key)
    return cast_back(parse_records(docs, src.columns), src)


def q_xml_roundtrip_orders(spark: SparkSession, d: str) -> DataFrame:
    """O-03/O-05/O-16: orders -> XML documents -> records equal to orders."""
    return _roundtrip(spark, d, "orders", "o_orderkey")


def q_xml_roundtrip_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return _roundtrip(spark, d, "lineitem", None)


def q_xml_split_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """Hot-source documents: lineitem in documents of 4096 records, split at
    record boundaries into ~256 KB parts, parsed part by part."""
    src = table(spark, d, "lineitem")
    docs = row_documents(src, None, rows=4096)
    parts = split_documents(docs.select("doc", "body"), max_bytes=256 * 1024)
    return cast_back(parse_records(parts, src.columns), src)


def q_xml_documents_text(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts (up to ~130k chars) through XML escaping and back."""
    return _roundtrip(spark, d, "documents", "doc_id")


def q_xml_missing_fields(spark: SparkSession, d: str) -> DataFrame:
    """O-16: a field left out of a record reads back as null."""
    c = table(spark, d, "customer")
    src = c.withColumn("c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_name")))
    return cast_back(parse_records(row_documents(src, "c_custkey"), c.columns), c)


def _customer_docs_with_damage(spark: SparkSession, d: str, rows: int = 8) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer")
    docs = build_documents(c.withColumn("doc", F.expr(f"c_custkey div {rows}")), "doc", c.columns,
                           extra=[F.max(F.col("c_acctbal") < 0).alias("has_negative"),
                                  F.max(F.col("c_acctbal") > 9900).alias("has_high")])
    # A document holding a negative balance arrives truncated (malformed).
    body = F.when(F.col("has_negative"), F.expr("substring(body, 1, length(body) - 5)")).otherwise(F.col("body"))
    return c, docs.select("doc", "has_negative", "has_high", body.alias("body"))


def q_xml_bad_payloads(spark: SparkSession, d: str) -> DataFrame:
    """O-20: malformed documents are rejected whole; the others load."""
    c, docs = _customer_docs_with_damage(spark, d)
    return cast_back(parse_records(docs, c.columns), c)


def q_xml_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """O-20: which documents were rejected and why."""
    c, docs = _customer_docs_with_damage(spark, d)
    status = document_status(docs, keep=["doc"], probe="c_custkey")
    return quarantine(status, keep=["doc"]).withColumnRenamed("doc", "doc_key")


def q_xml_trailing_content(spark: SparkSession, d: str) -> DataFrame:
    """O-20: a second root, text after the root or an undeclared prefix rejects a document whole;
    comments, processing instructions and blanks after the root do not."""
    o = table(spark, d, "orders")
    docs = row_documents(o, "o_orderkey")
    after = F.element_at(F.array(*[F.lit(x) for x in TRAILERS]), (F.col("doc") % len(TRAILERS)).cast("int") + 1)
    body = F.concat(F.col("body"), after)
    # one kind repeats the root's own name inside and stays one document
    nested = F.regexp_replace(F.regexp_replace("body", "^(?s)(.*?<r>)", "$1<note><r>x</r></note>"), r"\s+$", "")
    body = F.when(F.col("doc") % len(TRAILERS) == NESTED_AT, nested).otherwise(body)
    return cast_back(parse_records(docs.select("doc", body.alias("body")), o.columns), o)


# What follows the root, by document number; those of BAD_TRAILERS make the document malformed.
TRAILERS = ["", "\n<!-- end </r> -->\n", "<?done now?>", "<r><row><o_orderkey>1</o_orderkey></row></r>", "junk",
            "<q/>", "", "\n \n"]
BAD_TRAILERS, NESTED_AT = (3, 4, 5), 6


def q_xml_first_duplicate(spark: SparkSession, d: str) -> DataFrame:
    """O-03: repeated element -> first one; empty first element -> null."""
    p = table(spark, d, "part")
    recs = p.select(
        "p_partkey",
        F.array("p_name", "p_brand").alias("p_name"),
        F.when(F.col("p_size") < 10, F.array(F.lit(""), F.col("p_type")))
         .otherwise(F.array(F.col("p_type"), F.col("p_brand"))).alias("p_type"),
        "p_size")
    docs = build_documents(recs.withColumn("doc", F.expr(f"p_partkey div {DOC_ROWS}")), "doc",
                           ["p_partkey", "p_name", "p_type", "p_size"])
    out = parse_records(docs, ["p_partkey", "p_name", "p_type", "p_size"])
    return out.select(F.col("p_partkey").cast("bigint"), "p_name", "p_type", F.col("p_size").cast("int"))


ORDER_TAGS = {"O": "open", "F": "closed", "P": "partial"}


def q_xml_row_tags(spark: SparkSession, d: str) -> DataFrame:
    """O-03: records under several row tags in one document."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tag = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in ORDER_TAGS.items()])
    docs = build_documents(o.withColumn("doc", F.expr(f"o_orderkey div {DOC_ROWS}")).withColumn("tag", tag),
                           "doc", ["o_orderkey", "o_orderstatus", "o_totalprice"],
                           tag_col="tag", tags=list(ORDER_TAGS.values()))
    out = parse_tagged_records(docs, ["o_orderkey", "o_orderstatus", "o_totalprice"],
                               list(ORDER_TAGS.values()))
    return out.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus",
                      F.col("o_totalprice").cast("double"), "row_tag")


def q_xml_discovered_tags(spark: SparkSession, d: str) -> DataFrame:
    """O-03 'any child of the root is a record': the row tags are discovered
    from the documents (distributed scan), then every record is read."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tag = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in ORDER_TAGS.items()])
    docs = build_documents(o.withColumn("doc", F.expr(f"o_orderkey div {DOC_ROWS}")).withColumn("tag", tag),
                           "doc", ["o_orderkey", "o_orderstatus", "o_totalprice"],
                           tag_col="tag", tags=list(ORDER_TAGS.values()))
    docs = docs.withColumn("endpoint", F.lit("orders-1.0"))
    tags = discover_row_tags(docs)["orders-1.0"]
    out = parse_records(docs, ["o_orderkey", "o_orderstatus", "o_totalprice"], tags)
    return cast_back(out, o)


def q_cap_records(spark: SparkSession, d: str) -> DataFrame:
    """O-23 within a payload: the first 10 records of each document."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    docs = row_documents(o, "o_orderkey")
    out = parse_records(docs, ["o_orderkey", "o_custkey"], keep=["doc"], max_records=10)
    return out.select(F.col("doc").alias("doc_key"), F.col("o_orderkey").cast("bigint"),
                      F.col("o_custkey").cast("bigint"))


def q_cap_split_documents(spark: SparkSession, d: str) -> DataFrame:
    """O-23 on parts: the first 1000 records of each document, split or not."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    docs = row_documents(o, "o_orderkey", rows=4096).select("doc", "body")
    parts = split_documents(docs, max_bytes=32 * 1024)
    out = parse_records(parts, ["o_orderkey", "o_custkey"], keep=["doc"], max_records=1000)
    return out.select(F.col("doc").alias("doc_key"), F.col("o_orderkey").cast("bigint"),
                      F.col("o_custkey").cast("bigint"))


CAP_TAGS = ["open", "closed"]


def q_cap_split_tags(spark: SparkSession, d: str) -> DataFrame:
    """O-23 over several tags: the first 700 records of each document in document order, whatever their tags; other
    children do not count.  Whole documents and their parts give the same records."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    record = F.format_string("<%1$s><o_orderkey>%2$d</o_orderkey><o_custkey>%3$d</o_custkey></%1$s>",
                             F.when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "F", "closed")
                             .otherwise("note"), F.col("o_orderkey"), F.col("o_custkey"))
    docs = (o.groupBy(F.expr("o_orderkey div 4096").alias("doc"))
            .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", record.alias("x")))).alias("xs"))
            .select("doc", F.concat(F.lit("<r>"), F.array_join(F.transform("xs", lambda x: x["x"]), ""), F.lit("</r>")).alias("body")))
    out = None
    for form, payloads in (("whole", docs), ("split", split_documents(docs, 32 * 1024, CAP_TAGS))):
        got = parse_records(payloads, ["o_orderkey", "o_custkey"], CAP_TAGS, keep=["doc"], max_records=700).select(
            F.lit(form).alias("form"), F.col("doc").alias("doc_key"), F.col("o_orderkey").cast("bigint"),
            F.col("o_custkey").cast("bigint"))
        out = got if out is None else out.unionAll(got)
    return out


def q_cap_per_request(spark: SparkSession, d: str) -> DataFrame:
    """O-23 across payloads: two orders per customer, lowest keys first."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return FL.cap_records_per_key(o, "o_custkey", "o_orderkey", 2)


def _api_body(fraction: str, whole: str, segment: str):
    """An API answer with a fractional latitude and an integral longitude; every field has a value of its own."""
    return F.to_json(F.struct(
        F.lit(200).alias("status"),
        F.struct(F.col("n_name").alias("country"), F.col("r_name").alias("european_electoral_region"),
                 F.col(fraction).alias("latitude"), F.col(whole).cast("bigint").alias("longitude"),
                 F.col(segment).alias("parliamentary_constituency"),
                 F.col("r_name").alias("region")).alias("result")))


def _with_nation(spark: SparkSession, d: str, rows: DataFrame, key: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return rows.join(n, F.col(key) == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))


def q_json_api_payloads(spark: SparkSession, d: str) -> DataFrame:
    """O-04/O-17/O-18/O-19: API payloads -> the flat all-string projection, numbers by their own type."""
    rows = _with_nation(spark, d, table(spark, d, "customer"), "c_nationkey")
    payloads = rows.select("c_custkey", _api_body("c_acctbal", "c_nationkey", "c_mktsegment").alias("body"))
    return project_api_result(parse_api(payloads), keep=["c_custkey"])


def q_json_project_events(spark: SparkSession, d: str) -> DataFrame:
    """O-04/O-17/O-18/O-19 on the events' JSON properties."""
    e = table(spark, d, "events").select("event_id", "event_type", F.col("props").alias("body"))
    parsed = parse_json(e, "k bigint", keep=["event_id", "event_type"])
    return parsed.select("event_id", "event_type", F.col("j.k").cast("string").alias("k"),
                         F.lit("").alias("vld_status"), F.lit("").alias("vld_status_reason"))


def q_json_inferred_events(spark: SparkSession, d: str) -> DataFrame:
    """O-04 with an inferred schema (merged over all payloads on executors)."""
    e = table(spark, d, "events").select("event_id", F.col("props").alias("body"))
    ddl = infer_json_schema(e)
    parsed = parse_json(e, ddl, keep=["event_id"])
    return parsed.select("event_id", F.col("j.k").cast("bigint").alias("k"))


def q_json_array_events(spark: SparkSession, d: str) -> DataFrame:
    """O-04: payloads that are arrays at the top level: a row per element, the schema inferred over the elements."""
    e = table(spark, d, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    payloads = (e.groupBy(F.expr("event_id div 100").alias("doc"))
                .agg(F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "k")))).alias("body")))
    parsed = parse_json_elements(payloads, infer_json_schema(payloads), keep=["doc"])
    return parsed.select(F.col("doc").alias("doc_key"), F.col("place").cast("bigint").alias("place"), "j.event_id", "j.event_type",
                         "j.k", "malformed")


def q_json_pages(spark: SparkSession, d: str) -> DataFrame:
    """O-04 on large text payloads: whole HTML pages inside JSON bodies."""
    p = table(spark, d, "pages")
    payload = p.select("page_id", F.to_json(F.struct("url", "html")).alias("body"))
    parsed = parse_json(payload, "url string, html string", keep=["page_id"])
    return parsed.select("page_id", "j.url", "j.html")


def q_json_files_events(spark: SparkSession, d: str) -> DataFrame:
    """O-04 from files: events' JSON written as files, read back with an inferred schema."""
    path = scratch_path(spark, "json-files")
    (table(spark, d, "events").select(F.to_json(F.struct("event_id", "event_type", F.col("props").alias("props")))
                                      .alias("value"))
        .write.text(path))
    df = read_json_files(spark, path)
    return df.select("event_id", "event_type", F.col("props").alias("props"))


def q_xml_file_drops(spark: SparkSession, d: str) -> DataFrame:
    """O-03/O-30 from files: listings-3.0 documents dropped one file each, read whole, parsed."""
    drop = scratch_path(spark, "xml-drop")
    # one file per (source, 2048 order keys): file drops are few and large
    docs = listing_payloads(spark, d, key_range=2048).select(
        "endpoint", F.concat(F.col("request_id"), F.lit(".xml")).alias("landing_name"), "body")
    export_documents(docs, drop).agg(F.sum("bytes")).collect()
    files = read_landed_files(spark, drop)
    return parse_records(files, feed_columns(LISTINGS))


# How dropped files are written, by document number; those of BAD_ENCODINGS hold bytes that do not fit.
ENCODINGS = ["utf-8", "utf-8 marked", "latin-1 declared", "utf-16 marked", "latin-1 undeclared", "utf-16 cut", "unknown declared"]
BAD_ENCODINGS = {4: "undecodable body: not UTF-8", 5: "undecodable body: not UTF-16LE",
                 6: "undecodable body: unknown encoding X-UNHEARD"}


def _encoded_files(spark: SparkSession, d: str) -> DataFrame:
    """customer documents with letters beyond ASCII, one file each, in several encodings."""
    c = table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" Núñez")).alias("c_name"), "c_mktsegment")
    docs = row_documents(c, "c_custkey", rows=16)
    kind = F.col("doc") % len(ENCODINGS)
    said = lambda name: F.concat(F.lit(f'<?xml version="1.0" encoding="{name}"?>'), F.col("body"))
    utf16 = F.concat(F.lit(bytearray(b"\xff\xfe")), F.encode(said("UTF-16"), "UTF-16LE"))
    content = (F.when(kind == 0, F.encode("body", "UTF-8"))
                .when(kind == 1, F.concat(F.lit(bytearray(b"\xef\xbb\xbf")), F.encode("body", "UTF-8")))
                .when(kind == 2, F.encode(said("ISO-8859-1"), "ISO-8859-1"))
                .when(kind == 3, utf16)
                .when(kind == 4, F.encode("body", "ISO-8859-1"))
                .when(kind == 5, F.expr("substring(_utf16, 1, octet_length(_utf16) - 1)"))
                .otherwise(F.encode(said("x-unheard"), "UTF-8")))
    return (docs.withColumn("_utf16", utf16)
            .select(F.lit("customers").alias("endpoint"), F.concat(F.col("doc").cast("string"), F.lit(".xml")).alias("landing_name"),
                    content.alias("content")))


def q_xml_file_encodings(spark: SparkSession, d: str) -> DataFrame:
    """O-03/O-30: dropped files in several encodings, read byte for byte: records of those that fit, an error for the others."""
    drop = scratch_path(spark, "xml-drop")
    export_documents(_encoded_files(spark, d), drop).agg(F.sum("bytes")).collect()
    files = read_landed_files(spark, drop)
    doc = F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint").alias("doc")
    good = parse_records(files, ["c_custkey", "c_name", "c_mktsegment"], keep=["file_name"])
    return (good.select(doc, F.col("c_custkey").cast("bigint"), "c_name", F.lit(None).cast("string").alias("error"))
            .unionAll(files.where(F.col("error").isNotNull()).select(
                doc, F.lit(None).cast("bigint"), F.lit(None).cast("string"), "error")))


def q_incremental_file_log(spark: SparkSession, d: str) -> DataFrame:
    """O-37: the same files as a stream: what the run log says of each."""
    drop, out, log = scratch_path(spark, "xml-drop"), scratch_path(spark, "incr"), scratch_path(spark, "incr-log")
    export_documents(_encoded_files(spark, d), drop).agg(F.sum("bytes")).collect()
    incremental_load(spark, f"{drop}/customers", LISTINGS, out, scratch_path(spark, "incr-ckpt"), files=True, log_path=log)
    return spark.read.parquet(log).select("request_id", "status", "rows", "message")


def q_request_plan_sql(spark: SparkSession, d: str) -> DataFrame:
    """O-10: the request plan as SQL with named parameter markers."""
    s = table(spark, d, "supplier")
    env = F.when(F.col("s_nationkey") < 13, F.lit("dev")).otherwise(F.lit("uat"))
    sources = s.select(env.alias("env"), F.col("s_suppkey").alias("mlsSid"), F.lit(0).alias("id_ordinal"))
    parts = [plan_requests_sql(spark, feed_catalog(spark), sources, env=e, from_date="06-16-2022",
                               as_of=AS_OF) for e in ("dev", "uat")]
    return parts[0].unionByName(parts[1]).select("request_id", "env", "endpoint", "mlsSid", "fromDate",
                                                 "toDate", "url")


def q_union_all_names(spark: SparkSession, d: str) -> DataFrame:
    """O-21: UNION ALL by position, duplicates kept."""
    c = table(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("source"), F.col("s_name").alias("name"))
    return union_all(c, s, c)


def q_concat_by_name(spark: SparkSession, d: str) -> DataFrame:
    """O-22: concat by column name; missing columns are null."""
    c = table(spark, d, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    s = table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").alias("key"),
        F.lit("supplier").alias("source"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"))
    return concat_by_name(c, s)


def _supplier_sources(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    env = F.when(F.col("s_nationkey") < 13, F.lit("dev")).otherwise(F.lit("uat"))
    base = s.select(env.alias("env"), F.col("s_suppkey").alias("mlsSid"), F.lit(0).alias("id_ordinal"))
    # A source id listed twice is fetched twice.
    twice = s.where(F.col("s_acctbal") > 9000).select(env.alias("env"), F.col("s_suppkey").alias("mlsSid"),
                                                      F.lit(1).alias("id_ordinal"))
    return base.unionByName(twice)


def _supplier_plan(spark: SparkSession, d: str) -> DataFrame:
    return plan_requests(feed_catalog(spark), _supplier_sources(spark, d),
                         from_date="06-16-2022", to_date="", as_of=AS_OF)


def q_request_plan(spark: SparkSession, d: str) -> DataFrame:
    """O-06/O-07/O-09: feeds x source ids x window, duplicates kept."""
    return _supplier_plan(spark, d).select("request_id", "env", "endpoint", "mlsSid", "fromDate", "toDate",
                                           "table_name", "landing_name")


def q_request_urls(spark: SparkSession, d: str) -> DataFrame:
    """O-08/O-10: request URLs from the templates; the token slot stays unfilled."""
    return _supplier_plan(spark, d).select("request_id", "url")


def q_default_window(spark: SparkSession, d: str) -> DataFrame:
    """O-09/O-24/O-27: blank dates default to the day before / the day of as_of."""
    o = table(spark, d, "orders")
    frm_in = (F.when(F.col("o_orderstatus") == "O", F.lit("01-01-1990"))
               .when(F.col("o_orderstatus") == "F", F.lit("")))
    to_in = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("12-31-1999")).otherwise(F.lit(""))
    frm, to = default_window(frm_in, to_in, F.to_date("o_orderdate"))
    return o.select("o_orderkey", frm.alias("fromDate"), to.alias("toDate"),
                    landing_name(F.lit("orders-1.0"), F.col("o_orderkey"), F.to_date("o_orderdate"))
                    .alias("landing_name"))


def q_filter_status(spark: SparkSession, d: str) -> DataFrame:
    """O-11: status=F (status=All would keep every row)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return FL.filter_status(o, "o_orderstatus", "F")


def q_filter_dates(spark: SparkSession, d: str) -> DataFrame:
    """O-12: inclusive MM-dd-yyyy window on a timestamp column."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return FL.filter_dates(o, "o_orderdate", "01-01-1995", "12-31-1995")


def q_filter_search(spark: SparkSession, d: str) -> DataFrame:
    """O-13: searchBy=c_mktsegment, searchStr=BUILDING."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return FL.filter_search(c, "c_mktsegment", "BUILDING")


def q_filter_feed_records(spark: SparkSession, d: str) -> DataFrame:
    """O-11..O-13 on loaded, all-text feed records."""
    recs = q_feed_listings30(spark, d)
    recs = FL.filter_status(recs, "statusCode", "F")
    recs = FL.filter_dates(recs, "dateList", "01-01-1995", "06-30-1996")
    recs = FL.filter_search(recs, "bank", "BUILDING")
    return recs.select("mlsSid", "listAgentId", "listPrice", "dateList", "statusCode", "bank")


def q_table_names(spark: SparkSession, d: str) -> DataFrame:
    """O-25/O-26: sanitised names and landing file names."""
    p = table(spark, d, "part")
    raw = F.concat(F.col("p_type"), F.lit("-"), F.col("p_brand"), F.lit("."), F.col("p_size").cast("string"))
    return p.select("p_partkey", raw.alias("raw_name"), table_name(raw).alias("table_name"),
                    landing_name(F.lit("part-1.0"), F.col("p_partkey"), AS_OF).alias("landing_name"))


def q_append_twice(spark: SparkSession, d: str) -> DataFrame:
    """O-28/O-29: two appends to one table; re-running a range duplicates it."""
    o = table(spark, d, "orders")
    recs = parse_records(row_documents(o, "o_orderkey"), o.columns).persist()
    name = f"sluice_append_{uuid.uuid4().hex[:10]}"
    path = scratch_path(spark, "append")
    append_table(recs, name, fmt="parquet", path=path)
    append_table(recs, name, fmt="parquet", path=path)
    recs.unpersist()
    spark.catalog.refreshTable(name)
    return cast_back(spark.table(name), o)


def q_raw_landing(spark: SparkSession, d: str) -> DataFrame:
    """O-01/O-30: documents dropped as files -> fetched by request -> landed -> parsed."""
    o = table(spark, d, "orders")
    docs = row_documents(o, "o_orderkey")
    drop = scratch_path(spark, "drop")
    named = docs.select("doc", F.lit("orders-1.0").alias("endpoint"),
                        F.concat(F.lit("orders."), F.col("doc").cast("string"), F.lit(".xml")).alias("landing_name"),
                        "body")
    export_documents(named, drop).agg(F.sum("bytes")).collect()
    requests = named.select(
        F.col("doc").cast("string").alias("request_id"), F.lit(0).alias("feed_ordinal"), "endpoint",
        F.col("doc").alias("mlsSid"), F.lit("").alias("fromDate"), F.lit("").alias("toDate"),
        F.lit("file").alias("url"), "landing_name", F.to_date(F.lit(AS_OF)).alias("load_date"))
    landing = scratch_path(spark, "landing")
    land_payloads(fetch_payloads(requests, FileTransport(qualified(spark, drop)), concurrency=default_parallelism(spark)),
                  landing)
    payloads = read_landed(spark, landing, endpoint="orders-1.0", load_date=AS_OF)
    parsed = parse_documents(payloads, o.columns, keep=["mlsSid", "http_status"])
    return parsed.select(F.col("mlsSid").alias("doc_key"), F.col("n_records").cast("bigint").alias("n_records"),
                         "http_status")


def _agent_payloads(spark: SparkSession, d: str) -> DataFrame:
    """agents-all-1.0 payloads from customer; some truncated, some not fetched."""
    c2 = table(spark, d, "customer").select(
        F.expr(f"c_custkey div 8").alias("doc"),
        F.col("c_custkey").cast("string").alias("agentId"),
        F.col("c_nationkey").cast("string").alias("mlsSid"),
        F.col("c_name").alias("agentFirstName"),
        F.col("c_nationkey").cast("string").alias("agentOfficeId"),
        F.col("c_mktsegment").alias("agentStatus"),
        (F.col("c_acctbal") < 0).alias("neg"), (F.col("c_acctbal") > 9900).alias("high"))
    agents = build_documents(c2, "doc", ["agentId", "mlsSid", "agentFirstName", "agentOfficeId", "agentStatus"],
                             extra=[F.max("neg").alias("has_negative"), F.max("high").alias("has_high")])
    body = (F.when(F.col("has_high"), F.lit(None).cast("string"))
             .when(F.col("has_negative"), F.expr("substring(body, 1, length(body) - 5)"))
             .otherwise(F.col("body")))
    return agents.select(F.col("doc").cast("string").alias("request_id"), F.lit(AGENTS_ALL).alias("endpoint"),
                         F.col("doc").alias("mlsSid"),
                         F.when(F.col("has_high"), F.lit("HTTP 503")).alias("error"), body.alias("body"))


def _landed_agent_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The agents-all-1.0 payloads landed first, then read back: the load
    reads the landing table, as in production."""
    landing = scratch_path(spark, "landing")
    land_payloads(_agent_payloads(spark, d).withColumn("load_date", F.to_date(F.lit(AS_OF))), landing)
    return read_landed(spark, landing, endpoint=AGENTS_ALL, load_date=AS_OF)


def q_feed_load_log(spark: SparkSession, d: str) -> DataFrame:
    """O-31..O-34/O-36: one feed load; run log per request (time columns left out)."""
    path = scratch_path(spark, "feed")
    log = load_feed(spark, _landed_agent_payloads(spark, d), AGENTS_ALL, path=path)
    return log.select("request_id", "endpoint", "status", "rows", "message")


def q_feed_load_rows(spark: SparkSession, d: str) -> DataFrame:
    """O-31/O-28: what the feed load appended (the agents-all-1.0 table)."""
    path = scratch_path(spark, "feed")
    load_feed(spark, _landed_agent_payloads(spark, d), AGENTS_ALL, path=path)
    return spark.read.parquet(path)


def q_json_load_log(spark: SparkSession, d: str) -> DataFrame:
    """O-02/O-35: every API URL (one per customer) planned for two passes, answered by join from a table of landed answers
    (no transport), landed, projected, appended once."""
    rows = _with_nation(spark, d, table(spark, d, "customer"), "c_nationkey")
    urls = rows.select(F.col("c_custkey").alias("name"), F.lit("https://api.example.com/v1").alias("url"))
    requests = plan_api_requests(spark, urls, passes=2, as_of=AS_OF)
    body = _api_body("c_acctbal", "c_nationkey", "c_mktsegment").alias("body")
    name = F.format_string("api.%d.%d.json", F.col("c_custkey"), F.col("pass"))
    answers = scratch_path(spark, "api-answers")
    (rows.withColumn("pass", F.explode(F.array(F.lit(1), F.lit(2))))
     .select(F.lit("api").alias("endpoint"), name.alias("landing_name"), body).write.parquet(answers))
    landing = scratch_path(spark, "landing")
    land_payloads(replay_payloads(requests, spark.read.parquet(answers)), landing)
    path = scratch_path(spark, "api")
    status, _message, log = load_json_api(spark, read_landed(spark, landing, endpoint="api", load_date=AS_OF), path=path)
    done = log.where("status = 'success'").count()
    return spark.read.parquet(path).withColumn("run_status", F.lit(status)).withColumn("logged", F.lit(done).cast("bigint"))


def _filled_payloads(spark: SparkSession, d: str) -> DataFrame:
    """For every feed and supplier a document with every declared column filled with its own value."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    docs = None
    for e in FEED_ORDER:
        cols = [F.col("s_suppkey").cast("string").alias("mlsSid") if c == "mlsSid" else
                F.concat(F.lit(f"{c}: "), "s_name", F.lit(" & "), F.col("s_suppkey").cast("string")).alias(c)
                for c in feed_columns(e)]
        one = s.select((F.col("s_suppkey") / DOC_ROWS).cast("bigint").alias("doc"), *cols)
        one = build_documents(one, "doc", feed_columns(e)).select(
            F.lit(e).alias("endpoint"), F.concat(F.lit(e + ":"), F.col("doc").cast("string")).alias("request_id"), "body",
            F.to_date(F.lit(AS_OF)).alias("load_date"))
        docs = one if docs is None else docs.unionAll(one)
    return docs


def q_feed_values(spark: SparkSession, d: str) -> DataFrame:
    """O-14..O-16/O-31: the loaded rows of all eight feeds, every declared column filled: name and value of each."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "feeds")
    land_payloads(_filled_payloads(spark, d), landing)
    load_feeds(spark, read_landed(spark, landing, load_date=AS_OF), FEED_ORDER, paths={e: f"{root}/{e}" for e in FEED_ORDER})
    out = None
    for e in FEED_ORDER:
        rows = spark.read.parquet(f"{root}/{e}")
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), F.col(c).alias("v"))
                                     for i, c in enumerate(rows.columns)]))
        one = rows.select(F.lit(e).alias("endpoint"), "mlsSid", values.alias("x")).select(
            "endpoint", "mlsSid", F.col("x.i").alias("place"), F.col("x.c").alias("field"), F.col("x.v").alias("field_value"))
        out = one if out is None else out.unionAll(one)
    return out


def q_feed_empty(spark: SparkSession, d: str) -> DataFrame:
    """O-05: a feed without records has its declared columns; rows of other columns fit in by name."""
    c = table(spark, d, "customer").select(F.col("c_name").alias("agentFirstName"), F.col("c_custkey").alias("agentId"),
                                           F.col("c_acctbal").alias("other"))
    return empty_feed_frame(spark, AGENTS_ALL).unionAll(to_declared(c, AGENTS_ALL))


def q_request_misses(spark: SparkSession, d: str) -> DataFrame:
    """O-07: asked (env, endpoint) pairs that the catalog does not have."""
    s = table(spark, d, "supplier")
    env = F.when(F.col("s_nationkey") < 9, F.lit("dev")).when(F.col("s_nationkey") < 18, F.lit("uat")).otherwise(F.lit("prod"))
    known = F.array(*[F.lit(e) for e in FEED_ORDER])
    endpoint = F.when(F.col("s_acctbal") >= 0, F.get(known, (F.col("s_suppkey") % len(FEED_ORDER)).cast("int"))) \
        .otherwise(F.concat(F.lit("feed-"), F.col("s_suppkey").cast("string")))
    asked = s.select("s_suppkey", env.alias("env"), endpoint.alias("endpoint"))
    return unknown_requests(asked, feed_catalog(spark)).select("s_suppkey", "env", "endpoint")


def q_incremental_load(spark: SparkSession, d: str) -> DataFrame:
    """O-37: two landings, three availableNow runs; every record exactly once."""
    payloads = listing_payloads(spark, d).select(
        "request_id", F.lit(0).alias("feed_ordinal"), "endpoint", "mlsSid", F.lit("").alias("fromDate"),
        F.lit("").alias("toDate"), F.concat(F.col("request_id"), F.lit(".xml")).alias("landing_name"),
        F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"), "body",
        F.current_timestamp().alias("fetched_at"), F.to_date(F.lit(AS_OF)).alias("load_date"))
    landing = scratch_path(spark, "landing")
    out = scratch_path(spark, "incr")
    ckpt = scratch_path(spark, "incr-ckpt")
    # Two landings that together hold every payload: sources 0-11, then 12-24.
    land_payloads(payloads.where(F.col("mlsSid") < 12), landing)
    incremental_load(spark, landing, LISTINGS, out, ckpt)
    land_payloads(payloads.where(F.col("mlsSid") >= 12), landing)
    incremental_load(spark, landing, LISTINGS, out, ckpt)
    incremental_load(spark, landing, LISTINGS, out, ckpt)   # nothing new: no rows added
    return read_incremental(spark, out, LISTINGS)


def q_incremental_restart(spark: SparkSession, d: str) -> DataFrame:
    """O-37: a second checkpoint on the same table adds its own records and replaces none."""
    payloads = listing_payloads(spark, d).select(
        "request_id", "endpoint", "mlsSid", "body", F.to_date(F.lit(AS_OF)).alias("load_date"))
    out = scratch_path(spark, "incr")
    for part in (F.col("mlsSid") < 12, F.col("mlsSid") >= 12):
        landing = scratch_path(spark, "landing")
        land_payloads(payloads.where(part), landing)
        incremental_load(spark, landing, LISTINGS, out, scratch_path(spark, "incr-ckpt"))
    return read_incremental(spark, out, LISTINGS)


def q_incremental_lost_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    """O-37: the same landing loaded again with a new checkpoint: the manifest knows its files, nothing doubles."""
    payloads = listing_payloads(spark, d).select(
        "request_id", "endpoint", "mlsSid", "body", F.to_date(F.lit(AS_OF)).alias("load_date"))
    landing, out, manifest = scratch_path(spark, "landing"), scratch_path(spark, "incr"), scratch_path(spark, "incr-manifest")
    for part in (F.col("mlsSid") < 12, F.col("mlsSid") >= 12):
        land_payloads(payloads.where(part), landing)
        incremental_load(spark, landing, LISTINGS, out, scratch_path(spark, "incr-ckpt"), manifest_path=manifest)
    return read_incremental(spark, out, LISTINGS)


def q_landing_retention(spark: SparkSession, d: str) -> DataFrame:
    """O-30: five days of agent payloads, damaged ones on two of them, loaded; days that are over and loaded whole are
    dropped from the landing, the others stay: what the landing still holds."""
    payloads = _agent_payloads(spark, d)
    day = (F.col("mlsSid") % 5).cast("int")
    damaged = day.isin(1, 3)
    payloads = payloads.where(damaged | (F.col("error").isNull() & F.col("body").endswith("</r>")))
    landing, log = scratch_path(spark, "landing"), scratch_path(spark, "run-log")
    land_payloads(payloads.withColumn("run_id", F.lit("run-1"))
                  .withColumn("load_date", F.date_sub(F.to_date(F.lit(AS_OF)), day)), landing)
    load_feed(spark, read_landed(spark, landing), AGENTS_ALL, path=scratch_path(spark, "feed"), log_path=log, run_id="run-1")
    drop_loaded(spark, landing, spark.read.parquet(log), keep_days=1, as_of=AS_OF)
    return read_landed(spark, landing).select("request_id", "endpoint", F.datediff(F.to_date(F.lit(AS_OF)), "load_date").alias("age"))


def q_job_specs_run(spark: SparkSession, d: str) -> DataFrame:
    """O-32/O-10: a run given as a table of jobs (one per nation, one of them asked twice), each with its own environment,
    feed, window and record cap: one result for each, in order, and the window its requests asked for."""
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    known = F.array(*[F.lit(e) for e in FEED_ORDER])
    key = F.col("n_nationkey")
    specs = n.select(
        key.cast("int").alias("ordinal"), F.when(F.col("n_regionkey") < 3, "dev").otherwise("uat").alias("env"),
        F.when(key % 12 == 11, F.concat(F.lit("feed-"), key.cast("string")))
         .otherwise(F.get(known, (key % len(FEED_ORDER)).cast("int"))).alias("endpoint"),
        F.element_at(F.array(F.lit(""), F.lit("06-01-2022"), F.lit("06-10-2022")), (key % 3).cast("int") + 1).alias("fromDate"),
        F.when(key % 2 == 0, "").otherwise("06-15-2022").alias("toDate"),
        F.when(key % 5 == 0, 1).cast("bigint").alias("maxRecords"))
    specs = specs.unionAll(specs.where("ordinal = 3").withColumn("ordinal", F.lit(25)))
    sources = s.select(F.when(F.col("s_nationkey") < 13, "dev").otherwise("uat").alias("env"), F.col("s_suppkey").alias("mlsSid"))
    answers = scratch_path(spark, "job-answers")
    body = F.format_string("<r><row><mlsSid>%1$d</mlsSid></row><row><mlsSid>%1$d</mlsSid></row></r>", F.col("s_suppkey"))
    (s.where(F.col("s_acctbal") >= 0).select(F.explode(known).alias("endpoint"), F.col("s_suppkey"), body.alias("body"))
     .select("endpoint", landing_name(F.col("endpoint"), F.col("s_suppkey"), AS_OF).alias("landing_name"), "body")
     .write.parquet(answers))
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "jobs")
    log = run_jobs(spark, specs, answers=spark.read.parquet(answers), landing_path=landing, as_of=AS_OF, sources=sources,
                   paths={e: f"{root}/{e}" for e in FEED_ORDER})
    asked = read_landed(spark, landing, load_date=AS_OF).groupBy("feed_ordinal").agg(
        F.concat_ws(" ", F.min("fromDate"), F.max("fromDate"), F.min("toDate"), F.max("toDate")).alias("window"))
    return (feed_summary(log).join(asked, "feed_ordinal", "left")
            .select("feed_ordinal", "endpoint", "requests", "failed_requests", "rows", "result", "window"))


def q_all_feeds_run(spark: SparkSession, d: str) -> DataFrame:
    """O-01/O-06..O-08/O-30..O-34/O-36 end to end: every feed x every supplier
    id (as 'dev' sources) is planned, fetched from dropped files, landed and
    loaded; suppliers with a negative balance have no file (404).  One feed is
    not in the catalog and one table cannot be written (an unknown store).  A
    second run in an environment without source ids has its results, too.  One
    summary row per feed, in run order; no feed's time holds the others'."""
    s = table(spark, d, "supplier")
    sources = s.select(F.lit("dev").alias("env"), F.col("s_suppkey").alias("mlsSid"))
    reqs = plan_requests(feed_catalog(spark), sources, env="dev", from_date="06-16-2022", as_of=AS_OF)
    drop = scratch_path(spark, "drop")
    present = reqs.join(s.where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("mlsSid"),
                                                                "s_name", "s_nationkey"), "mlsSid")
    # Each feed's first three declared columns carry the supplier's fields.
    second = F.coalesce(*[F.when(F.col("endpoint") == e, F.lit(feed_columns(e)[1])) for e in FEED_ORDER])
    third = F.coalesce(*[F.when(F.col("endpoint") == e, F.lit(feed_columns(e)[2])) for e in FEED_ORDER])
    body = F.format_string("<r><row><mlsSid>%d</mlsSid><%s>%s</%s><%s>%d</%s></row></r>",
                           F.col("mlsSid"), second, xml_text("s_name"), second, third, F.col("s_nationkey"), third)
    export_documents(present.select("endpoint", "landing_name", body.alias("body")), drop) \
        .agg(F.sum("bytes")).collect()
    root = scratch_path(spark, "feeds")
    paths = {e: f"{root}/{e}" for e in FEED_ORDER}
    paths[UNWRITABLE] = f"unknown-store://{root.rpartition('/')[2]}"
    catalog = feed_catalog(spark)
    catalog = catalog.where((F.col("endpoint") != UNLISTED) | (F.col("env") != "dev"))
    began = time.time()
    log = run_feeds(spark, env="dev", from_date="06-16-2022", as_of=AS_OF, transport=FileTransport(qualified(spark, drop)),
                    sources=sources, landing_path=scratch_path(spark, "landing"), paths=paths, feeds=catalog,
                    concurrency=default_parallelism(spark))
    idle = run_feeds(spark, env="uat", from_date="06-16-2022", as_of=AS_OF, transport=FileTransport(qualified(spark, drop)),
                     sources=sources, landing_path=scratch_path(spark, "landing"), feeds=catalog,
                     paths={e: f"{root}-uat/{e}" for e in FEED_ORDER})
    took = time.time() - began
    own = (F.col("elapsed_sec") >= 0) & (F.col("elapsed_sec") <= F.lit(took)) & (F.col("finished_at") >= F.col("started_at"))
    runs = feed_summary(log).withColumn("env", F.lit("dev")).unionByName(feed_summary(idle).withColumn("env", F.lit("uat")))
    return runs.select("env", "feed_ordinal", "endpoint", "requests", "failed_requests", "rows", "result",
                       own.alias("own_time"))


UNLISTED, UNWRITABLE = FEED_ORDER[3], FEED_ORDER[5]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_listings30": q_feed_listings30,
    "xml_roundtrip_orders": q_xml_roundtrip_orders,
    "xml_roundtrip_lineitem": q_xml_roundtrip_lineitem,
    "xml_split_lineitem": q_xml_split_lineitem,
    "xml_documents_text": q_xml_documents_text,
    "xml_missing_fields": q_xml_missing_fields,
    "xml_bad_payloads": q_xml_bad_payloads,
    "xml_quarantine": q_xml_quarantine,
    "xml_trailing_content": q_xml_trailing_content,
    "xml_first_duplicate": q_xml_first_duplicate,
    "xml_row_tags": q_xml_row_tags,
    "xml_discovered_tags": q_xml_discovered_tags,
    "cap_records": q_cap_records,
    "cap_split_documents": q_cap_split_documents,
    "cap_split_tags": q_cap_split_tags,
    "cap_per_request": q_cap_per_request,
    "json_api_payloads": q_json_api_payloads,
    "json_project_events": q_json_project_events,
    "json_inferred_events": q_json_inferred_events,
    "json_array_events": q_json_array_events,
    "json_pages": q_json_pages,
    "json_files_events": q_json_files_events,
    "xml_file_drops": q_xml_file_drops,
    "xml_file_encodings": q_xml_file_encodings,
    "incremental_file_log": q_incremental_file_log,
    "request_plan_sql": q_request_plan_sql,
    "union_all_names": q_union_all_names,
    "concat_by_name": q_concat_by_name,
    "request_plan": q_request_plan,
    "request_urls": q_request_urls,
    "default_window": q_default_window,
    "filter_status": q_filter_status,
    "filter_dates": q_filter_dates,
    "filter_search": q_filter_search,
    "filter_feed_records": q_filter_feed_records,
    "table_names": q_table_names,
    "append_twice": q_append_twice,
    "raw_landing": q_raw_landing,
    "feed_load_log": q_feed_load_log,
    "feed_load_rows": q_feed_load_rows,
    "json_load_log": q_json_load_log,
    "feed_values": q_feed_values,
    "feed_empty": q_feed_empty,
    "request_misses": q_request_misses,
    "incremental_load": q_incremental_load,
    "incremental_restart": q_incremental_restart,
    "incremental_lost_checkpoint": q_incremental_lost_checkpoint,
    "landing_retention": q_landing_retention,
    "job_specs_run": q_job_specs_run,
    "all_feeds_run": q_all_feeds_run,
}


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

def _catalog_values() -> str:
    rows = []
    for env in ("dev", "uat"):
        for i, e in enumerate(FEED_ORDER):
            rows.append(f"('{env}', '{e}', {i}, '{example_base_url(env, e)}', '{FEED_URL_TEMPLATES[e]}')")
    return "(VALUES " + ", ".join(rows) + ") AS f(env, endpoint, feed_ordinal, base_url, template)"


_SOURCES_SQL = """(SELECT CASE WHEN s_nationkey < 13 THEN 'dev' ELSE 'uat' END AS env, s_suppkey AS mlsSid,
        0 AS id_ordinal FROM supplier
 UNION ALL
 SELECT CASE WHEN s_nationkey < 13 THEN 'dev' ELSE 'uat' END, s_suppkey, 1 FROM supplier WHERE s_acctbal > 9000) s"""

_PLAN_SQL = f"""SELECT concat_ws(':', s.env, f.endpoint, CAST(s.mlsSid AS VARCHAR), CAST(s.id_ordinal AS VARCHAR),
  '1', '06-16-2022', '06-17-2022') AS request_id, s.id_ordinal, s.env, f.endpoint, s.mlsSid,
  '06-16-2022' AS fromDate, '06-17-2022' AS toDate,
  replace(replace(f.endpoint, '-', ''), '.', '') AS table_name,
  concat_ws('.', f.endpoint, CAST(s.mlsSid AS VARCHAR), '06172022', 'xml') AS landing_name,
  replace(replace(replace(replace(f.template, '{{0}}', f.base_url), '{{2}}', CAST(s.mlsSid AS VARCHAR)),
          '{{3}}', '06-16-2022'), '{{4}}', '06-17-2022') AS url
FROM {_SOURCES_SQL} JOIN {_catalog_values()} ON s.env = f.env"""

_API_FIELDS_SQL = """'200' AS status, n_name AS country, r_name AS european_electoral_region,
  CAST({0} AS VARCHAR) AS latitude, CAST({1} AS VARCHAR) AS longitude, {2} AS parliamentary_constituency,
  r_name AS region, '' AS vld_status, '' AS vld_status_reason"""
_CUSTOMER_API_SQL = ("SELECT c_custkey, " + _API_FIELDS_SQL.format("c_acctbal", "c_nationkey", "c_mktsegment")
                     + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
_API_LOAD_SQL = ("SELECT 'success' AS run_status, (SELECT 2 * count(*) FROM customer) AS logged, "
                 + _API_FIELDS_SQL.format("c_acctbal", "c_nationkey", "c_mktsegment")
                 + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")

_FIELDS_SQL = ", ".join(f"('{e}', {i}, '{c}')" for e in FEED_ORDER for i, c in enumerate(feed_columns(e)))

_AGENT_LOG_SQL = f"""SELECT CAST(c_custkey // 8 AS VARCHAR) AS request_id, '{AGENTS_ALL}' AS endpoint,
  CASE WHEN bool_or(c_acctbal > 9900) OR bool_or(c_acctbal < 0) THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN bool_or(c_acctbal > 9900) OR bool_or(c_acctbal < 0) THEN 0 ELSE count(*) END AS rows,
  CASE WHEN bool_or(c_acctbal > 9900) THEN 'ERROR: fetch: HTTP 503'
       WHEN bool_or(c_acctbal < 0) THEN 'ERROR: malformed document' ELSE '' END AS message
FROM customer GROUP BY c_custkey // 8"""

ORACLE_SQL: dict[str, str] = {
    "feed_listings30": listing_oracle(),
    "xml_roundtrip_orders": "SELECT * FROM orders",
    "xml_roundtrip_lineitem": "SELECT * FROM lineitem",
    "xml_split_lineitem": "SELECT * FROM lineitem",
    "xml_documents_text": "SELECT doc_id, NULLIF(text, '') AS text, lang, source, n_chars FROM documents",
    "xml_missing_fields": ("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name, c_nationkey, "
                           "c_acctbal, c_mktsegment FROM customer"),
    "xml_bad_payloads": ("SELECT * FROM customer WHERE c_custkey // 8 NOT IN "
                         "(SELECT c_custkey // 8 FROM customer WHERE c_acctbal < 0)"),
    "xml_quarantine": ("SELECT DISTINCT c_custkey // 8 AS doc_key, 'malformed document' AS reason "
                       "FROM customer WHERE c_acctbal < 0"),
    "xml_first_duplicate": ("SELECT p_partkey, p_name, CASE WHEN p_size < 10 THEN NULL ELSE p_type END AS p_type, "
                            "p_size FROM part"),
    "xml_row_tags": ("SELECT o_orderkey, o_orderstatus, o_totalprice, CASE o_orderstatus "
                     + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ORDER_TAGS.items())
                     + " END AS row_tag FROM orders"),
    "xml_discovered_tags": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "cap_records": (f"SELECT doc_key, o_orderkey, o_custkey FROM (SELECT o_orderkey // {DOC_ROWS} AS doc_key, "
                    f"o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_orderkey // {DOC_ROWS} "
                    f"ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 10"),
    "cap_split_tags": ("WITH t AS (SELECT o_orderkey // 4096 AS doc_key, o_orderkey, o_custkey, row_number() OVER (PARTITION BY "
                       "o_orderkey // 4096 ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus IN ('O', 'F')) "
                       "SELECT form, doc_key, o_orderkey, o_custkey FROM t JOIN (VALUES ('whole'), ('split')) AS f(form) ON rn <= 700"),
    "cap_per_request": ("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER "
                        "(PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 2"),
    "json_api_payloads": _CUSTOMER_API_SQL,
    "json_project_events": ("SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, "
                            "'' AS vld_status, '' AS vld_status_reason FROM events"),
    "json_inferred_events": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "json_array_events": ("SELECT event_id // 100 AS doc_key, row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 "
                          "AS place, event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, false AS malformed "
                          "FROM events"),
    "json_pages": "SELECT page_id, url, html FROM pages",
    "json_files_events": "SELECT event_id, event_type, props FROM events",
    "xml_file_drops": listing_oracle(),
    "xml_file_encodings": (
        f"SELECT c_custkey // 16 AS doc, c_custkey, concat(c_name, ' Núñez') AS c_name, CAST(NULL AS VARCHAR) AS error FROM customer "
        f"WHERE (c_custkey // 16) % {len(ENCODINGS)} NOT IN {tuple(BAD_ENCODINGS)} UNION ALL "
        f"SELECT DISTINCT c_custkey // 16, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CASE (c_custkey // 16) % {len(ENCODINGS)} "
        + " ".join(f"WHEN {k} THEN '{v}'" for k, v in BAD_ENCODINGS.items())
        + f" END FROM customer WHERE (c_custkey // 16) % {len(ENCODINGS)} IN {tuple(BAD_ENCODINGS)}"),
    "incremental_file_log": (
        f"SELECT concat(doc, '.xml') AS request_id, CASE WHEN message = '' THEN 'success' ELSE 'failed' END AS status, "
        f"CASE WHEN message = '' THEN n ELSE 0 END AS rows, message FROM (SELECT c_custkey // 16 AS doc, count(*) AS n, "
        f"CASE (c_custkey // 16) % {len(ENCODINGS)} "
        + " ".join(f"WHEN {k} THEN 'ERROR: fetch: {v}'" for k, v in BAD_ENCODINGS.items())
        + " ELSE '' END AS message FROM customer GROUP BY c_custkey // 16)"),
    "request_plan_sql": ("SELECT request_id, env, endpoint, mlsSid, fromDate, toDate, url FROM ("
                         + _PLAN_SQL + ") WHERE id_ordinal = 0"),
    "union_all_names": ("SELECT 'customer' AS source, c_name AS name FROM customer UNION ALL "
                        "SELECT 'supplier', s_name FROM supplier UNION ALL SELECT 'customer', c_name FROM customer"),
    "concat_by_name": ("SELECT 'customer' AS source, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, "
                       "c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer UNION ALL "
                       "SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"),
    "request_plan": (f"SELECT request_id, env, endpoint, mlsSid, fromDate, toDate, table_name, landing_name "
                     f"FROM ({_PLAN_SQL})"),
    "request_urls": f"SELECT request_id, url FROM ({_PLAN_SQL})",
    "default_window": ("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '01-01-1990' "
                       "ELSE strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY, '%m-%d-%Y') END AS fromDate, "
                       "CASE WHEN o_orderpriority = '1-URGENT' THEN '12-31-1999' "
                       "ELSE strftime(o_orderdate, '%m-%d-%Y') END AS toDate, "
                       "concat_ws('.', 'orders-1.0', CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%m%d%Y'), "
                       "'xml') AS landing_name FROM orders"),
    "filter_status": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
    "filter_dates": ("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' "
                     "AND o_orderdate < TIMESTAMP '1996-01-01'"),
    "filter_search": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_feed_records": ("SELECT CAST(c_nationkey AS VARCHAR) AS mlsSid, CAST(o_custkey AS VARCHAR) AS listAgentId, "
                            "printf('%.2f', o_totalprice) AS listPrice, "
                            "strftime(o_orderdate, '%m-%d-%Y') AS dateList, o_orderstatus AS statusCode, "
                            "c_mktsegment AS bank FROM orders JOIN customer ON o_custkey = c_custkey "
                            "WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' "
                            "AND DATE '1996-06-30' AND c_mktsegment = 'BUILDING'"),
    "table_names": ("SELECT p_partkey, concat(p_type, '-', p_brand, '.', CAST(p_size AS VARCHAR)) AS raw_name, "
                    "replace(replace(concat(p_type, '-', p_brand, '.', CAST(p_size AS VARCHAR)), '-', ''), '.', '') "
                    "AS table_name, concat_ws('.', 'part-1.0', CAST(p_partkey AS VARCHAR), '06172022', 'xml') "
                    "AS landing_name FROM part"),
    "append_twice": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "raw_landing": (f"SELECT o_orderkey // {DOC_ROWS} AS doc_key, count(*) AS n_records, 200 AS http_status "
                    f"FROM orders GROUP BY 1"),
    "feed_load_log": _AGENT_LOG_SQL,
    "feed_load_rows": ("SELECT CAST(c_custkey AS VARCHAR) AS agentId, CAST(c_nationkey AS VARCHAR) AS mlsSid, "
                       "c_name AS agentFirstName, CAST(NULL AS VARCHAR) AS agentLastName, "
                       "CAST(c_nationkey AS VARCHAR) AS agentOfficeId, c_mktsegment AS agentStatus FROM customer "
                       "WHERE c_custkey // 8 NOT IN (SELECT c_custkey // 8 FROM customer "
                       "WHERE c_acctbal < 0 OR c_acctbal > 9900)"),
    "json_load_log": f"{_API_LOAD_SQL} UNION ALL {_API_LOAD_SQL}",
    "feed_values": ("SELECT f.endpoint, CAST(s_suppkey AS VARCHAR) AS mlsSid, CAST(f.place AS INTEGER) AS place, f.field, "
                    "CASE f.field WHEN 'mlsSid' THEN CAST(s_suppkey AS VARCHAR) ELSE concat(f.field, ': ', s_name, ' & ', "
                    "CAST(s_suppkey AS VARCHAR)) END AS field_value "
                    f"FROM supplier JOIN (VALUES {_FIELDS_SQL}) AS f(endpoint, place, field) ON true"),
    "feed_empty": ("SELECT CAST(NULL AS VARCHAR) AS mlsSid, CAST(c_custkey AS VARCHAR) AS agentId, c_name AS agentFirstName, "
                   "CAST(NULL AS VARCHAR) AS agentLastName, CAST(NULL AS VARCHAR) AS agentOfficeId, "
                   "CAST(NULL AS VARCHAR) AS agentStatus FROM customer"),
    "request_misses": ("SELECT s_suppkey, CASE WHEN s_nationkey < 9 THEN 'dev' WHEN s_nationkey < 18 THEN 'uat' ELSE 'prod' END "
                       "AS env, CASE WHEN s_acctbal >= 0 THEN list_extract([" + ", ".join(f"'{e}'" for e in FEED_ORDER)
                       + f"], CAST(s_suppkey % {len(FEED_ORDER)} + 1 AS INTEGER)) "
                       "ELSE concat('feed-', CAST(s_suppkey AS VARCHAR)) END AS endpoint "
                       "FROM supplier WHERE s_nationkey >= 18 OR s_acctbal < 0"),
    "xml_trailing_content": (f"SELECT * FROM orders WHERE (o_orderkey // {DOC_ROWS}) % {len(TRAILERS)} "
                             f"NOT IN {BAD_TRAILERS}"),
    "cap_split_documents": ("SELECT doc_key, o_orderkey, o_custkey FROM (SELECT o_orderkey // 4096 AS doc_key, o_orderkey, "
                            "o_custkey, row_number() OVER (PARTITION BY o_orderkey // 4096 ORDER BY o_orderkey) AS rn "
                            "FROM orders) WHERE rn <= 1000"),
    "incremental_restart": listing_oracle(),
    "incremental_load": listing_oracle(),
    "incremental_lost_checkpoint": listing_oracle(),
    "landing_retention": (
        f"SELECT CAST(c_custkey // 8 AS VARCHAR) AS request_id, '{AGENTS_ALL}' AS endpoint, "
        "CAST((c_custkey // 8) % 5 AS INTEGER) AS age FROM customer GROUP BY c_custkey // 8 HAVING (c_custkey // 8) % 5 IN (1, 3) OR "
        "((c_custkey // 8) % 5 = 0 AND NOT bool_or(c_acctbal > 9900) AND NOT bool_or(c_acctbal < 0))"),
    "job_specs_run": (
        "WITH j AS (SELECT n_nationkey AS o, n_nationkey AS k, CASE WHEN n_regionkey < 3 THEN 'dev' ELSE 'uat' END AS env "
        "FROM nation UNION ALL SELECT 25, n_nationkey, CASE WHEN n_regionkey < 3 THEN 'dev' ELSE 'uat' END FROM nation "
        "WHERE n_nationkey = 3), "
        "s AS (SELECT CASE WHEN s_nationkey < 13 THEN 'dev' ELSE 'uat' END AS env, s_acctbal FROM supplier), "
        "c AS (SELECT o, k, count(*) AS n, count(*) FILTER (s_acctbal < 0) AS bad FROM j JOIN s ON j.env = s.env GROUP BY o, k), "
        "r AS (SELECT o, k, k % 12 = 11 AS unknown, CASE WHEN k % 12 = 11 THEN 1 ELSE n END AS n, "
        "CASE WHEN k % 12 = 11 THEN 1 ELSE bad END AS bad FROM c) "
        "SELECT CAST(o AS INTEGER) AS feed_ordinal, CASE WHEN unknown THEN concat('feed-', CAST(k AS VARCHAR)) "
        "ELSE list_extract([" + ", ".join(f"'{e}'" for e in FEED_ORDER) + f"], CAST(k % {len(FEED_ORDER)} + 1 AS INTEGER)) END "
        "AS endpoint, CAST(n AS BIGINT) AS requests, CAST(bad AS BIGINT) AS failed_requests, "
        "CAST(CASE WHEN unknown THEN 0 ELSE (n - bad) * CASE WHEN k % 5 = 0 THEN 1 ELSE 2 END END AS BIGINT) AS rows, "
        "CASE WHEN bad = 0 THEN 'success' ELSE printf('ERROR: %d of %d requests failed', bad, n) END AS result, "
        "CASE WHEN NOT unknown THEN concat_ws(' ', f, f, t, t) END AS \"window\" FROM (SELECT *, "
        "CASE k % 3 WHEN 0 THEN '06-16-2022' WHEN 1 THEN '06-01-2022' ELSE '06-10-2022' END AS f, "
        "CASE WHEN k % 2 = 0 THEN '06-17-2022' ELSE '06-15-2022' END AS t FROM r)"),
    "all_feeds_run": (
        "SELECT 'dev' AS env, f.feed_ordinal, f.endpoint, n AS requests, bad AS failed_requests, ok AS rows, "
        "CASE WHEN bad = 0 THEN 'success' ELSE printf('ERROR: %d of %d requests failed', bad, n) END AS result, "
        "true AS own_time FROM (SELECT f.feed_ordinal, f.endpoint, "
        f"CAST(CASE WHEN f.endpoint = '{UNLISTED}' THEN 1 ELSE count(*) END AS BIGINT) AS n, "
        f"CAST(CASE WHEN f.endpoint = '{UNLISTED}' THEN 1 WHEN f.endpoint = '{UNWRITABLE}' THEN count(*) "
        "ELSE count(*) FILTER (s_acctbal < 0) END AS BIGINT) AS bad, "
        f"CAST(CASE WHEN f.endpoint IN ('{UNLISTED}', '{UNWRITABLE}') THEN 0 "
        "ELSE count(*) FILTER (s_acctbal >= 0) END AS BIGINT) AS ok "
        "FROM supplier JOIN (VALUES " + ", ".join(f"({i}, '{e}')" for i, e in enumerate(FEED_ORDER))
        + ") AS f(feed_ordinal, endpoint) ON true GROUP BY f.feed_ordinal, f.endpoint) f "
        "UNION ALL SELECT 'uat', feed_ordinal, endpoint, 0::BIGINT, 0::BIGINT, 0::BIGINT, 'success', true FROM (VALUES "
        + ", ".join(f"({i}, '{e}')" for i, e in enumerate(FEED_ORDER)) + ") AS f(feed_ordinal, endpoint)"),
}
