"""sluice: a Spark-native engine for ingesting partner data feeds.

Requests (feeds x source ids x date window) are planned as a DataFrame,
payloads are fetched on executors or read from a landing area, XML and
JSON documents are parsed into declared all-string schemas with Spark's
built-in ``from_xml`` / ``from_json``, malformed payloads are quarantined
whole, records are appended to catalog tables and every request leaves a
row in a run log.
"""

from sluice.loads import feed_results, feed_summary, load_feed, load_feeds, load_json_api, run_feeds
from sluice.operators.jsonapi import parse_json, project_api_result
from sluice.operators.xml import document_status, parse_documents, parse_records, quarantine
from sluice.plans.catalog import feed_catalog, feed_columns, feed_schema, source_ids
from sluice.plans.requests import plan_api_requests, plan_requests, plan_requests_sql
from sluice.session import build_session, shared_dir
from sluice.sources.fetch import fetch_payloads
from sluice.sources.landing import land_payloads, read_landed
from sluice.streaming.incremental import incremental_load, read_incremental

__all__ = [
    "build_session", "shared_dir",
    "feed_catalog", "feed_columns", "feed_schema", "source_ids",
    "plan_requests", "plan_requests_sql", "plan_api_requests",
    "fetch_payloads", "land_payloads", "read_landed",
    "parse_documents", "parse_records", "document_status", "quarantine",
    "parse_json", "project_api_result",
    "load_feed", "load_feeds", "load_json_api", "run_feeds", "feed_summary", "feed_results",
    "incremental_load", "read_incremental",
]
