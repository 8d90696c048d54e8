"""Command line: one feed run with named job parameters (O-10).

    python -m sluice.cli --env dev --endpoint listings-3.0 \\
        --from-date 06-16-2022 --to-date 06-17-2022 \\
        --landing <shared path> [--transport http|file --root <dir>]

``python -m sluice.cli api --url ... --table ...`` runs the JSON API job
instead, ``python -m sluice.cli incremental ...`` the incremental load.
``--endpoint All`` runs every configured feed.  ``--catalog`` names a JSON
file with the real hosts and record tags::

    {"base_urls": {"dev": {"listings-3.0": "https://..."}},
     "row_tags": {"listings-3.0": ["listing"]}}

The access token is read from the environment variable named by
``--token-env`` on the driver and travels only inside the transport object.
"""

from __future__ import annotations

import argparse
import json
import os

from sluice.loads import feed_summary, run_feeds
from sluice.plans.catalog import FEED_ORDER, feed_catalog
from sluice.session import build_session
from sluice.sources.storage import qualified
from sluice.sources.transport import FileTransport, HttpTransport


def api_main(argv: list[str]) -> int:
    """``sluice api``: one API URL fetched ``--passes`` times, projected, appended once (O-35)."""
    from sluice.loads import load_json_api
    from sluice.plans.requests import plan_api_requests
    from sluice.sources.fetch import fetch_payloads

    ap = argparse.ArgumentParser(prog="sluice api")
    ap.add_argument("--url", required=True, help="API URL; '{1}' marks where the token goes")
    ap.add_argument("--table", default=None)
    ap.add_argument("--path", default=None)
    ap.add_argument("--format", default=None)
    ap.add_argument("--passes", type=int, default=2)
    ap.add_argument("--transport", choices=["http", "file"], default="http")
    ap.add_argument("--root", help="directory of answer files for --transport file")
    ap.add_argument("--token-env", default="SLUICE_API_TOKEN")
    ap.add_argument("--timeout", type=float, default=600.0)
    args = ap.parse_args(argv)
    if not args.table and not args.path:
        ap.error("one of --table / --path is required")
    spark = build_session()
    transport = (FileTransport(qualified(spark, args.root)) if args.transport == "file"
                 else HttpTransport(token=os.environ.get(args.token_env), timeout=args.timeout))
    payloads = fetch_payloads(plan_api_requests(spark, args.url, passes=args.passes), transport)
    status, message, _log = load_json_api(spark, payloads, args.table, path=args.path, fmt=args.format)
    print(f"{status}\t{message}")
    return 0 if status == "success" else 1


def incremental_main(argv: list[str]) -> int:
    """``sluice incremental``: load what was landed since the last run, each file once (O-37)."""
    from sluice.streaming.incremental import incremental_load

    ap = argparse.ArgumentParser(prog="sluice incremental")
    ap.add_argument("--endpoint", required=True)
    ap.add_argument("--landing", required=True, help="landing table, or a folder of dropped files with --files")
    ap.add_argument("--table-path", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--quarantine", default=None)
    ap.add_argument("--log", default=None, help="where the run log is written")
    ap.add_argument("--files", action="store_true", help="landing is a folder of one-document files")
    ap.add_argument("--max-files-per-trigger", type=int, default=1000)
    ap.add_argument("--split-bytes", type=int, default=None)
    args = ap.parse_args(argv)
    spark = build_session()
    batches = incremental_load(spark, args.landing, args.endpoint, args.table_path, args.checkpoint,
                               quarantine_path=args.quarantine, log_path=args.log, files=args.files,
                               max_files_per_trigger=args.max_files_per_trigger, split_bytes=args.split_bytes)
    print(f"{args.endpoint}\tbatches={batches}")
    return 0


def main(argv: list[str] | None = None) -> int:
    import sys
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv[:1] == ["api"]:
        return api_main(argv[1:])
    if argv[:1] == ["incremental"]:
        return incremental_main(argv[1:])
    ap = argparse.ArgumentParser(prog="sluice")
    ap.add_argument("--env", required=True)
    ap.add_argument("--endpoint", default="All")
    ap.add_argument("--from-date", default="")
    ap.add_argument("--to-date", default="")
    ap.add_argument("--as-of", default=None, help="run date yyyy-MM-dd (default: today)")
    ap.add_argument("--landing", required=True, help="shared landing table path")
    ap.add_argument("--transport", choices=["http", "file"], default="http")
    ap.add_argument("--root", help="directory of landed files for --transport file")
    ap.add_argument("--token-env", default="SLUICE_FEED_TOKEN")
    ap.add_argument("--timeout", type=float, default=600.0)
    ap.add_argument("--concurrency", type=int, default=None)
    ap.add_argument("--log-table", default=None)
    ap.add_argument("--quarantine", default=None)
    ap.add_argument("--catalog", default=None, help="JSON file: base_urls by env/feed, row_tags by feed")
    ap.add_argument("--discover-tags", action="store_true",
                    help="read records under every tag the payloads use as root children")
    ap.add_argument("--check-tags", action="store_true",
                    help="report records under row tags the catalog does not configure")
    ap.add_argument("--split-bytes", type=int, default=None,
                    help="split fetched documents above this size (default 64 MB; 0 keeps them whole)")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.transport == "file":
        transport = FileTransport(qualified(spark, args.root))
    else:
        transport = HttpTransport(token=os.environ.get(args.token_env), timeout=args.timeout)
    endpoints = FEED_ORDER if args.endpoint == "All" else [args.endpoint]
    config = {}
    if args.catalog:
        with open(args.catalog) as f:
            config = json.load(f)
    feeds = feed_catalog(spark, base_urls=config.get("base_urls"), row_tags=config.get("row_tags"))
    log = run_feeds(spark, env=args.env, endpoints=endpoints, from_date=args.from_date, feeds=feeds,
                    to_date=args.to_date, as_of=args.as_of, transport=transport,
                    landing_path=args.landing, concurrency=args.concurrency,
                    quarantine_path=args.quarantine, log_table=args.log_table,
                    check_tags=args.check_tags, split_bytes=args.split_bytes,
                    discover_tags=args.discover_tags)
    summary = feed_summary(log).collect()
    for r in summary:
        print(f"{r.endpoint}\t{r.result}\trows={r.rows}\t{r.elapsed_sec:.1f}s")
    return 0 if all(r.result == "success" for r in summary) else 1


if __name__ == "__main__":
    raise SystemExit(main())
