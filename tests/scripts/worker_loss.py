"""Fetch + land with a transport that kills its Python worker once mid-task.

Run as a script (its own session with task retries); prints JSON counts.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from sluice.plans.catalog import feed_catalog, source_ids  # noqa: E402
from sluice.plans.requests import plan_requests  # noqa: E402
from sluice.session import build_session, scratch_path  # noqa: E402
from sluice.sources.fetch import fetch_payloads  # noqa: E402
from sluice.sources.landing import land_payloads, read_landed  # noqa: E402


class CrashOnce:
    """Answers every request; the first time it sees the marker request it
    takes its whole Python worker down (as a lost executor would)."""

    def __init__(self, marker: str):
        self.marker = marker

    def __call__(self, request):
        if request["mlsSid"] == 36 and not os.path.exists(self.marker):
            open(self.marker, "w").close()
            os._exit(1)
        return 200, f"<r><row><agentId>{request['mlsSid']}</agentId></row></r>", None


def main():
    spark = build_session("local[2,4]", app="worker-loss", shuffle_partitions=4,
                          extra={"spark.python.worker.reuse": "true"})
    spark.sparkContext.setLogLevel("OFF")
    marker = sys.argv[1]
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="dev", endpoints=["agents-all-1.0"],
                         as_of="2022-06-17")
    landing = scratch_path(spark, "loss-landing")
    land_payloads(fetch_payloads(reqs, CrashOnce(marker), concurrency=2), landing)
    landed = read_landed(spark, landing)
    print(json.dumps({"requests": reqs.count(), "landed": landed.count(),
                      "distinct": landed.select("request_id").distinct().count(),
                      "crashed": os.path.exists(marker)}))


if __name__ == "__main__":
    main()
