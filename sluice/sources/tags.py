"""Discover the record tags of a feed from its payloads.

A record is any direct child of the document root, whatever its tag, but
Spark's XML reader binds records by name.  This pass finds the names: each
task scans its documents with the standard library's expat parser (element
start events only; well-formed documents only) and emits partial counts per
(endpoint, tag); Spark adds them up, and the counts stay a table.  Each tag
becomes a column of the parse, so a plan can take a feed's vocabulary only while
that is one: ``discover_row_tags`` refuses a feed with more than ``MAX_TAGS``
(generated tag names); configure its record tags and let ``check_tags`` report
the rest.
"""

from __future__ import annotations

from collections import Counter
from xml.parsers import expat

import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def root_child_tags(body: str | bytes) -> Counter | None:
    """Tag -> count of the root's direct children; None for a malformed document."""
    parser = expat.ParserCreate(encoding="utf-8")
    parser.ordered_attributes = True
    depth = 0
    tags: Counter = Counter()

    def start(name, _attrs):
        nonlocal depth
        if depth == 1:
            tags[name] += 1
        depth += 1

    def end(_name):
        nonlocal depth
        depth -= 1

    parser.StartElementHandler = start
    parser.EndElementHandler = end
    try:
        parser.Parse(body.encode("utf-8") if isinstance(body, str) else body, True)
    except expat.ExpatError:
        return None
    return tags


def root_children(body: str | None) -> int | None:
    """Number of the root's direct children; None when not well-formed."""
    if not isinstance(body, str):
        return None
    found = root_child_tags(body)
    return None if found is None else sum(found.values())


@F.pandas_udf(T.IntegerType())
def root_children_count(bodies: pd.Series) -> pd.Series:
    """Arrow-batched ``root_children``: never raises on a bad document."""
    return bodies.map(root_children).astype("Int32")


def tag_counts(payloads: DataFrame) -> DataFrame:
    """(endpoint, tag, records) over all well-formed payload bodies."""
    src = payloads.select(F.col("endpoint").cast("string"), "body") if "endpoint" in payloads.columns \
        else payloads.select(F.lit(None).cast("string").alias("endpoint"), "body")

    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            bodies = batch.column("body").cast(pa.binary())
            # One body at a time leaves the batch: a copy of one document, not of all.
            for endpoint, body in zip(batch.column("endpoint").to_pylist(), bodies):
                found = root_child_tags(body.as_py()) if body.is_valid else None
                for tag, n in (found or {}).items():
                    counts[(endpoint, tag)] += n
            yield pa.record_batch([pa.array([e for e, _ in counts], pa.string()), pa.array([t for _, t in counts], pa.string()),
                                   pa.array(list(counts.values()), pa.int64())], names=["endpoint", "tag", "records"])

    partial = src.mapInArrow(run, "endpoint string, tag string, records long")
    return partial.groupBy("endpoint", "tag").agg(F.sum("records").alias("records"))


MAX_TAGS = 200


def discover_row_tags(payloads: DataFrame, max_tags: int = MAX_TAGS) -> dict[str, list[str]]:
    """Record tags per endpoint, most frequent first; an error beyond ``max_tags`` for one endpoint."""
    counts = tag_counts(payloads)
    place = F.row_number().over(Window.partitionBy("endpoint").orderBy(F.desc("records"), "tag"))
    few = counts.withColumn("place", place).where(F.col("place") <= int(max_tags) + 1)
    out: dict[str, list[str]] = {}
    for r in few.orderBy("endpoint", "place").collect():
        out.setdefault(r.endpoint, []).append(r.tag)
    for endpoint, tags in out.items():
        if len(tags) > max_tags:
            raise ValueError(f"{endpoint}: more than {max_tags} distinct tags under the root; configure its record tags")
    return out
