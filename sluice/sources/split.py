"""Split oversized XML documents at record boundaries.

One document is one task's parse.  A hot source can answer with a very
large document, so documents above ``max_bytes`` are cut into several
well-formed documents, each holding whole consecutive records: the text
before the first child of the root (declaration, root start tag) and after the
last (root end tag) is repeated around every slice.  Records are
independent of each other, so parsing the slices yields exactly the
records of the whole document, now in parallel tasks.  Each part knows how
many records of the feed's tags stand before it (``first_record``), so a record cap
keeps the same records of the parts as of the whole document: the first in
document order, whatever their tags (``cap_documents``).

Cuts are found by a byte search for the feed's record tags near the wanted
sizes and proved by checking that every slice is well-formed, which it is only
if the cut is between children of the root.  Where that fails (comments
around tags, records of other tags) the boundaries come from a scan of all
elements.  A document that is not well-formed is never split: it stays whole
and is rejected whole downstream.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.catalog import DEFAULT_ROW_TAGS

DEFAULT_SPLIT_BYTES = 64 * 1024 * 1024
_BATCH_BYTES = 4 * 1024 * 1024     # parts that a task gathers before it hands them on
_SKIP = re.compile(rb"\s+|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^\[>]*>", re.DOTALL)
_START = re.compile(rb"""<([^\s/>!?]+)(?:\s+[^\s=/>]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s*>""")


def _well_formed(data: bytes) -> bool:
    try:
        expat.ParserCreate(encoding="utf-8").Parse(data, True)
    except expat.ExpatError:
        return False
    return True


def _root(data: bytes) -> tuple[int, int] | None:
    """(end of the root's start tag, start of its end tag)."""
    at = 0
    while (m := _SKIP.match(data, at)) and m.end() > at:
        at = m.end()
    start = _START.match(data, at)
    end = data.rfind(b"</")
    if not start or end < start.end() or not re.match(rb"</" + re.escape(start.group(1)) + rb"\s*>", data[end:]):
        return None
    return start.end(), end


def _search(data: bytes, max_bytes: int, root: tuple[int, int], records: re.Pattern) -> list[tuple[int, int, int]] | None:
    """(start, end, records before) of the slices, by a byte search; None where it cannot be proved."""
    begin, end = root
    found, depth, over = [], 0, begin
    for m in records.finditer(data, begin, end):
        if m.group(1):
            depth -= 1
        else:
            if depth or not data[over:m.start()].isspace() and over < m.start():
                return None  # a record tag inside a record, or other children, which may hold some
            found.append(m.start())
            depth += not m.group(2)
        over = m.end()
    if over < end and not data[over:end].isspace():
        return None
    slices, lo, k = [], begin, 0
    while k < len(found):
        # as many records as keep the slice within the bound, one at least
        j = k + 1
        while j < len(found) and (found[j + 1] if j + 1 < len(found) else end) - lo <= max_bytes:
            j += 1
        hi = found[j] if j < len(found) else end
        slices.append((lo, hi, k))
        lo, k = hi, j
    if len(slices) < 2:
        return None
    return slices if all(_well_formed(data[:begin] + data[x:y] + data[end:]) for x, y, _ in slices) else None


def _scan(data: bytes, max_bytes: int, row_tags: Sequence[str]) -> tuple[bytes, bytes, list[tuple[int, int, int]]] | None:
    """The same from a scan of all elements: exact for every well-formed document.  Children of other tags are no records."""
    scanned = _children(data)
    if scanned is None or len(scanned[0]) < 2:
        return None
    children, root_end = scanned
    wanted, before = set(row_tags), [0]    # records before each child of the root
    for _, name in children:
        before.append(before[-1] + (name in wanted if wanted else 1))
    bounds, slices, lo = [*(at for at, _ in children), root_end], [], 0
    for k in range(1, len(children)):
        if bounds[k + 1] - bounds[lo] > max_bytes:
            slices.append((bounds[lo], bounds[k], before[lo]))
            lo = k
    slices.append((bounds[lo], bounds[-1], before[lo]))
    return data[:bounds[0]], data[root_end:], slices


def split_document(body: str, max_bytes: int = DEFAULT_SPLIT_BYTES,
                   row_tags: Sequence[str] = DEFAULT_ROW_TAGS) -> list[tuple[str, int]] | None:
    """(slice, records before it) of about ``max_bytes`` each, or None to keep the
    document whole (small, malformed, or fewer than two records).  Records are the
    children of the root with one of ``row_tags``; every child, if that is empty."""
    if len(body) * 4 <= max_bytes:        # at most 4 bytes per character: surely small
        return None
    parts = _parts(body.encode("utf-8"), max_bytes, row_tags)
    return None if parts is None else [(p.decode("utf-8"), n) for p, n in parts]


def _parts(data: bytes, max_bytes: int, row_tags: Sequence[str]) -> Iterator[tuple[bytes, int]] | None:
    """``split_document`` on bytes, one slice at a time."""
    if len(data) <= max_bytes:
        return None
    slices, root = None, _root(data)
    # Comments, CDATA and nested record tags could hide or fake a boundary: those go to the scan.
    if row_tags and root is not None and data.find(b"<!", root[0]) < 0:
        names = b"|".join(re.escape(t.encode()) for t in row_tags)
        records = re.compile(rb"<(/?)(?:" + names + rb""")(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*?(/?)>""")
        slices = _search(data, max_bytes, root, records)
        prefix, suffix = data[:root[0]], data[root[1]:]
    if slices is None:
        scanned = _scan(data, max_bytes, row_tags)
        if scanned is None or len(scanned[2]) < 2:
            return None
        prefix, suffix, slices = scanned
    return ((prefix + data[x:y] + suffix, n) for x, y, n in slices)


def split_rows(rows: list[dict], max_bytes: int, row_tags: Sequence[str] = DEFAULT_ROW_TAGS) -> list[dict]:
    """Payload rows -> rows with ``part`` and ``first_record``; large bodies become parts."""
    out = []
    for row in rows:
        body = row.get("body")
        parts = split_document(body, max_bytes, row_tags) if body else None
        if parts is None:
            out.append({**row, "part": 0, "first_record": 0})
        else:
            out.extend({**row, "body": p, "part": i, "first_record": n} for i, (p, n) in enumerate(parts))
    return out


def split_documents(payloads: DataFrame, max_bytes: int = DEFAULT_SPLIT_BYTES,
                    row_tags: Sequence[str] = DEFAULT_ROW_TAGS) -> DataFrame:
    """Payload rows with large bodies split into parts (adds ``part`` and ``first_record``)."""
    extra = [T.StructField("part", T.IntegerType()), T.StructField("first_record", T.LongType())]
    added = {f.name for f in extra}
    schema = T.StructType([f for f in payloads.schema.fields if f.name not in added] + extra)
    names = schema.fieldNames()
    source = payloads.drop(*added)
    tags = list(row_tags)

    def run(batches):
        for batch in batches:
            bodies = batch.column("body").cast(pa.binary())
            rows, out, size = [], ([], [], []), 0

            def taken():
                # other columns are repeated for every part of a row
                cols = batch.take(pa.array(rows, pa.int64()))
                made = dict(zip(["body", "part", "first_record"],
                                [pa.array(out[0], pa.binary()).cast(pa.string()), pa.array(out[1], pa.int32()),
                                 pa.array(out[2], pa.int64())], strict=True))
                return pa.record_batch([made[c] if c in made else cols.column(c) for c in names], names=names)

            # One document at a time, and its parts go on as soon as they fill a batch.
            for i in range(batch.num_rows):
                data = bodies[i].as_py()
                parts = _parts(data, max_bytes, tags) if data else None
                for part, (body, first) in enumerate([(data, 0)] if parts is None else parts):
                    rows.append(i)
                    for column, value in zip(out, (body, part, first), strict=True):
                        column.append(value)
                    size += len(body or b"")
                    if size >= _BATCH_BYTES:
                        yield taken()
                        rows, out, size = [], ([], [], []), 0
            if rows:
                yield taken()

    return source.mapInArrow(run, schema)


def cap_document(body: str, room: int, row_tags: Sequence[str] = DEFAULT_ROW_TAGS) -> str:
    """The document without what follows its first ``room`` records of ``row_tags`` (children of the root, in document
    order).  A document that is not well-formed stays as it is, to be rejected whole."""
    data = body.encode("utf-8")
    scanned = _children(data)
    if scanned is None:
        return body
    children, root_end = scanned
    wanted, left = set(row_tags), room
    for at, name in children:
        if not wanted or name in wanted:
            if not left:
                return (data[:at] + data[root_end:]).decode("utf-8")
            left -= 1
    return body


def _children(data: bytes) -> tuple[list[tuple[int, str]], int] | None:
    """(start, name) of every child of the root and the start of the root's end tag; None if not well-formed."""
    parser = expat.ParserCreate(encoding="utf-8")
    depth, found, root_end = 0, [], -1

    def start(name, _attrs):
        nonlocal depth
        if depth == 1:
            found.append((parser.CurrentByteIndex, name))
        depth += 1

    def end(_name):
        nonlocal depth, root_end
        depth -= 1
        if depth == 0:
            root_end = parser.CurrentByteIndex

    parser.StartElementHandler, parser.EndElementHandler = start, end
    try:
        parser.Parse(data, True)
    except expat.ExpatError:
        return None
    return found, root_end


def cap_documents(payloads: DataFrame, room: Column, row_tags: Sequence[str], body: str = "body") -> DataFrame:
    """O-23 for several record tags: ``body`` holds its first ``room`` records in document order, before it is parsed.

    Spark's reader gives the records tag by tag, so their order is in the
    document only.  Documents that hold no more tags than ``room`` (by a byte
    search) are not scanned.
    """
    tags, text = list(row_tags), F.col(body)

    @F.arrow_udf("string")
    def capped(bodies: pa.Array, rooms: pa.Array) -> pa.Array:
        return pa.array([None if b is None else cap_document(b, n, tags)
                         for b, n in zip(bodies.to_pylist(), rooms.to_pylist(), strict=True)], pa.string())

    count = sum(((F.octet_length(text) - F.octet_length(F.replace(text, F.lit("<" + t)))) / F.lit(len(t.encode()) + 1)
                 for t in tags), F.lit(0.0))
    return payloads.withColumn(body, F.coalesce(capped(F.when(count > room, text), room), text))
