import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from sluice.loads import load_feed
from sluice.plans.catalog import feed_catalog, source_ids
from sluice.plans.requests import plan_requests
from sluice.sources.fetch import fetch_payloads
from sluice.sources.landing import export_documents, land_payloads, read_landed
from sluice.sources import split
from sluice.sources.split import split_document, split_documents
from sluice.sources.transport import FileTransport

DOC = ("<?xml version='1.0'?>\n<r xmlns:n='u' a='>'>\n"
       + "".join(f"  <row id='{i}'><a>é{i}&amp;</a><b/></row>\n" for i in range(10))
       + "  <!-- c --><row/>\n</r>\n")


def _records(text):
    return [(e.tag, e.findtext("a")) for e in ET.fromstring(text.encode())]


def test_split_keeps_every_record_in_order():
    parts = split_document(DOC, 120)
    assert len(parts) > 2
    assert [r for p, _ in parts for r in _records(p)] == _records(DOC)
    assert [n for _, n in parts] == [sum(len(_records(q)) for q, _ in parts[:i]) for i in range(len(parts))]
    assert all(p.startswith("<?xml version='1.0'?>\n<r xmlns:n='u' a='>'>") for p, _ in parts)


def test_small_malformed_or_single_record_documents_stay_whole():
    assert split_document(DOC, 10 ** 6) is None
    assert split_document(DOC[:-10], 50) is None                      # truncated: rejected whole later
    assert split_document("<r><row>" + "x" * 500 + "</row></r>", 50) is None


def test_byte_search_and_scan_agree():
    plain = "<r>\n" + "".join(f"<row><a>{i}</a><b/></row>" for i in range(40)) + "\n</r>"
    nested = "<r>" + "".join(f"<row><row><a>{i}</a></row></row>" for i in range(20)) + "</r>"
    mixed = "<r>" + "".join(f"<row><a>{i}</a></row><other/>" for i in range(20)) + "</r>"
    cdata = "<r>" + "".join(f"<row><a><![CDATA[<row>{i}]]></a></row>" for i in range(20)) + "</r>"
    for doc in (plain, nested, mixed, cdata):
        parts = split_document(doc, 100)
        assert len(parts) > 3, doc
        assert [r for p, _ in parts for r in _records(p) if r[0] == "row"] == [r for r in _records(doc) if r[0] == "row"]
        rows = [sum(r[0] == "row" for r in _records(p)) for p, _ in parts]
        if doc is not mixed:
            assert [n for _, n in parts] == [sum(rows[:i]) for i in range(len(parts))]


def test_split_documents_operator(spark):
    df = spark.createDataFrame([("a", DOC), ("b", "<r><row/></r>")], "request_id string, body string")
    out = split_documents(df, 120).collect()
    assert sorted({(r.request_id, r.part) for r in out if r.request_id == "b"}) == [("b", 0)]
    assert len([r for r in out if r.request_id == "a"]) > 2


def test_split_payloads_load_like_whole_ones(spark, scratch):
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["agents-all-1.0"],
                         as_of="2022-06-17")
    body = F.concat(F.lit("<r>"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.format_string(
        "<row><mlsSid>%d</mlsSid><agentId>%d</agentId></row>", F.col("mlsSid"), i)), ""), F.lit("</r>"))
    drop = scratch("drop")
    export_documents(reqs.select("endpoint", "landing_name", body.alias("body")), drop).count()
    whole, split = scratch("whole"), scratch("split")
    land_payloads(fetch_payloads(reqs, FileTransport(drop), split_bytes=None), whole)
    land_payloads(fetch_payloads(reqs, FileTransport(drop), split_bytes=2000), split)
    parts = read_landed(spark, split)
    assert parts.where("part > 0").count() > 0
    logs = {}
    for name, landing in (("whole", whole), ("split", split)):
        out = scratch(name)
        log = load_feed(spark, read_landed(spark, landing), "agents-all-1.0", path=out)
        logs[name] = sorted((r.request_id, r.status, r.rows) for r in log.collect())
        logs[name + "_rows"] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert logs["split"] == logs["whole"] and len(logs["whole"]) == 7
    assert all(rows == 200 for _, _, rows in logs["split"])
    assert logs["split_rows"] == logs["whole_rows"]


def test_parts_count_records_of_the_feeds_tags_only(spark):
    mixed = "<r>" + "".join(f"<note>{i}</note><listing><a>{i}</a></listing><other/><!-- c -->" for i in range(30)) + "</r>"
    for tags in (["listing"], ["listing", "other"]):
        parts = split_document(mixed, 150, tags)
        rows = [sum(r[0] in tags for r in _records(p)) for p, _ in parts]
        assert len(parts) > 3 and [n for _, n in parts] == [sum(rows[:i]) for i in range(len(parts))]


def test_cap_means_the_same_for_split_payloads_of_other_tags(spark, scratch):
    reqs = plan_requests(feed_catalog(spark, row_tags={"agents-all-1.0": ["agent"]}), source_ids(spark), env="uat",
                         endpoints=["agents-all-1.0"], as_of="2022-06-17")
    body = F.concat(F.lit("<r>"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.format_string(
        "<row/><note/><agent><mlsSid>%d</mlsSid><agentId>%d</agentId></agent>", F.col("mlsSid"), i)), ""), F.lit("</r>"))
    drop = scratch("drop")
    export_documents(reqs.select("endpoint", "landing_name", body.alias("body")), drop).count()
    rows = {}
    for name, size in (("whole", None), ("split", 2000)):
        landing, out = scratch(name + "-landing"), scratch(name)
        land_payloads(fetch_payloads(reqs, FileTransport(drop), split_bytes=size), landing)
        load_feed(spark, read_landed(spark, landing), "agents-all-1.0", path=out, row_tags=["agent"], max_records=120).collect()
        rows[name] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert len(rows["whole"]) == 7 * 120 and rows["split"] == rows["whole"]


def test_parts_are_made_one_at_a_time():
    data = ("<r>" + "<row><a>1</a></row>" * 1000 + "</r>").encode()
    parts = split._parts(data, 400, ["row"])
    assert iter(parts) is parts and next(parts)[1] == 0 and next(parts)[1] > 0


def test_split_keeps_other_columns_nulls_and_order(spark):
    body = "<r>" + "".join(f"<row><a>é{i}</a></row>" for i in range(50)) + "</r>"
    rows = [(1, body, b"x"), (2, None, None), (None, "<r/>", b""), (4, "", b"y"), (5, body[:-3], b"z")]
    got = split_documents(spark.createDataFrame(rows, "k long, body string, other binary").coalesce(1), 200)
    assert got.columns == ["k", "body", "other", "part", "first_record"]
    out = got.collect()
    ones = [r for r in out if r.k == 1]
    assert [r.part for r in ones] == list(range(len(ones))) and len(ones) > 5 and {bytes(r.other) for r in ones} == {b"x"}
    assert sum(r.body.count("<row>") for r in ones) == 50
    assert [r.first_record for r in ones] == [sum(x.body.count("<row>") for x in ones[:i]) for i in range(len(ones))]
    assert [(r.k, r.body, r.other, r.part) for r in out if r.k != 1] == [(k, b, o, 0) for k, b, o in rows[1:]]
