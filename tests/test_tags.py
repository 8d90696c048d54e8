from pyspark.sql import functions as F

from sluice.loads import load_feed
from sluice.sources.tags import discover_row_tags, root_child_tags, tag_counts


def test_root_child_tags():
    assert dict(root_child_tags("<r><p><a/></p><q/><p/></r>")) == {"p": 2, "q": 1}
    assert root_child_tags("<r><p></r>") is None
    assert dict(root_child_tags("<r/>")) == {}


def test_discover_per_endpoint(spark):
    df = spark.createDataFrame(
        [("a-1.0", "<r><p/><q/></r>"), ("a-1.0", "<r><p/></r>"), ("b-1.0", "<r><row/></r>"),
         ("b-1.0", "<r><bad>"), ("b-1.0", None)], "endpoint string, body string")
    assert discover_row_tags(df) == {"a-1.0": ["p", "q"], "b-1.0": ["row"]}
    counts = {(r.endpoint, r.tag): r.records for r in tag_counts(df).collect()}
    assert counts == {("a-1.0", "p"): 2, ("a-1.0", "q"): 1, ("b-1.0", "row"): 1}


def test_generated_tag_names_are_refused(spark):
    import pytest
    doc = "<r>" + "".join(f"<t{i}/>" for i in range(30)) + "</r>"
    df = spark.createDataFrame([("a-1.0", doc)], "endpoint string, body string")
    with pytest.raises(ValueError, match="more than 20"):
        discover_row_tags(df, max_tags=20)


def test_discovered_tags_load_every_record(spark, scratch):
    doc = "<r><agent><agentId>1</agentId></agent><office><agentId>2</agentId></office></r>"
    p = spark.createDataFrame([("r1", "agents-all-1.0", doc)], "request_id string, endpoint string, body string")
    tags = discover_row_tags(p)["agents-all-1.0"]
    r = load_feed(spark, p, "agents-all-1.0", path=scratch("t"), row_tags=tags, check_tags=True).first()
    assert (r.status, r.rows, r.message) == ("success", 2, "")


def test_tags_are_counted_from_bytes_and_null_bodies_are_left_out(spark):
    assert dict(root_child_tags("<r><é/><b/></r>".encode())) == {"é": 1, "b": 1}
    rows = [("e", "<r>" + "<a>x</a>" * n + "</r>") for n in range(1, 60)] + [(None, "<r><b/></r>"), ("e", None), ("e", "<r><a>")]
    got = {(r.endpoint, r.tag): r.records for r in tag_counts(spark.createDataFrame(rows, "endpoint string, body string")).collect()}
    assert got == {("e", "a"): 59 * 60 // 2, (None, "b"): 1}
