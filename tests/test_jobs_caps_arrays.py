"""Jobs given as a table, caps in document order over several tags, replay by join, arrays at the top level."""

import pytest

from sluice.loads import feed_results, feed_summary, run_feeds, run_jobs
from sluice.operators.jsonapi import infer_json_schema, json_elements, parse_json_elements
from sluice.operators.xml import document_status, parse_records
from sluice.plans.catalog import feed_catalog
from sluice.plans.requests import JOB_SPEC, plan_jobs
from sluice.sources.fetch import replay_payloads
from sluice.sources.landing import read_landed
from sluice.sources.split import cap_document, split_document, split_documents

AS_OF = "2022-06-17"


def _sources(spark):
    return spark.createDataFrame([("uat", 1), ("uat", 2), ("dev", 3)], "env string, mlsSid long")


def _answers(spark, endpoints=("agents-all-1.0", "office-2.0"), ids=(1, 2, 3)):
    rows = "".join(f"<row><mlsSid>{i}</mlsSid></row>" for i in range(3))
    return spark.createDataFrame([(e, f"{e}.{i}.06172022.xml", f"<r>{rows}</r>") for e in endpoints for i in ids],
                                 "endpoint string, landing_name string, body string")


def test_every_job_has_its_own_window_cap_and_result(spark, scratch):
    specs = spark.createDataFrame([
        (4, "uat", "agents-all-1.0", "", "", None), (1, "dev", "agents-all-1.0", "06-01-2022", "06-05-2022", 2),
        (2, "uat", "agents-all-1.0", "06-10-2022", "", 1), (3, "uat", "nope-1.0", "", "", None),
        (0, "uat", "agents-all-1.0", "", "", None), (7, "prod", "office-2.0", "", "", None),
        (5, "uat", "office-2.0", "", "", None)], JOB_SPEC)
    landing, root = scratch("landing"), scratch("jobs")
    paths = {e: f"{root}/{e}" for e in ("agents-all-1.0", "office-2.0")}
    answers = _answers(spark).where("not (endpoint = 'office-2.0' and landing_name like '%.2.06172022.xml')")
    log = run_jobs(spark, specs, answers=answers, landing_path=landing, as_of=AS_OF, sources=_sources(spark), paths=paths)
    got = [(r.feed_ordinal, r.requests, r.rows, r.result) for r in feed_summary(log).collect()]
    bad = "ERROR: 1 of {} requests failed".format
    assert got == [(0, 2, 6, "success"), (1, 1, 2, "success"), (2, 2, 2, "success"), (3, 1, 0, bad(1)), (4, 2, 6, "success"),
                   (5, 2, 3, bad(2)), (7, 1, 0, bad(1))]
    assert spark.read.parquet(paths["agents-all-1.0"]).count() == 6 + 2 + 2 + 6
    asked = {(r.feed_ordinal, r.fromDate, r.toDate) for r in read_landed(spark, landing, load_date=AS_OF).collect()}
    assert asked == {(0, "06-16-2022", "06-17-2022"), (1, "06-01-2022", "06-05-2022"), (2, "06-10-2022", "06-17-2022"),
                     (4, "06-16-2022", "06-17-2022"), (5, "06-16-2022", "06-17-2022")}


def test_an_endpoint_asked_twice_is_two_jobs(spark, scratch):
    root = scratch("jobs")
    log = run_feeds(spark, env="uat", endpoints=["office-2.0", "office-2.0"], answers=_answers(spark), as_of=AS_OF,
                    landing_path=scratch("landing"), sources=_sources(spark), paths={"office-2.0": root})
    assert feed_results(log) == ["success", "success"] and log.count() == 4
    assert spark.read.parquet(root).count() == 2 * 2 * 3


def test_specs_need_distinct_ordinals_and_one_source_of_payloads(spark, scratch):
    twice = spark.createDataFrame([(0, "uat", "office-2.0", "", "", None)] * 2, JOB_SPEC)
    with pytest.raises(ValueError, match="distinct"):
        run_jobs(spark, twice, answers=_answers(spark), landing_path=scratch("landing"))
    with pytest.raises(ValueError, match="either"):
        run_jobs(spark, twice, landing_path=scratch("landing"))


def test_job_plan_has_no_cross_join(spark):
    specs = spark.createDataFrame([(0, "uat", "office-2.0", "", "", None)], JOB_SPEC)
    plan = plan_jobs(feed_catalog(spark), _sources(spark), specs, as_of=AS_OF)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert plan_jobs(feed_catalog(spark), _sources(spark), specs.limit(0), as_of=AS_OF).count() == 0


def test_replay_by_join(spark):
    requests = plan_jobs(feed_catalog(spark), _sources(spark), spark.createDataFrame(
        [(0, "uat", "office-2.0", "", "", None)], JOB_SPEC), as_of=AS_OF)
    rows = {r["mlsSid"]: r for r in replay_payloads(requests, _answers(spark, ids=(1,)), run_id="x").collect()}
    assert (rows[1]["http_status"], rows[1]["error"], rows[1]["run_id"]) == (200, None, "x") and "<row>" in rows[1]["body"]
    assert (rows[2]["http_status"], rows[2]["error"], rows[2]["body"]) == (404, "not found: office-2.0.2.06172022.xml", None)


DOC = "<r><n/><a><x>1</x></a><b><x>2</x></b><n><a/></n><b><x>3</x></b><a><x>4</x></a><a><x>5</x></a><n/></r>"


@pytest.mark.parametrize("cap", range(7))
def test_cap_is_in_document_order(spark, cap):
    docs = spark.createDataFrame([(0, DOC), (1, DOC.replace("</r>", "")), (2, "<r/>"), (3, None)], "i int, body string")
    want = {str(i) for i in list(range(1, 6))[:cap]}
    whole = parse_records(docs, ["x"], ["a", "b"], keep=["i"], max_records=cap)
    assert {(r["i"], r["x"]) for r in whole.collect()} == {(0, x) for x in want}
    parts = split_documents(docs, 70, ["a", "b"])
    assert parts.where("i = 0").count() > 1
    assert {(r["i"], r["x"]) for r in parse_records(parts, ["x"], ["a", "b"], keep=["i"], max_records=cap).collect()} \
        == {(0, x) for x in want}
    status = document_status(parts, ["a", "b"], keep=["i"], max_records=cap, probe="x").groupBy("i").sum("n_records").collect()
    assert {r[0]: r[1] for r in status}[0] == min(cap, 5)


def test_cap_document_leaves_broken_documents():
    assert cap_document(DOC[:-1], 1, ["a"]) == DOC[:-1]
    assert cap_document(DOC, 0, ["a"]) == "<r><n/></r>" and cap_document(DOC, 9, ["a"]) == DOC
    assert cap_document(DOC, 1, []) == "<r><n/></r>"
    assert [n for _, n in split_document("<r>" + "<a>é</a><n/>" * 50 + "</r>", 100, ["a"])][:3] != []


def test_arrays_at_the_top_level(spark):
    bodies = ['[{"a":1,"b":{"c":"x"}},{"a":2.5},{"a":null}]', '{"a":7}', "[]", "3", "nope", None, '[1,{"a":4}]', "[[1]]", '""']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    schema = infer_json_schema(df.where("i < 4"))
    assert schema.simpleString() == "struct<a:double,b:struct<c:string>>"
    rows = parse_json_elements(df, schema, keep=["i"]).orderBy("i", "place").collect()
    assert [(r["i"], r["place"], r["j"] and r["j"]["a"], r["fetched"], r["malformed"]) for r in rows] == [
        (0, 0, 1.0, True, False), (0, 1, 2.5, True, False), (0, 2, None, True, False), (1, 0, 7.0, True, False),
        (2, None, None, True, False), (3, None, None, True, True), (4, None, None, True, True), (5, None, None, False, False),
        (6, 0, None, True, True), (6, 1, 4.0, True, False), (7, 0, None, True, True), (8, None, None, True, True)]
    assert rows[0]["j"]["b"]["c"] == "x"
    assert json_elements(df.limit(0)).count() == 0
