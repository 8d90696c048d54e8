import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from sluice.operators import filters as FL
from sluice.operators.jsonapi import (API_OUTPUT_COLUMNS, infer_json_schema, parse_api, parse_json,
                                      project_api_result)
from sluice.operators.sets import concat_by_name, union_all

GOOD = {"status": 200, "result": {"country": "England", "european_electoral_region": "London",
                                  "latitude": 51.5, "longitude": -0.12,
                                  "parliamentary_constituency": "Holborn", "region": "London"}}


def _payloads(spark, bodies):
    return spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "request_id string, body string")


def test_api_projection(spark):
    df = _payloads(spark, [json.dumps(GOOD)])
    out = project_api_result(parse_api(df))
    assert out.columns == API_OUTPUT_COLUMNS
    assert tuple(out.first()) == ("200", "England", "London", "51.5", "-0.12", "Holborn", "London", "", "")


def test_missing_and_malformed(spark):
    no_region = json.loads(json.dumps(GOOD))
    del no_region["result"]["region"]
    null_region = json.loads(json.dumps(GOOD))
    null_region["result"]["region"] = None
    df = _payloads(spark, [json.dumps(no_region), json.dumps(null_region), "{not json", None])
    rows = {r.request_id: r for r in parse_api(df).select("*", F.expr("try_variant_get(v, '$.result.region', 'string')").alias("region")).collect()}
    assert rows["0"].missing == ["result.region"] and not rows["0"].malformed
    assert rows["1"].missing == [] and rows["1"].region is None
    assert rows["2"].malformed and rows["2"].fetched
    assert not rows["3"].fetched


def test_number_text_follows_the_number(spark):
    result = ('"country": "c", "european_electoral_region": "007", "parliamentary_constituency": true, "region": 1e2, '
              '"latitude": %s, "longitude": %s')
    rows = [("51", "-0.50", "51", "-0.5"), ("774.0", "12345678901234567890", "774.0", "12345678901234567890"),
            ('"51.50"', "null", "51.50", None), ("0.1234567890123456789", "-7", "0.12345678901234568", "-7")]
    df = _payloads(spark, ['{"status": 200, "result": {%s}}' % (result % r[:2]) for r in rows])
    out = {r.request_id: r for r in project_api_result(parse_api(df), keep=["request_id"]).collect()}
    for i, r in enumerate(rows):
        assert (out[str(i)].latitude, out[str(i)].longitude) == r[2:], r
        assert (out[str(i)].european_electoral_region, out[str(i)].parliamentary_constituency, out[str(i)].region) \
            == ("007", "true", "100.0")
    plan = project_api_result(parse_api(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 2 and "from_json" not in plan


def test_inferred_schema(spark):
    df = _payloads(spark, ['{"k": 1, "s": "x"}', '{"k": 2, "n": {"a": 1.5}}'])
    schema = infer_json_schema(df)
    assert {f.name for f in schema.fields} == {"k", "s", "n"}
    got = parse_json(df, schema).select("j.k", "j.n.a").collect()
    assert sorted((r.k, r.a) for r in got) == [(1, None), (2, 1.5)]
    # same types as JSON schema inference: integers bigint, fractions double
    assert schema["k"].dataType.simpleString() == "bigint"
    assert schema["n"].dataType["a"].dataType.simpleString() == "double"


def test_status_and_search_filters(spark):
    df = spark.createDataFrame([(1, "A", "office"), (2, "S", "agent")], "id int, st string, kind string")
    assert FL.filter_status(df, "st", "All").count() == 2
    assert [r.id for r in FL.filter_status(df, "st", "A").collect()] == [1]
    assert FL.filter_search(df, "kind", "All").count() == 2
    assert [r.id for r in FL.filter_search(df, "kind", "agent").collect()] == [2]


def test_date_filter_text_and_typed(spark):
    df = spark.createDataFrame(
        [(1, "06-15-2022", dt.datetime(2022, 6, 15, 23, 59)), (2, "06-16-2022", dt.datetime(2022, 6, 16, 0, 0)),
         (3, "06-17-2022", dt.datetime(2022, 6, 17, 12, 0)), (4, "junk", None)],
        "id int, d string, ts timestamp")
    assert [r.id for r in FL.filter_dates(df, "d", "06-16-2022", "06-17-2022").orderBy("id").collect()] == [2, 3]
    assert [r.id for r in FL.filter_dates(df, "ts", "06-16-2022", "06-17-2022").orderBy("id").collect()] == [2, 3]
    assert [r.id for r in FL.filter_dates(df, "d", "06-16-2022").orderBy("id").collect()] == [2, 3]


def test_date_filter_reaches_parquet_scan(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = FL.filter_dates(o, "o_orderdate", "01-01-1995", "12-31-1995")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_cap_per_key_uses_partial_group_limit(spark):
    rows = [(k, i) for k in range(3) for i in range(10)] + [(9, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int")
    capped = FL.cap_records_per_key(df, "k", "v", 2)
    assert sorted(tuple(r) for r in capped.collect()) == sorted((k, v) for k in (0, 1, 2, 9) for v in (0, 1))
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()


def test_sets(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, "y")], "id int, s string")
    assert union_all(a, b, a).count() == 3
    c = spark.createDataFrame([("z", 3.0)], "s string, extra double")
    out = concat_by_name(a, c)
    assert out.columns == ["id", "s", "extra"]
    assert sorted(((r.id, r.s, r.extra) for r in out.collect()), key=lambda t: t[1]) == \
        [(1, "x", None), (None, "z", 3.0)]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_cap_is_the_same_below_and_above_the_threshold(spark, n):
    rows = [(k, i % 4, j) for k in range(3) for i in range(10) for j in (0, 1)] + [(9, 0, i % 50) for i in range(400)]
    rows += [(None, i, i) for i in range(7)] + [(1, 0, 0)] * 5
    df = spark.createDataFrame(rows, "k int, v int, x int").repartition(6)
    below = FL.cap_records_per_key(df.repartition(3, "x"), "k", "v", n)
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "0")
    try:
        above = FL.cap_records_per_key(df.repartition(5, "v"), "k", "v", n)
        assert sorted(map(str, above.collect())) == sorted(map(str, below.collect()))
        ranked = FL.cap_records_per_key(df, "k", "v", n, rank_column="place")
        assert ranked.columns == ["k", "v", "x", "place"] and ranked.where("k = 9").count() == n
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
