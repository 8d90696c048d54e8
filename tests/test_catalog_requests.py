import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.plans import catalog as C
from sluice.plans.requests import plan_requests, plan_requests_sql, unknown_requests

AS_OF = "2022-06-17"


def test_feed_registry():
    sizes = {e: len(C.feed_columns(e)) for e in C.FEED_ORDER}
    assert sizes == {"agent-move-1.0": 17, "agent-new-1.0": 13, "agent-2.0": 19, "agents-all-1.0": 6,
                     "closed-listings-1.0": 17, "listings-2.0": 34, "office-2.0": 15, "listings-3.0": 40}
    for e in C.FEED_ORDER:
        cols = C.feed_columns(e)
        assert cols[0] == "mlsSid" and len(set(cols)) == len(cols)
        assert all(f.dataType.simpleString() == "string" and f.nullable for f in C.feed_schema(e).fields)
    with pytest.raises(C.UnknownFeed):
        C.feed_columns("nope-1.0")
    assert C.table_name_of("listings-3.0") == "listings30"
    assert C.table_name_of("closed-listings-1.0") == "closedlistings10"


def test_catalog_frame(spark):
    cat = C.feed_catalog(spark)
    assert cat.count() == 16
    assert cat.where("env = 'dev'").select("endpoint").distinct().count() == 8


def _plan(spark, **kw):
    return plan_requests(C.feed_catalog(spark), C.source_ids(spark), as_of=AS_OF, **kw)


def test_plan_keeps_duplicate_ids(spark):
    p = _plan(spark, env="dev", endpoints=["office-2.0"])
    assert p.count() == 23
    assert p.where("mlsSid = 36").count() == 2
    assert _plan(spark, env="dev", endpoints=["office-2.0"], distinct_ids=True).count() == 22
    assert _plan(spark, env="uat").count() == 7 * 8


def test_default_window_and_urls(spark):
    p = _plan(spark, env="dev", endpoints=["listings-3.0", "agent-2.0"]).where("mlsSid = 278")
    rows = {r.endpoint: r for r in p.collect()}
    r3 = rows["listings-3.0"]
    assert (r3.fromDate, r3.toDate) == ("06-16-2022", "06-17-2022")
    assert r3.url == ("https://dev.feeds.example.com/api/listings-3.0.xml?authToken={1}&mlsSid=278&status=All"
                      "&searchStr=All&searchBy=office&fromDate=06-16-2022&toDate=06-17-2022&recLimit=1000000")
    # toDate has no slot in the other templates; the token is never filled in the plan
    assert "toDate" not in rows["agent-2.0"].url and "{1}" in rows["agent-2.0"].url
    assert r3.landing_name == "listings-3.0.278.06172022.xml"
    assert r3.table_name == "listings30"
    given = _plan(spark, env="dev", endpoints=["listings-3.0"], from_date="01-02-2021",
                  to_date="01-03-2021").first()
    assert (given.fromDate, given.toDate) == ("01-02-2021", "01-03-2021")


def test_passes_repeat_requests(spark):
    p = _plan(spark, env="uat", endpoints=["agent-2.0"], passes=2)
    assert p.count() == 14 and p.select("request_id").distinct().count() == 14


def test_plan_has_no_cross_join_and_broadcasts_catalog(spark):
    plan = _plan(spark, env="dev")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_sql_plan_matches_dataframe_plan(spark):
    cols = ["request_id", "endpoint", "mlsSid", "fromDate", "toDate", "url"]
    a = _plan(spark, env="dev").select(*cols)
    b = plan_requests_sql(spark, C.feed_catalog(spark), C.source_ids(spark), env="dev", as_of=AS_OF).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    one = plan_requests_sql(spark, C.feed_catalog(spark), C.source_ids(spark), env="uat",
                            endpoint="office-2.0", as_of=AS_OF)
    assert one.count() == 7


def test_unknown_requests(spark):
    wanted = spark.createDataFrame([("dev", "office-2.0"), ("dev", "nope-9.9"), ("prod", "agent-2.0")],
                                   "env string, endpoint string")
    miss = sorted(tuple(r) for r in unknown_requests(wanted, C.feed_catalog(spark)).collect())
    assert miss == [("dev", "nope-9.9"), ("prod", "agent-2.0")]


def test_date_functions(spark):
    from sluice.functions import compact_day, default_window, landing_name, mdy, table_name
    df = spark.createDataFrame([(dt.date(2022, 6, 17), "", None, "listings-3.0")],
                               "d date, blank string, nul string, e string")
    f, t = default_window(F.col("blank"), F.col("nul"), F.col("d"))
    r = df.select(mdy("d").alias("a"), compact_day("d").alias("b"), f.alias("f"), t.alias("t"),
                  table_name(F.col("e")).alias("n"), landing_name(F.col("e"), F.lit(5), F.col("d")).alias("l")).first()
    assert tuple(r) == ("06-17-2022", "06172022", "06-16-2022", "06-17-2022", "listings30",
                        "listings-3.0.5.06172022.xml")


def test_schema_rows_listing(spark):
    rows = C.schema_rows(spark)
    assert rows.count() == sum(len(C.feed_columns(e)) for e in C.FEED_ORDER) == 161
    first = rows.where("ordinal = 0").select("column").distinct().collect()
    assert [r.column for r in first] == ["mlsSid"]


def test_text_and_date_helpers(spark, scratch):
    from sluice.functions.dates import parse_mdy, previous_day
    from sluice.functions.names import fill_template, xml_text
    from sluice.sinks.tables import append_table, read_table
    df = spark.createDataFrame([("06-17-2022", "a&b<c>", "{0}/x?y={2}&z={9}")], "d string, t string, tpl string")
    r = df.select(parse_mdy("d").alias("p"), previous_day("2022-01-01").alias("y"), xml_text("t").alias("x"),
                  fill_template(F.col("tpl"), {0: F.lit("https://h"), 2: F.lit(5), 4: F.lit("unused")})
                  .alias("u")).first()
    assert r.p == dt.date(2022, 6, 17) and r.y == dt.date(2021, 12, 31)
    assert r.x == "a&amp;b&lt;c&gt;" and r.u == "https://h/x?y=5&z={9}"
    assert df.select(parse_mdy(F.lit("2022-06-17")).alias("bad")).first().bad is None
    name = "sluice_t_" + dt.datetime.now().strftime("%H%M%S%f")
    where = scratch("t")
    append_table(df, name, fmt="parquet", path=where)
    append_table(df, name, fmt="parquet", path=where)
    assert read_table(spark, name).count() == 2


def test_window_split_for_hot_sources(spark):
    p = _plan(spark, env="uat", endpoints=["listings-3.0", "agent-2.0"], from_date="06-01-2022",
              to_date="06-08-2022", window_days=3).where("mlsSid = 278")
    got = sorted((r.endpoint, r.fromDate, r.toDate) for r in p.collect())
    assert got == [("agent-2.0", "06-01-2022", "06-08-2022"),
                   ("listings-3.0", "06-01-2022", "06-04-2022"),
                   ("listings-3.0", "06-04-2022", "06-07-2022"),
                   ("listings-3.0", "06-07-2022", "06-08-2022")]
    assert p.select("request_id").distinct().count() == 4
    assert all("toDate=" + r.toDate in r.url for r in p.where("endpoint = 'listings-3.0'").collect())
    names = sorted(r.landing_name for r in p.collect())
    assert len(set(names)) == 4 and "listings-3.0.278.06172022.06042022.xml" in names
    assert "agent-2.0.278.06172022.xml" in names
