"""Scale properties of the physical plans, guarded as regressions."""

from pyspark.sql import functions as F

from sluice.operators.xml import explode_records, parse_documents
from sluice.plans.catalog import feed_columns
from sluice.sources.landing import land_payloads, read_landed
from sluice.testdata_feeds import listing_payloads

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_path_is_one_pruned_stage(spark, scratch):
    p = listing_payloads(spark, SF).select("request_id", "endpoint", "mlsSid", "body",
                                           F.to_date(F.lit("2022-06-17")).alias("load_date"))
    landing = scratch("landing")
    land_payloads(p, landing)
    land_payloads(p.withColumn("endpoint", F.lit("office-2.0")), landing)
    landed = read_landed(spark, landing, endpoint="listings-3.0", load_date="2022-06-17")
    cols = feed_columns("listings-3.0")
    recs = explode_records(parse_documents(landed.select("request_id", "mlsSid", "body"), cols,
                                           keep=["request_id"]), cols, keep=["request_id"])
    plan = _plan(recs)
    assert "Exchange" not in plan                      # no shuffle between landing and records
    assert plan.count("from_xml(") == 1                # each document parsed once
    formatted = recs._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "(endpoint#" in formatted and "= listings-3.0)" in formatted.split("PartitionFilters:")[1].split("\n")[0]
    # every order comes back once: the office-2.0 copy was never read
    assert recs.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_landing_scan_reads_only_needed_columns(spark, scratch):
    p = listing_payloads(spark, SF).select("request_id", "endpoint", "mlsSid", "body",
                                           F.to_date(F.lit("2022-06-17")).alias("load_date"))
    landing = scratch("landing")
    land_payloads(p, landing)
    df = read_landed(spark, landing, endpoint="listings-3.0").select("body")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<body:string>" in plan


def test_landing_reads_list_only_selected_partitions(spark, scratch):
    import datetime as dt

    from sluice.sources.landing import partition_path
    rows = [("r1", "a-1.0", "<r/>", dt.date(2022, 6, 17)), ("r2", "b-1.0", "<r/>", dt.date(2022, 6, 17)),
            ("r3", "a-1.0", "<r/>", dt.date(2022, 6, 18))]
    landing = scratch("landing")
    land_payloads(spark.createDataFrame(rows, "request_id string, endpoint string, body string, load_date date"),
                  landing)
    one = read_landed(spark, landing, endpoint="a-1.0", load_date="2022-06-17")
    assert [(r.request_id, r.endpoint) for r in one.collect()] == [("r1", "a-1.0")]
    files = one.inputFiles()
    assert files and all("endpoint=a-1.0/load_date=2022-06-17/" in f for f in files)
    day = read_landed(spark, landing, load_date="2022-06-17")
    assert sorted(r.request_id for r in day.collect()) == ["r1", "r2"]
    assert read_landed(spark, landing, endpoint="zzz-1.0").count() == 0
    assert partition_path("/x", "we:ird", None) == "/x"


def test_quarantine_parses_once_and_sql_plan_has_no_nested_loop(spark):
    from sluice.plans.catalog import feed_catalog, source_ids
    from sluice.plans.requests import plan_requests_sql
    from sluice.testdata_feeds import QUERIES
    assert _plan(QUERIES["xml_quarantine"](spark, SF)).count("from_xml(") == 1
    plan = _plan(plan_requests_sql(spark, feed_catalog(spark), source_ids(spark), env="dev", as_of="2022-06-17"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_status_pass_is_one_stage(spark, scratch):
    from sluice.operators.xml import document_status
    p = listing_payloads(spark, SF).select("request_id", "endpoint", "mlsSid", "body",
                                           F.to_date(F.lit("2022-06-17")).alias("load_date"))
    landing = scratch("landing")
    land_payloads(p, landing)
    landed = read_landed(spark, landing, endpoint="listings-3.0", load_date="2022-06-17")
    status = document_status(landed.select("request_id", "body"), keep=["request_id"])
    plan = _plan(status)
    assert "Exchange" not in plan and plan.count("from_xml(") == 1
    assert status.where("n_records > 0").count() == p.count()
