import os

from pyspark.sql import functions as F

from sluice.loads import feed_summary, load_feed, load_feeds, load_json_api
from sluice.plans.catalog import feed_catalog, source_ids
from sluice.plans.requests import plan_requests
from sluice.sources.fetch import fetch_payloads
from sluice.sources.landing import export_documents, land_payloads, read_landed, read_landed_files
from sluice.sources.transport import FileTransport, HttpTransport

GOOD = "<r><row><mlsSid>7</mlsSid><agentId>a1</agentId></row><row><mlsSid>7</mlsSid><agentId>a2</agentId></row></r>"
BAD = "<r><row><mlsSid>7</mlsSid><agentId>a1</agentId></row>"


def _payloads(spark, rows):
    return spark.createDataFrame(rows, "request_id string, endpoint string, mlsSid bigint, error string, body string")


def test_load_feed_run_log_and_append_twice(spark, scratch):
    p = _payloads(spark, [("r1", "agents-all-1.0", 7, None, GOOD), ("r2", "agents-all-1.0", 8, None, BAD),
                          ("r3", "agents-all-1.0", 9, "HTTP 500", None), ("x", "office-2.0", 1, None, GOOD)])
    path = scratch("feed")
    log = load_feed(spark, p, "agents-all-1.0", path=path)
    got = {r.request_id: (r.status, r.rows, r.message) for r in log.collect()}
    assert got == {"r1": ("success", 2, ""), "r2": ("failed", 0, "ERROR: malformed document"),
                   "r3": ("failed", 0, "ERROR: fetch: HTTP 500")}
    table = spark.read.parquet(path)
    assert table.columns == ["mlsSid", "agentId", "agentFirstName", "agentLastName", "agentOfficeId", "agentStatus"]
    assert sorted(r.agentId for r in table.collect()) == ["a1", "a2"]
    load_feed(spark, p, "agents-all-1.0", path=path)      # append again: duplicated, by design
    assert spark.read.parquet(path).count() == 4


def test_catalog_table_append_and_schema_drift(spark, scratch):
    name = "sluice_test_" + os.urandom(4).hex()
    p = _payloads(spark, [("r1", "agents-all-1.0", 7, None, GOOD)])
    log = load_feed(spark, p, "agents-all-1.0", table=name, fmt="parquet", path=scratch("tbl"))
    assert [r.status for r in log.collect()] == ["success"]
    assert spark.table(name).count() == 2
    # Another feed's records do not fit this table: the write fails, the run log says so.
    p2 = _payloads(spark, [("r9", "office-2.0", 7, None, GOOD)])
    log2 = load_feed(spark, p2, "office-2.0", table=name, fmt="parquet")
    r = log2.first()
    assert r.status == "failed" and r.message.startswith("ERROR: write:")
    assert spark.table(name).count() == 2


def test_load_feeds_isolated_and_ordered(spark, scratch):
    p = _payloads(spark, [("a", "agents-all-1.0", 7, None, GOOD), ("b", "office-2.0", 7, None, BAD)])
    paths = {"agents-all-1.0": scratch("a"), "office-2.0": scratch("o")}
    log = load_feeds(spark, p, ["office-2.0", "agents-all-1.0"], paths=paths)
    summary = [(r.endpoint, r.result, r.rows) for r in feed_summary(log).collect()]
    assert summary == [("office-2.0", "ERROR: 1 of 1 requests failed", 0), ("agents-all-1.0", "success", 2)]
    from sluice.loads import feed_results
    assert feed_results(log) == ["ERROR: 1 of 1 requests failed", "success"]


def test_json_api_all_or_nothing(spark, scratch):
    ok = '{"status": 200, "result": {"country": "c", "european_electoral_region": "e", "latitude": 1.5, ' \
         '"longitude": 2.0, "parliamentary_constituency": "p", "region": "r"}}'
    p = spark.createDataFrame([("1", ok), ("2", ok)], "request_id string, body string")
    path = scratch("api")
    status, msg, log = load_json_api(spark, p, path=path)
    assert status == "success" and spark.read.parquet(path).count() == 2
    broken = spark.createDataFrame([("1", ok), ("2", '{"status": 200, "result": {"country": "c"}}')],
                                   "request_id string, body string")
    path2, q = scratch("api"), scratch("q")
    status, msg, log = load_json_api(spark, broken, path=path2, quarantine_path=q)
    assert status == "failed" and "missing field result.european_electoral_region" in msg
    assert not os.path.exists(path2.replace("file:", ""))
    assert [r.request_id for r in spark.read.parquet(q).collect()] == ["2"]


def test_fetch_land_parse_through_files(spark, scratch):
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["agents-all-1.0"],
                         as_of="2022-06-17")
    drop = scratch("drop")
    have = reqs.where(F.col("mlsSid") != 92).select(
        "endpoint", "landing_name",
        F.format_string("<r><row><mlsSid>%d</mlsSid><agentId>x</agentId></row></r>", "mlsSid").alias("body"))
    assert export_documents(have, drop).count() == 6
    payloads = fetch_payloads(reqs, FileTransport(drop), concurrency=3)
    landing = scratch("landing")
    land_payloads(payloads, landing)
    landed = read_landed(spark, landing, endpoint="agents-all-1.0", load_date="2022-06-17")
    got = {r.mlsSid: (r.http_status, r.body is not None) for r in landed.collect()}
    assert got[92] == (404, False) and all(v == (200, True) for k, v in got.items() if k != 92)
    log = load_feed(spark, landed, "agents-all-1.0", path=scratch("t"))
    by = {r.mlsSid: r.status for r in log.collect()}
    assert by[92] == "failed" and sum(s == "success" for s in by.values()) == 6
    files = read_landed_files(spark, drop)
    assert files.count() == 6 and files.where(F.col("file_name").endswith(".06172022.xml")).count() == 6


def test_http_transport_never_stores_token(spark):
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["office-2.0"],
                         as_of="2022-06-17")
    t = HttpTransport(token="SECRET-TOKEN", timeout=1)
    assert "SECRET" not in repr(t)
    assert all("{1}" in r.url and "SECRET" not in r.url for r in reqs.collect())
    status, body, err = t({"url": "notaurl{1}", "landing_name": "x", "endpoint": "e"})
    assert status is None and body is None and "ValueError" in err and "SECRET" not in err


def test_run_feeds_end_to_end(spark, scratch):
    from sluice.loads import feed_summary, run_feeds
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat",
                         endpoints=["agents-all-1.0", "office-2.0"], as_of="2022-06-17")
    drop = scratch("drop")
    have = reqs.where(~((F.col("endpoint") == "office-2.0") & (F.col("mlsSid") == 36))).select(
        "endpoint", "landing_name",
        F.format_string("<r><row><mlsSid>%d</mlsSid><agentId>x</agentId><officeId>o</officeId></row></r>",
                        "mlsSid").alias("body"))
    export_documents(have, drop).count()
    paths = {"agents-all-1.0": scratch("a"), "office-2.0": scratch("o")}
    log = run_feeds(spark, env="uat", endpoints=["agents-all-1.0", "office-2.0", "nope-1.0"],
                    as_of="2022-06-17", transport=FileTransport(drop), landing_path=scratch("landing"),
                    paths=paths)
    s = {r.endpoint: (r.result, r.rows) for r in feed_summary(log).collect()}
    assert s == {"agents-all-1.0": ("success", 7), "office-2.0": ("ERROR: 1 of 7 requests failed", 6),
                 "nope-1.0": ("ERROR: 1 of 1 requests failed", 0)}
    assert spark.read.parquet(paths["office-2.0"]).count() == 6


def test_missing_table_format_is_a_failed_load(spark):
    p = _payloads(spark, [("r1", "agents-all-1.0", 7, None, GOOD)])
    log = load_feed(spark, p, "agents-all-1.0", table="sluice_delta_" + os.urandom(3).hex(), fmt="delta")
    r = log.first()
    assert r.status == "failed" and r.message.startswith("ERROR: write:") and r.rows == 0


def test_unknown_feed_is_a_failed_row(spark):
    p = _payloads(spark, [("r1", "nope-1.0", 7, None, GOOD)])
    r = load_feed(spark, p, "nope-1.0").first()
    assert (r.request_id, r.status, r.message) == ("r1", "failed", "ERROR: unknown feed")


def test_run_log_written_and_read_back(spark, scratch):
    p = _payloads(spark, [("a", "agents-all-1.0", 7, None, GOOD), ("b", "office-2.0", 7, None, BAD)])
    logs = scratch("log")
    paths = {"agents-all-1.0": scratch("a"), "office-2.0": scratch("o")}
    log = load_feeds(spark, p, ["office-2.0", "agents-all-1.0"], paths=paths, log_path=logs, run_id="run-1")
    assert sorted((r.endpoint, r.status) for r in log.collect()) == [("agents-all-1.0", "success"),
                                                                      ("office-2.0", "failed")]
    assert spark.read.parquet(logs).where("run_id = 'run-1'").count() == 2


def test_unconfigured_tags_are_reported(spark, scratch):
    doc = "<r><row><agentId>1</agentId></row><agent><agentId>2</agentId></agent></r>"
    p = _payloads(spark, [("r1", "agents-all-1.0", 7, None, doc)])
    r = load_feed(spark, p, "agents-all-1.0", path=scratch("t"), check_tags=True).first()
    assert (r.status, r.rows, r.message) == ("success", 1, "WARNING: 1 records under unconfigured row tags")
    r2 = load_feed(spark, p, "agents-all-1.0", path=scratch("t"), check_tags=True,
                   row_tags=["row", "agent"]).first()
    assert (r2.rows, r2.message) == (2, "")


def test_cli_file_run(spark, scratch, capsys):
    from sluice.cli import main
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["agents-all-1.0"],
                         as_of="2022-06-17")
    drop = scratch("drop")
    export_documents(reqs.select("endpoint", "landing_name",
                                 F.format_string("<r><row><agentId>%d</agentId></row></r>", "mlsSid")
                                 .alias("body")), drop).count()
    code = main(["--env", "uat", "--endpoint", "agents-all-1.0", "--as-of", "2022-06-17",
                 "--landing", scratch("landing"), "--transport", "file", "--root", drop])
    assert code == 0
    assert "agents-all-1.0\tsuccess\trows=7" in capsys.readouterr().out
    # a catalog file with other record tags: the same documents now hold no records
    cfg = scratch("cfg").replace("file:", "") + ".json"
    with open(cfg, "w") as f:
        f.write('{"row_tags": {"agents-all-1.0": ["agent"]}}')
    code = main(["--env", "uat", "--endpoint", "agents-all-1.0", "--as-of", "2022-06-17", "--catalog", cfg,
                 "--landing", scratch("landing"), "--transport", "file", "--root", drop])
    assert code == 0
    assert "agents-all-1.0\tsuccess\trows=0" in capsys.readouterr().out


def test_run_feeds_uses_catalog_row_tags(spark, scratch):
    from sluice.loads import run_feeds
    cat = feed_catalog(spark, row_tags={"agents-all-1.0": ["agent"]})
    reqs = plan_requests(cat, source_ids(spark), env="uat", endpoints=["agents-all-1.0"], as_of="2022-06-17")
    drop = scratch("drop")
    export_documents(reqs.select("endpoint", "landing_name",
                                 F.format_string("<r><agent><agentId>%d</agentId></agent></r>", "mlsSid")
                                 .alias("body")), drop).count()
    out = scratch("t")
    log = run_feeds(spark, env="uat", endpoints=["agents-all-1.0"], as_of="2022-06-17", feeds=cat,
                    transport=FileTransport(drop), landing_path=scratch("landing"),
                    paths={"agents-all-1.0": out})
    assert sum(r.rows for r in log.collect()) == 7
    assert spark.read.parquet(out).count() == 7


class _Answer:
    def __init__(self, data, status=200):
        self.data, self.status = data, status

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def read(self):
        return self.data


def test_http_transport_answers(monkeypatch):
    import urllib.request
    sent = []

    def answer(data, status=200):
        monkeypatch.setattr(urllib.request, "urlopen", lambda r, timeout: sent.append(r.full_url) or _Answer(data, status))
        return HttpTransport(token="T", timeout=5)({"url": "https://x.example.com/{1}", "landing_name": "x", "endpoint": "e"})

    text = "<r><a>Nu\u00f1ez</a></r>"
    assert answer(text.encode()) == (200, text, None) and sent == ["https://x.example.com/T"]
    latin = '<?xml version="1.0" encoding="ISO-8859-1"?>' + text
    assert answer(latin.encode("latin-1")) == (200, latin, None)
    assert answer(b"\xef\xbb\xbf" + text.encode()) == (200, text, None)
    assert answer(text.encode("utf-16")) == (200, text, None)
    for data in (text.encode("latin-1"), latin.replace("ISO-8859-1", "no-such").encode()):
        status, body, error = answer(data)
        assert status == 200 and body is None and error.startswith("undecodable body")
    assert answer(b"", 204) == (204, None, "HTTP 204")


def test_only_http_is_sent(tmp_path):
    (tmp_path / "secret").write_text("x")
    for url in (f"file://{tmp_path}/secret", "data:text/plain,x", "ftp://x.example.com/a"):
        status, body, error = HttpTransport()({"url": url, "landing_name": "x", "endpoint": "e"})
        assert status is None and body is None and "only http" in error


def test_undecodable_body_fails_its_request(spark, scratch):
    drop = scratch("drop")
    root = drop.replace("file:", "") + "/agents-all-1.0"
    os.makedirs(root)
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["agents-all-1.0"], as_of="2022-06-17")
    names = [r.landing_name for r in reqs.orderBy("mlsSid", "landing_name").collect()]
    doc = "<r><row><agentId>Nu\u00f1ez</agentId></row></r>"
    for i, name in enumerate(names):
        with open(f"{root}/{name}", "wb") as f:
            f.write([doc.encode(), ('<?xml version="1.0" encoding="ISO-8859-1"?>' + doc).encode("latin-1"),
                     doc.encode("latin-1")][i % 3])
    out = scratch("t")
    log = load_feed(spark, fetch_payloads(reqs, FileTransport(drop)), "agents-all-1.0", path=out)
    rows = log.collect()
    bad = [r for r in rows if r.status == "failed"]
    assert len(bad) == len(names) // 3 and all("ERROR: fetch: undecodable body" in r.message for r in bad)
    assert {r.agentId for r in spark.read.parquet(out).collect()} == {"Nu\u00f1ez"}


def test_paths_by_store():
    import pytest

    from sluice.sources.storage import pyarrow_uri, qualify
    assert qualify("/data/x") == "file:///data/x" and qualify("/data/x", "hdfs://nn:8020") == "hdfs://nn:8020/data/x"
    assert qualify("s3a://b/k", "hdfs://nn:8020") == "s3a://b/k"
    with pytest.raises(ValueError):
        qualify("data/x", "hdfs://nn:8020")
    assert pyarrow_uri("file:/data/x") == "file:///data/x" == pyarrow_uri("file:///data/x")
    assert pyarrow_uri("dbfs:/ck/x") == "file:///dbfs/ck/x"
    assert pyarrow_uri("s3a://b/k") == "s3://b/k" and pyarrow_uri("hdfs://nn/x") == "hdfs://nn/x"
    assert pyarrow_uri("abfss://c@a.dfs.core.windows.net/x") == "abfss://c@a.dfs.core.windows.net/x"
    for bad in ("wasbs://c@a/x", "viewfs://store/x", "/data/x", "s3a:/b"):
        with pytest.raises(ValueError):
            pyarrow_uri(bad)
    with pytest.raises(ValueError):
        FileTransport("wasbs://c@a/x")


def test_cluster_without_shared_folder_is_an_error():
    import pytest

    from sluice.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_operators_leave_the_session_alone(spark):
    import pytest

    from sluice.operators.xml import parse_records
    df = spark.createDataFrame([("<r><row><a>1</a></row></r>",)], "body string")
    spark.conf.set("spark.sql.caseSensitive", "false")
    try:
        with pytest.raises(ValueError, match="caseSensitive"):
            parse_records(df, ["a"])
        assert spark.conf.get("spark.sql.caseSensitive") == "false"
    finally:
        spark.conf.set("spark.sql.caseSensitive", "true")


def test_every_asked_feed_has_a_result(spark, scratch):
    from sluice.loads import feed_results, run_feeds
    none = source_ids(spark).where("env = 'nowhere'")
    log = run_feeds(spark, env="uat", endpoints=["office-2.0", "agent-2.0"], as_of="2022-06-17", sources=none,
                    transport=FileTransport(scratch("drop")), landing_path=scratch("landing"),
                    paths={"office-2.0": scratch("o"), "agent-2.0": scratch("a")})
    assert feed_results(log) == ["success", "success"]
    assert [(r.requests, r.rows) for r in feed_summary(log).collect()] == [(0, 0), (0, 0)]


def test_cap_counts_records_across_parts(spark, scratch):
    doc = "<r>" + "".join(f"<row><agentId>{i}</agentId></row>" for i in range(50)) + "</r>"
    from sluice.sources.split import split_documents
    whole = spark.createDataFrame([("r1", "agents-all-1.0", doc)], "request_id string, endpoint string, body string")
    parts = split_documents(whole, 300)
    assert parts.count() > 3
    for payloads in (whole, parts):
        out = scratch("t")
        log = load_feed(spark, payloads, "agents-all-1.0", path=out, max_records=17)
        assert [(r.status, r.rows) for r in log.collect()] == [("success", 17)]
        assert sorted(int(r.agentId) for r in spark.read.parquet(out).collect()) == list(range(17))


API_OK = ('{"status": 200, "result": {"country": "c", "european_electoral_region": "e", "latitude": 1.5, '
          '"longitude": 2, "parliamentary_constituency": "p", "region": "r"}}')


def _api_answers(scratch, names):
    drop = scratch("drop")
    root = drop.replace("file:", "") + "/api"
    os.makedirs(root)
    for name in names:
        with open(f"{root}/{name}", "w") as f:
            f.write(API_OK)
    return drop


def test_json_api_job_fetches_twice(spark, scratch):
    from sluice.plans.requests import plan_api_requests
    reqs = plan_api_requests(spark, "https://api.example.com", passes=2, as_of="2022-06-17")
    payloads = fetch_payloads(reqs, FileTransport(_api_answers(scratch, ["api.1.json", "api.2.json"])))
    path = scratch("api")
    status, message, log = load_json_api(spark, payloads, path=path)
    assert status == "success" and [r.status for r in log.collect()] == ["success", "success"]
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and {(r.country, r.latitude, r.longitude) for r in rows} == {("c", "1.5", "2")}



def test_only_tables_are_loaded_directly(spark, scratch):
    from sluice.loads import _landed
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", as_of="2022-06-17")
    fetched = fetch_payloads(reqs, FileTransport(scratch("x")))
    assert _landed(fetched) is not fetched
    landing = scratch("landing")
    land_payloads(fetched, landing)
    landed = read_landed(spark, landing, endpoint="office-2.0").select("request_id", "body")
    assert _landed(landed) is landed
    drawn = landed.withColumn("u", F.rand())
    assert _landed(drawn) is not drawn or drawn.count() == _landed(drawn).count()


def test_live_fetch_loaded_directly_fetches_once(spark, scratch):
    calls = scratch("calls").replace("file:", "")
    os.makedirs(calls)

    class Counting(FileTransport):
        def __call__(self, request):
            with open(f"{calls}/{os.urandom(6).hex()}", "w") as f:
                f.write(request["request_id"])
            return super().__call__(request)

    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["agents-all-1.0"],
                         as_of="2022-06-17")
    drop = scratch("drop")
    export_documents(reqs.select("endpoint", "landing_name",
                                 F.format_string("<r><row><agentId>%d</agentId></row></r>", "mlsSid")
                                 .alias("body")), drop).count()
    log = load_feed(spark, fetch_payloads(reqs, Counting(drop)), "agents-all-1.0", path=scratch("t"))
    assert sum(r.rows for r in log.collect()) == 7
    assert len(os.listdir(calls)) == 7


def test_unknown_feed_rows_from_landed_payloads(spark, scratch):
    import datetime as dt
    landing = scratch("landing")
    land_payloads(spark.createDataFrame([("r1", "nope-1.0", GOOD, dt.date(2022, 6, 17))],
                                        "request_id string, endpoint string, body string, load_date date"),
                  landing)
    landed = read_landed(spark, landing)
    assert [r.part for r in landed.collect()] == [0]
    r = load_feed(spark, landed, "nope-1.0").first()
    assert (r.request_id, r.message) == ("r1", "ERROR: unknown feed")


def test_cli_api_job(spark, scratch, capsys):
    from sluice.cli import main
    path = scratch("api")
    drop = _api_answers(scratch, ["api.1.json", "api.2.json"])
    assert main(["api", "--url", "https://api.example.com", "--path", path, "--transport", "file", "--root", drop]) == 0
    assert capsys.readouterr().out.startswith("success\t")
    assert spark.read.parquet(path).count() == 2



def test_xml_quarantine_and_log_table(spark, scratch):
    p = _payloads(spark, [("r1", "agents-all-1.0", 7, None, GOOD), ("r2", "agents-all-1.0", 8, None, BAD),
                          ("r3", "agents-all-1.0", 9, "HTTP 500", None)])
    q, logs = scratch("q"), scratch("logs")
    log = load_feed(spark, p, "agents-all-1.0", path=scratch("t"), quarantine_path=q, log_path=logs,
                    run_id="run-q")
    assert sorted((r.request_id, r.reason) for r in spark.read.parquet(q).collect()) == [
        ("r2", "malformed document"), ("r3", "fetch failed")]
    assert sorted((r.request_id, r.status) for r in log.collect()) == [
        ("r1", "success"), ("r2", "failed"), ("r3", "failed")]
    assert spark.read.parquet(logs).where("run_id = 'run-q'").count() == 3


def test_run_feeds_discovers_tags(spark, scratch):
    from sluice.loads import run_feeds
    reqs = plan_requests(feed_catalog(spark), source_ids(spark), env="uat", endpoints=["agents-all-1.0"],
                         as_of="2022-06-17")
    drop = scratch("drop")
    export_documents(reqs.select("endpoint", "landing_name",
                                 F.format_string("<r><agent><agentId>%d</agentId></agent></r>", "mlsSid")
                                 .alias("body")), drop).count()
    out = scratch("t")
    log = run_feeds(spark, env="uat", endpoints=["agents-all-1.0"], as_of="2022-06-17",
                    transport=FileTransport(drop), landing_path=scratch("landing"),
                    paths={"agents-all-1.0": out}, discover_tags=True)
    assert sum(r.rows for r in log.collect()) == 7 and spark.read.parquet(out).count() == 7
