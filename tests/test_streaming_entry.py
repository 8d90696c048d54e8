import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sluice.sources.landing import land_payloads
from sluice.streaming.incremental import incremental_load, read_incremental

SF = "/root/testdata/sf0.001"


def _landed(spark, rows, day="2022-06-17"):
    return spark.createDataFrame(
        [(f"r{i}", 0, "agents-all-1.0", i, "", "", f"f{i}.xml", 200, None, b, dt.datetime(2022, 6, 17),
          dt.date.fromisoformat(day)) for i, b in rows],
        "request_id string, feed_ordinal int, endpoint string, mlsSid bigint, fromDate string, toDate string, "
        "landing_name string, http_status int, error string, body string, fetched_at timestamp, load_date date")


def doc(i):
    return f"<r><row><mlsSid>{i}</mlsSid><agentId>a{i}</agentId></row></r>"


def test_incremental_each_file_once(spark, scratch):
    landing, out, ckpt, bad = scratch("landing"), scratch("out"), scratch("ckpt"), scratch("bad")
    land_payloads(_landed(spark, [(1, doc(1)), (2, doc(2))]), landing)
    assert incremental_load(spark, landing, "agents-all-1.0", out, ckpt, quarantine_path=bad) == 1
    assert incremental_load(spark, landing, "agents-all-1.0", out, ckpt, quarantine_path=bad) == 0
    land_payloads(_landed(spark, [(3, doc(3)), (4, "<r><row>")], day="2022-06-18"), landing)
    incremental_load(spark, landing, "agents-all-1.0", out, ckpt, quarantine_path=bad)
    got = sorted(r.agentId for r in read_incremental(spark, out, "agents-all-1.0").collect())
    assert got == ["a1", "a2", "a3"]
    assert [r.request_id for r in spark.read.parquet(bad).collect()] == ["r4"]


def test_incremental_run_log(spark, scratch):
    landing, out, ckpt, log = scratch("landing"), scratch("out"), scratch("ckpt"), scratch("log")
    land_payloads(_landed(spark, [(1, doc(1)), (2, "<r><row>"), (3, doc(3) + "junk")]), landing)
    incremental_load(spark, landing, "agents-all-1.0", out, ckpt, log_path=log)
    rows = sorted((r.request_id, r.status, r.rows, r.message) for r in spark.read.parquet(log).collect())
    assert rows == [("r1", "success", 1, ""), ("r2", "failed", 0, "ERROR: malformed document"),
                    ("r3", "failed", 0, "ERROR: malformed document")]


def test_a_second_checkpoint_keeps_what_is_there(spark, scratch):
    out = scratch("out")
    for rows in ([(1, doc(1)), (2, doc(2))], [(9, doc(9))]):
        landing = scratch("landing")
        land_payloads(_landed(spark, rows), landing)
        incremental_load(spark, landing, "agents-all-1.0", out, scratch("ckpt"), quarantine_path=scratch("q"))
    assert sorted(r.agentId for r in read_incremental(spark, out, "agents-all-1.0").collect()) == ["a1", "a2", "a9"]


def test_late_files_are_loaded(spark, scratch):
    import os
    import time
    drop = scratch("drop").replace("file:", "")
    os.makedirs(drop)
    out, ckpt = scratch("out"), scratch("ckpt")
    for i, age in ((1, 0), (2, 10), (3, 4000)):
        with open(f"{drop}/a{i}.xml", "w") as f:
            f.write(doc(i))
        then = time.time() - age * 86_400
        os.utime(f"{drop}/a{i}.xml", (then, then))
        assert incremental_load(spark, drop, "agents-all-1.0", out, ckpt, files=True) == 1
    assert read_incremental(spark, out, "agents-all-1.0").count() == 3


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 40 and df.count() > 0


def test_every_query_has_an_oracle():
    from sluice.testdata_feeds import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


FAST = ["xml_roundtrip_orders", "xml_bad_payloads", "xml_first_duplicate", "xml_row_tags",
        "json_api_payloads", "request_plan", "default_window", "table_names", "feed_load_log", "cap_records"]


@pytest.mark.parametrize("name", FAST)
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    theirs = sorted(tuple(str(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs


def test_incremental_from_file_drops(spark, scratch):
    drop = scratch("drop").replace("file:", "")
    import os
    os.makedirs(drop)
    out, ckpt = scratch("out"), scratch("ckpt")
    for i in (1, 2):
        with open(f"{drop}/a{i}.xml", "w") as f:
            f.write(doc(i))
    assert incremental_load(spark, drop, "agents-all-1.0", out, ckpt, files=True) == 1
    with open(f"{drop}/a3.xml", "w") as f:
        f.write('<?xml version="1.0" encoding="UTF-8"?>\n' + doc(3))
    with open(f"{drop}/ignored.txt", "w") as f:
        f.write(doc(9))
    incremental_load(spark, drop, "agents-all-1.0", out, ckpt, files=True)
    incremental_load(spark, drop, "agents-all-1.0", out, ckpt, files=True)
    got = sorted(r.agentId for r in read_incremental(spark, out, "agents-all-1.0").collect())
    assert got == ["a1", "a2", "a3"]


def test_backlog_in_bounded_batches(spark, scratch):
    landing, out, ckpt = scratch("landing"), scratch("out"), scratch("ckpt")
    for i in range(3):
        land_payloads(_landed(spark, [(10 + i, doc(10 + i))]).coalesce(1), landing)
    assert incremental_load(spark, landing, "agents-all-1.0", out, ckpt, max_files_per_trigger=1) == 3
    assert read_incremental(spark, out, "agents-all-1.0").count() == 3


def test_always_on_incremental(spark, scratch):
    landing, out, ckpt = scratch("landing"), scratch("out"), scratch("ckpt")
    land_payloads(_landed(spark, [(21, doc(21))]), landing)
    q = incremental_load(spark, landing, "agents-all-1.0", out, ckpt, every="1 second")
    try:
        q.processAllAvailable()
        land_payloads(_landed(spark, [(22, doc(22))]), landing)
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.agentId for r in read_incremental(spark, out, "agents-all-1.0").collect()) == ["a21", "a22"]


def test_replayed_batch_does_not_duplicate(spark, scratch, tmp_path):
    landing, out, ckpt = scratch("landing"), scratch("out"), scratch("ckpt")
    land_payloads(_landed(spark, [(31, doc(31)), (32, doc(32)), (33, "<r><row>")]), landing)
    blocker = tmp_path / "not-a-dir"
    blocker.write_text("x")                      # a file: the quarantine write under it fails
    with pytest.raises(Exception):
        incremental_load(spark, landing, "agents-all-1.0", out, ckpt, quarantine_path=str(blocker / "q"))
    # the failed batch had already written its records; the rerun replays it
    assert read_incremental(spark, out, "agents-all-1.0").count() == 2
    good_q = scratch("q")
    assert incremental_load(spark, landing, "agents-all-1.0", out, ckpt, quarantine_path=good_q) == 1
    got = sorted(r.agentId for r in read_incremental(spark, out, "agents-all-1.0").collect())
    assert got == ["a31", "a32"]
    assert spark.read.parquet(good_q).count() == 1


def test_file_drop_stream_splits_large_files(spark, scratch):
    import os
    drop = scratch("drop").replace("file:", "")
    os.makedirs(drop)
    big = "<r>" + "".join(f"<row><mlsSid>{i}</mlsSid><agentId>b{i}</agentId></row>" for i in range(300)) + "</r>"
    with open(f"{drop}/big.xml", "w") as f:
        f.write(big)
    out, ckpt, q = scratch("out"), scratch("ckpt"), scratch("q")
    assert incremental_load(spark, drop, "agents-all-1.0", out, ckpt, files=True, split_bytes=1000,
                            quarantine_path=q) == 1
    got = read_incremental(spark, out, "agents-all-1.0")
    assert got.count() == 300 and got.select("agentId").distinct().count() == 300


def test_cli_incremental(spark, scratch, capsys):
    from sluice.cli import main
    landing, out, ckpt = scratch("landing"), scratch("out"), scratch("ckpt")
    land_payloads(_landed(spark, [(41, doc(41)), (42, doc(42))]), landing)
    args = ["incremental", "--endpoint", "agents-all-1.0", "--landing", landing, "--table-path", out,
            "--checkpoint", ckpt]
    assert main(args) == 0 and "batches=1" in capsys.readouterr().out
    assert main(args) == 0 and "batches=0" in capsys.readouterr().out
    assert read_incremental(spark, out, "agents-all-1.0").count() == 2
