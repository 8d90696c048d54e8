"""Logs made up for after a lost driver, landing retention, manifests of loaded files."""

import pytest
from pyspark.sql import functions as F

from sluice import loads
from sluice.loads import INTERRUPTED, feed_results, load_feeds, recover_log
from sluice.sources.landing import drop_loaded, land_payloads, read_landed
from sluice.streaming.incremental import incremental_load, read_incremental, read_manifest

FEEDS = ["office-2.0", "agents-all-1.0"]


def _landed(spark, path, run_id="run-1", ids=range(4), day="2022-06-17", bad=()):
    rows = [(run_id, f"{e}:{i}", e, i, "<r>" if (e, i) in bad else f"<r><row><mlsSid>{i}</mlsSid></row></r>", day)
            for e in FEEDS for i in ids]
    land_payloads(spark.createDataFrame(rows, "run_id string, request_id string, endpoint string, mlsSid long, body string, load_date string")
                  .withColumn("load_date", F.to_date("load_date")), path)
    return read_landed(spark, path, run_id=run_id)


def test_log_is_made_up_for_after_the_appends(spark, scratch, monkeypatch):
    landing, log, journal, root = (scratch(x) for x in ("landing", "log", "journal", "feeds"))
    payloads = _landed(spark, landing, bad=[("office-2.0", 2)])
    paths = {e: f"{root}/{e}" for e in FEEDS}

    def lost(*a, **k):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(loads, "_run_log", lost)
        with pytest.raises(RuntimeError):
            load_feeds(spark, payloads, FEEDS, paths=paths, run_id="run-1", log_path=log, journal_path=journal)
    assert spark.read.parquet(paths["office-2.0"]).count() == 3
    got = recover_log(spark, payloads, journal, log, run_id="run-1")
    want = load_feeds(spark, payloads, FEEDS, paths={e: f"{root}/again/{e}" for e in FEEDS}, run_id="run-2")
    key = lambda r: (r["feed_ordinal"], r["request_id"], r["endpoint"], r["status"], r["rows"], r["message"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.count() == 8
    assert recover_log(spark, payloads, journal, log, run_id="run-1").count() == 8      # nothing is added twice
    assert feed_results(got) == ["ERROR: 1 of 4 requests failed", "success"]


def test_an_append_that_only_started_is_a_failure(spark, scratch, monkeypatch):
    landing, log, journal, root = (scratch(x) for x in ("landing", "log", "journal", "feeds"))
    payloads = _landed(spark, landing)

    class Lost(BaseException):
        pass

    def write(*a):
        raise Lost
    with monkeypatch.context() as m:
        m.setattr(loads, "_write", write)
        with pytest.raises(Lost):
            load_feeds(spark, payloads, FEEDS[:1], paths={FEEDS[0]: root}, run_id="run-1", log_path=log, journal_path=journal)
    got = recover_log(spark, payloads, journal, log, run_id="run-1").collect()
    assert {(r["status"], r["rows"], r["message"]) for r in got} == {("failed", 0, f"ERROR: write: {INTERRUPTED}")} and len(got) == 4


def test_a_whole_run_needs_no_recovery(spark, scratch):
    landing, log, journal = (scratch(x) for x in ("landing", "log", "journal"))
    payloads = _landed(spark, landing)
    load_feeds(spark, payloads, FEEDS, paths={e: scratch(e) for e in FEEDS}, run_id="run-1", log_path=log, journal_path=journal)
    states = [r["state"] for r in spark.read.parquet(journal).collect()]
    assert sorted(states) == ["done", "done", "started", "started"]
    assert recover_log(spark, payloads, journal, log, run_id="run-1").count() == 8


def test_retention_drops_old_loaded_partitions_only(spark, scratch):
    landing, log = scratch("landing"), scratch("log")
    days = {"2022-06-10": [], "2022-06-11": [("office-2.0", 1)], "2022-06-16": []}
    for n, (day, bad) in enumerate(days.items()):
        payloads = _landed(spark, landing, f"run-{n}", day=day, bad=bad)
        load_feeds(spark, payloads, FEEDS, paths={e: scratch(e) for e in FEEDS}, run_id=f"run-{n}", log_path=log)
    _landed(spark, landing, "run-9", ids=[7], day="2022-06-09")      # landed, never loaded
    gone = drop_loaded(spark, landing, spark.read.parquet(log), keep_days=3, as_of="2022-06-17")
    assert sorted(gone) == [("agents-all-1.0", "2022-06-10"), ("agents-all-1.0", "2022-06-11"), ("office-2.0", "2022-06-10")]
    left = {(r["endpoint"], str(r["load_date"])) for r in read_landed(spark, landing).collect()}
    assert left == {("office-2.0", "2022-06-11"), *[(e, d) for e in FEEDS for d in ("2022-06-16", "2022-06-09")]}
    assert drop_loaded(spark, landing, spark.read.parquet(log), keep_days=3, as_of="2022-06-17") == []


@pytest.mark.parametrize("files", [False, True])
def test_manifest_outlives_the_checkpoint(spark, scratch, files):
    import os
    landing, out, manifest = scratch("landing").removeprefix("file:"), scratch("incr"), scratch("manifest")

    def more(n):
        if files:
            os.makedirs(landing, exist_ok=True)
            with open(f"{landing}/d{n}.xml", "w") as f:
                f.write(f"<r><row><mlsSid>{n}</mlsSid></row></r>")
        else:
            _landed(spark, landing, ids=[n])
    load = lambda ckpt: incremental_load(spark, landing, "office-2.0", out, ckpt, files=files, manifest_path=manifest)
    more(1)
    more(2)
    first = scratch("ckpt")
    load(first)
    more(3)
    load(first)
    more(4)
    load(scratch("ckpt"))       # the checkpoint is lost: every file is offered again
    assert sorted(r["mlsSid"] for r in read_incremental(spark, out, "office-2.0").collect()) == ["1", "2", "3", "4"]
    names = read_manifest(spark, manifest)
    assert names.count() == names.select("path").distinct().count() == (4 if files else names.count())
