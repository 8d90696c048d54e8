"""Dropped files: strict decoding, byte for byte, in batch and as a stream."""

import os

import pytest

from sluice.operators.xml import parse_records
from sluice.sources.files import decode_documents, read_document_files
from sluice.streaming.incremental import incremental_load, read_incremental

DOC = "<r><row><mlsSid>{0}</mlsSid><agentId>Núñez {0}</agentId></row></r>"


def _said(name, text):
    return f'<?xml version="1.0" encoding="{name}"?>{text}'


GOOD = [
    ("plain", DOC.format(1).encode(), DOC.format(1)),
    ("marked", b"\xef\xbb\xbf" + DOC.format(2).encode(), DOC.format(2)),
    ("latin-1", _said("ISO-8859-1", DOC.format(3)).encode("latin-1"), _said("ISO-8859-1", DOC.format(3))),
    ("latin-1 by alias, small letters", _said("latin1", DOC.format(4)).encode("latin-1"), _said("latin1", DOC.format(4))),
    ("windows", _said("windows-1252", DOC.format("€")).encode("cp1252"), _said("windows-1252", DOC.format("€"))),
    ("utf-16 le", b"\xff\xfe" + DOC.format("\U0001f600").encode("utf-16-le"), DOC.format("\U0001f600")),
    ("utf-16 be", b"\xfe\xff" + _said("UTF-16", DOC.format(6)).encode("utf-16-be"), _said("UTF-16", DOC.format(6))),
    ("utf-16 unmarked", _said("UTF-16", DOC.format(7)).encode("utf-16-le"), _said("UTF-16", DOC.format(7))),
    ("japanese", _said("Shift_JIS", "<r><row><agentId>日本</agentId></row></r>").encode("shift_jis"),
     _said("Shift_JIS", "<r><row><agentId>日本</agentId></row></r>")),
    ("a replacement character that is meant", DOC.format("�").encode(), DOC.format("�")),
    ("the same in utf-16", b"\xff\xfe" + DOC.format("�").encode("utf-16-le"), DOC.format("�")),
    ("ascii", _said("US-ASCII", "<r/>").encode(), _said("US-ASCII", "<r/>")),
    ("empty", b"", ""), ("mark only", b"\xef\xbb\xbf", ""),
]
BAD = [
    ("latin-1 undeclared", DOC.format(1).encode("latin-1"), "not UTF-8"),
    ("cut letter", DOC.format(1).encode()[:DOC.format(1).encode().index(b"\xc3") + 1], "not UTF-8"),
    ("overlong", b"<r>\xc0\xaf</r>", "not UTF-8"),
    ("surrogate in utf-8", b"<r>\xed\xa0\x80</r>", "not UTF-8"),
    ("beyond ascii", _said("US-ASCII", DOC.format(1)).encode("latin-1"), "not US-ASCII"),
    ("hole in windows", _said("windows-1252", "<r>").encode() + b"\x81</r>", "not WINDOWS-1252"),
    ("odd utf-16", b"\xff\xfe<\x00r\x00>", "not UTF-16LE"),
    ("lone surrogate", b"\xff\xfe<\x00\x00\xd8>\x00", "not UTF-16LE"),
    ("utf-16 said of single bytes", _said("UTF-16", DOC.format(1)).encode(), "unknown encoding UTF-16"),
    ("unknown", _said("x-none", "<r/>").encode(), "unknown encoding X-NONE"),
    ("broken japanese", _said("Shift_JIS", "<r>").encode() + b"\x81</r>", "not SHIFT_JIS"),
]


def test_decoding(spark):
    rows = [(n, bytearray(b)) for n, b, _ in GOOD + BAD] + [("null", None)]
    before = spark.conf.get("spark.sql.legacy.codingErrorAction")
    out = decode_documents(spark.createDataFrame(rows, "name string, content binary"))
    assert spark.conf.get("spark.sql.legacy.codingErrorAction") == before
    got = {r["name"]: (r["body"], r["error"]) for r in out.collect()}
    assert {n: got[n] for n, _, _ in GOOD} == {n: (t, None) for n, _, t in GOOD}
    assert {n: got[n] for n, _, _ in BAD} == {n: (None, f"undecodable body: {e}") for n, _, e in BAD}
    assert got["null"] == (None, None)


@pytest.fixture()
def drop(spark, scratch):
    path = scratch("files").removeprefix("file:")
    os.makedirs(path)
    for i, (_, data, _) in enumerate(GOOD[:8] + BAD[:4]):
        with open(f"{path}/d{i}.xml", "wb") as f:
            f.write(data)
    with open(f"{path}/other.txt", "wb") as f:
        f.write(b"\xff")
    return path


def test_files_in_batch_and_as_a_stream(spark, scratch, drop):
    files = read_document_files(spark, drop)
    assert files.count() == 12 and files.where("error is not null").count() == 4
    ids = sorted(r[0] for r in parse_records(files, ["agentId"]).collect())
    assert ids == sorted(f"Núñez {x}" for x in (1, 2, 3, 4, "€", "\U0001f600", 6, 7))
    out, log, bad = scratch("incr"), scratch("log"), scratch("bad")
    run = lambda: incremental_load(spark, drop, "agents-all-1.0", out, ckpt, files=True, log_path=log, quarantine_path=bad)
    ckpt = scratch("ckpt")
    assert run() == 1 and run() == 0
    assert sorted(r["agentId"] for r in read_incremental(spark, out, "agents-all-1.0").collect()) == ids
    said = {r["request_id"]: (r["status"], r["message"]) for r in spark.read.parquet(log).collect()}
    assert said == {f"d{i}.xml": ("success", "") if i < 8 else ("failed", f"ERROR: fetch: undecodable body: {BAD[i - 8][2]}")
                    for i in range(12)}
    assert {r["reason"] for r in spark.read.parquet(bad).collect()} == {"undecodable document"}
