"""Parser edge cases: literal documents, expected rows written by hand."""

import pytest

from sluice.operators.xml import parse_documents, parse_records, quarantine

COLS = ["mlsSid", "a", "b"]
N = None

CASES = [
    ("plain", "<r><row><mlsSid>1</mlsSid><a>x</a><b>y</b></row></r>", [("1", "x", "y")]),
    ("missing", "<r><row><mlsSid>1</mlsSid></row></r>", [("1", N, N)]),
    ("empty", "<r><row><mlsSid>1</mlsSid><a></a><b/></row></r>", [("1", N, N)]),
    ("all empty", "<r><row/></r>", [(N, N, N)]),
    ("whitespace", "<r><row><mlsSid> 1 </mlsSid><a>  </a></row></r>", [(" 1 ", "  ", N)]),
    ("duplicate", "<r><row><a>1</a><a>2</a></row></r>", [(N, "1", N)]),
    ("empty first", "<r><row><a/><a>2</a></row></r>", [(N, N, N)]),
    ("attribute", "<r><row id='7'><a k='v'>x</a></row></r>", [(N, "x", N)]),
    ("comment, CDATA", "<r><row><a>x<!-- c -->y</a><b><![CDATA[<q>]]></b></row></r>", [(N, "xy", "<q>")]),
    ("entity", "<r><row><a>x&amp;y &#233;</a></row></r>", [(N, "x&y é", N)]),
    ("case", "<r><row><A>1</A></row></r>", [(N, N, N)]),
    ("prefix", "<r xmlns:n='u'><row><n:a>1</n:a></row></r>", [(N, N, N)]),
    ("two rows", "<r><row><a>1</a></row><row><b>2</b></row></r>", [(N, "1", N), (N, N, "2")]),
    ("leading zeros", "<r><row><a>007</a><b>1e5</b></row></r>", [(N, "007", "1e5")]),
    ("text null", "<r><row><a>null</a></row></r>", [(N, "null", N)]),
    ("no rows", "<r/>", []),
    ("not a direct child", "<r><row><x><a>1</a></x><b>2</b></row></r>", [(N, N, "2")]),
    ("declaration", "<?xml version='1.0' encoding='UTF-8'?>\n<r><row><a>1</a></row></r>", [(N, "1", N)]),
    ("unicode", "<r><row><a>日本 – ü</a></row></r>", [(N, "日本 – ü", N)]),
    # Documented difference: markup inside a declared leaf comes back as its
    # raw inner text instead of the text before the first child.
    ("default xmlns", "<r xmlns='u'><row><a>1</a></row></r>", [(N, "1", N)]),
]

REJECTED = [
    ("mismatched", "<r><row><a>1</a></row><row><a>2</row></r>"),
    ("truncated", "<r><row><a>1</a></row><row><a>2</a>"),
    ("not XML", "hello"),
    ("blank", ""),
]


def _key(t):
    return tuple("" if x is None else str(x) for x in t)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


@pytest.mark.parametrize("name,doc,expected", CASES, ids=[c[0] for c in CASES])
def test_case(spark, name, doc, expected):
    df = spark.createDataFrame([(doc,)], "body string")
    assert _rows(parse_records(df, COLS)) == sorted(expected, key=_key)


@pytest.mark.parametrize("name,doc", REJECTED, ids=[c[0] for c in REJECTED])
def test_rejected_whole(spark, name, doc):
    df = spark.createDataFrame([(1, doc), (2, "<r><row><a>ok</a></row></r>")], "id int, body string")
    assert _rows(parse_records(df, COLS, keep=["id"])) == [(2, N, "ok", N)]
    q = quarantine(parse_documents(df, COLS, keep=["id"]), keep=["id"])
    assert _rows(q) == [(1, "malformed document")]


def test_missing_body_is_not_a_record(spark):
    df = spark.createDataFrame([(1, None)], "id int, body string")
    assert parse_records(df, COLS).count() == 0
    q = quarantine(parse_documents(df, COLS, keep=["id"]), keep=["id"])
    assert _rows(q) == [(1, "fetch failed")]


def test_other_tags_need_configuring(spark):
    doc = "<r><p><a>1</a></p><q><a>2</a></q></r>"
    df = spark.createDataFrame([(doc,)], "body string")
    assert parse_records(df, COLS).count() == 0
    assert _rows(parse_records(df, COLS, ["p", "q"])) == [(N, "1", N), (N, "2", N)]
    checked = parse_documents(df, COLS, ["p"], check_tags=True).select("n_records", "untagged").first()
    assert tuple(checked) == (1, 1)


def test_record_cap_keeps_document_order(spark):
    doc = "<r>" + "".join(f"<row><a>{i}</a></row>" for i in range(10)) + "</r>"
    df = spark.createDataFrame([(doc,)], "body string")
    assert [r.a for r in parse_records(df, COLS, max_records=3).collect()] == ["0", "1", "2"]


def test_parse_once(spark):
    """The document parser appears once in the plan (no re-parse for filters)."""
    df = spark.createDataFrame([("<r><row><a>1</a></row></r>",)], "body string")
    plan = parse_records(df, COLS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1


def test_declared_schema_even_when_empty(spark):
    from sluice.operators.xml import empty_feed_frame, to_declared
    e = empty_feed_frame(spark, "agents-all-1.0")
    assert e.count() == 0 and len(e.columns) == 6
    df = spark.createDataFrame([("1", "x")], "agentId string, extra string")
    out = to_declared(df, "agents-all-1.0")
    assert out.columns[:2] == ["mlsSid", "agentId"] and out.first().agentId == "1"


def test_external_entities_are_never_resolved(spark, tmp_path):
    secret = tmp_path / "secret.txt"
    secret.write_text("TOPSECRET")
    doc = (f'<?xml version="1.0"?><!DOCTYPE r [<!ENTITY x SYSTEM "file://{secret}">]>'
           '<r><row><a>&x;</a></row></r>')
    df = spark.createDataFrame([(1, doc)], "id int, body string")
    assert parse_records(df, COLS).count() == 0        # documents with a DTD are rejected whole
    q = quarantine(parse_documents(df, COLS, keep=["id"]), keep=["id"])
    assert _rows(q) == [(1, "malformed document")]


def test_counts_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(1, "<r/>"), (2, "<r><row><a>1</a></row></r>")], "id int, body string")
        got = sorted((r.id, r.n_records) for r in parse_documents(df, COLS, keep=["id"]).collect())
        assert got == [(1, 0), (2, 1)]
        from sluice.operators.xml import document_status
        got = sorted((r.id, r.n_records) for r in document_status(df, keep=["id"], probe="a").collect())
        assert got == [(1, 0), (2, 1)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_external_doctype_is_ignored_internal_subset_rejected(spark):
    docs = [(1, '<?xml version="1.0"?>\n<!DOCTYPE r SYSTEM "http://feeds.example.com/r.dtd">\n<r><row><a>1</a></row></r>'),
            (2, '<!DOCTYPE r PUBLIC "-//x//y" "r.dtd"><r><row><a>2</a></row></r>'),
            (3, '<!DOCTYPE r [<!ENTITY e "x">]><r><row><a>&e;</a></row></r>'),
            (4, '\ufeff<?xml version="1.0"?><!DOCTYPE r SYSTEM "r.dtd"><r><row><a>4</a></row></r>')]
    df = spark.createDataFrame(docs, "id int, body string")
    assert _rows(parse_records(df, COLS, keep=["id"])) == [(1, N, "1", N), (2, N, "2", N), (4, N, "4", N)]
    status = {r.id: (r.malformed, r.n_records, r.untagged)
              for r in parse_documents(df, COLS, keep=["id"], check_tags=True).collect()}
    assert status[1] == (False, 1, 0) and status[2] == (False, 1, 0) and status[3][0]
