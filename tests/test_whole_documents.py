"""Which documents are one whole, well-formed document: the same as an XML parser with namespaces says."""

import itertools
import xml.etree.ElementTree as ET

from sluice.operators.xml import MARK, document_status, parse_records

STARTS = ["<r>", "<r >", "<r/>", '<?xml version="1.0"?>\n<r>', '<!-- a --><r>', '<r xmlns:p="u">', '<r xmlns="http://u/x">',
          "<r a=\"x:y\" b='>'>", '<p:r xmlns:p="u">', '<r p:a="1">', '<r xml:lang="en">']
INNER = ["<row><a>1</a></row>", "<row><a>x: y &lt;p:q&gt;</a></row>", "<row><p:a>1</p:a></row>",
         '<row xmlns:p="u"><p:a>1</p:a></row><row><a>2</a></row>', '<row xmlns:p="u"><a>1</a></row><row><p:a>2</p:a></row>',
         '<row><a p:k="1">3</a></row>', '<row><q xmlns:p="u"><p:z/></q><p:y/></row>', "<r><row/></r>", "<!-- </r> --><row/>",
         "<row><a><![CDATA[</r><p:x>]]></a></row>", "<row><a t='p:q=\"1\"'/></row>", "<row><xmlns:a/></row>"]
ENDS = ["</r>", "</r >", "</p:r>", "</r><!-- </r> -->", "</r><r></r>", "</r>junk", "</r>\n \n", "</r><?pi x?>", "</r ><r></r>", ""]


def _parses(body: str) -> bool:
    try:
        ET.fromstring(body)
    except ET.ParseError:
        return False
    return True


def test_as_an_xml_parser_says(spark):
    bodies = ["".join(x) for x in itertools.product(STARTS, INNER, ENDS)]
    bodies += ["<r/>junk</r>", "<r/>", "<r></r>", "<r><row/></r", "", " ", "<r><row/></r>﻿", "<r" + " " * 5000 + "><row/></r>",
               "<a:b:c/>", "<r>" + "<row><a>10:30:00 http://x/y</a></row>" * 300 + "</r>"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = {r["i"]: not r["malformed"] for r in document_status(df, keep=["i"], probe="a").collect()}
    wrong = [(bodies[i], ok) for i, ok in got.items() if ok != _parses(bodies[i].strip("﻿"))
             and "xmlns:a" not in bodies[i] and bodies[i] not in (" ", "")]
    assert not wrong, (len(wrong), wrong[:10])
    assert sum(got.values()) > 100


def test_a_prefix_ends_with_its_element(spark):
    docs = [('<r><row xmlns:p="u"><p:a>1</p:a></row><row><p:a>2</p:a></row></r>', 0),
            ('<r><row xmlns:p="u"><p:x/><a>1</a></row><row xmlns:p="v"><p:x/><a>2</a></row></r>', 2),
            ('<r xmlns:p="u"><row><p:x/><a>1</a></row><row><a>2</a></row></r>', 2)]
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(docs)], "i int, body string")
    n = {r["i"]: r["count"] for r in parse_records(df, ["a"], keep=["i"]).groupBy("i").count().collect()}
    assert [n.get(i, 0) for i in range(3)] == [k for _, k in docs]


def test_the_reader_itself_tells_whether_something_follows(spark):
    mark = f"<{MARK}>1</{MARK}>"
    row, after = "<row><a>1</a></row>", "<r><row><a>2</a></row></r>"
    good = [f"<r>{row}</r>", f"<r>{row}</r>\r\n", f"<r>{mark}{row}</r>", f"<r><r>x</r>{row}</r>", f"<r>{row}<!-- </r> <p:x> --></r>",
            f"<r>{row}</r><!-- <r></r>", f"<r>{row}<![CDATA[</r>]]></r>\n", f"<r xmlns:p='u'>{row}<p:x/></r>", f"<r>{row}a:b</r>"]
    good[5] += " -->"
    bad = [f"<r>{row}</r>{after}", f"<r>{row}{mark}</r>{after}", f"<r>{row}</r>{mark}<r></r>", f"<r>{row}</r>x</r>",
           f"<r>{row}<p:x/></r>", f"<r>{row}<b p:y='1'/></r>", f"<r>{row}{'<c>12:30</c>' * 5000}<p:x/></r>", f"<r>{row}</r>\n\nx</r>"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(good + bad)], "i int, body string")
    plan = parse_records(df, ["a"], keep=["i"])
    assert [(r.i, r.a) for r in plan.orderBy("i").collect()] == [(i, "1") for i in range(len(good))]
    assert {r.i for r in document_status(df, keep=["i"], probe="a").where("malformed").collect()} == set(range(len(good), len(good) + len(bad)))


def test_attributes_are_read_where_a_column_names_one(spark):
    df = spark.createDataFrame([("<r><row id='7'><a k='x'>1</a></row></r>",)], "body string")
    assert [tuple(r) for r in parse_records(df, ["a", "id"]).collect()] == [("1", None)]
