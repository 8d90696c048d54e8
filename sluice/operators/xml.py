"""XML payloads -> flat all-string records (O-03, O-05, O-16, O-20, O-23).

Semantics kept from the feed protocol:

* a record is a direct child of the document root; its tag must be one of
  the feed's configured row tags (Spark's XML reader binds fields by name);
* a field is the text of the first direct child of that name; absent or
  empty -> null; text is not trimmed; undeclared elements and attributes
  are dropped; names are case-sensitive;
* a malformed document is rejected whole; the other documents go on.

The parse is Spark's built-in ``from_xml`` on executors.  Every declared
field is read as ``array<string>`` so that the first of repeated elements
wins and an empty element is visible as ''.  Records come from one full
parse per document: malformed documents come back with null records, so
records are taken with ``explode_outer`` + ``IS NOT NULL`` rather than
with a filter on the parse result, which the optimizer would duplicate
into a second parse.  Per-document status (well-formed? how many
records?) comes from ``document_status``, a light parse that builds no
fields, so loads never cache parsed documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.plans.catalog import DEFAULT_ROW_TAGS, feed_columns, feed_schema
from sluice.session import require_conf
from sluice.sources.split import cap_documents
from sluice.sources.tags import root_children_count

BAD = "_bad"
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD,
    "ignoreSurroundingSpaces": "false",
}


BOM = "\ufeff"

# Markup that cannot hold an element (comments, CDATA, processing instructions, DOCTYPE).
_NO_ELEMENT = (r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
               r"|<!DOCTYPE[^\[>]*(?:\[.*?\]\s*)?>")
_QUOTED = r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*"""


def parse_ready(body: Column) -> Column:
    """The body as handed to the XML reader: no leading byte-order mark."""
    return F.when(body.startswith(BOM), F.substring(body, 2, 2 ** 31 - 1)).otherwise(body)


#: Child that is put in before a document's last tag, and is read if that tag ends the root.
MARK = "sluice-end"


def read_whole(docs: DataFrame, fields: str, columns: Sequence[str], body: str = "_body", as_col: str = "_whole") -> DataFrame:
    """Add ``_x``, the document read with the DDL ``fields`` (records of ``columns``), and whether a body that the reader accepts is one whole document.

    The reader stops at the end of the root element and takes undeclared
    prefixes.  So: nothing but blanks, comments and processing instructions
    may follow the root, and every prefix must be declared where it is used.

    Nearly all documents begin with a plain start tag and end with its end tag.
    A child put in before that last tag is read as the root's last one
    exactly if that tag ends the root, so the reader itself tells whether
    something follows and the text is not searched.  The child holds a hash of
    the document, so that none of its own can stand for it.  Only
    the other documents pay for regular expressions over their tags.
    """
    raw = F.col(body)
    # An attribute could only be read by a column that begins as the reader names attributes.
    options = XML_OPTIONS | {"excludeAttribute": str(not any(c.startswith("_") for c in columns)).lower()}
    docs = docs.withColumn("_name", F.regexp_extract(F.substring(raw, 1, 4096), _PLAIN_START, 1))
    end = F.concat(F.lit("</"), F.col("_name"), F.lit(">"),
                   F.when(raw.endswith("\r\n"), "\r\n").when(raw.endswith("\n"), "\n").otherwise(""))
    # Cut as bytes: a string would be counted through for its characters.
    before = F.call_function("substring", raw.cast("binary"), F.lit(1), F.octet_length(raw) - F.octet_length(end)).cast("string")
    child = F.concat(F.lit(f"<{MARK}>"), F.xxhash64(raw).cast("string"), F.lit(f"</{MARK}>"))
    docs = docs.withColumn("_marked", F.when((F.col("_name") != "") & raw.endswith(end), F.concat(before, child, end)))
    docs = docs.withColumn("_x", F.from_xml(parse_ready(F.coalesce("_marked", raw)), f"{_q(MARK)} array<string>, {fields}", options))
    last = F.col(f"_x.{_q(MARK)}")
    seen = F.get(last, F.size(last) - 1) == F.xxhash64(raw).cast("string")
    docs = docs.withColumn("_plain", F.col("_marked").isNotNull() & F.coalesce(seen, F.lit(False)))
    # Beyond here only what is not plain: markup that cannot hold an element goes, the root's own tags are walked.
    # (Trimming looks at every character, so plain documents are not trimmed.)
    cleaned = F.when(raw.contains("<!") | raw.contains("<?"), F.regexp_replace(raw, _NO_ELEMENT, "")).otherwise(raw)
    docs = docs.withColumn("_text", F.when(~F.col("_plain"), F.trim(cleaned, F.lit(" \t\r\n" + BOM))))
    name = F.concat(F.lit("\\Q"), F.regexp_extract("_text", r"^<([^\s/>!?]+)", 1), F.lit("\\E"))
    own_tags = F.regexp_extract_all("_text", F.concat(F.lit("</?"), name, F.lit(r"(?=[\s/>])" + _QUOTED + ">")), F.lit(0))
    docs = docs.withColumn("_tags", F.when(~F.col("_plain"), own_tags))
    walk = F.aggregate(
        F.col("_tags"), F.struct(F.lit(0).alias("depth"), F.lit(0).alias("ends")),
        lambda acc, tag: F.struct(
            (acc["depth"] + F.when(tag.startswith("</"), -1).when(tag.endswith("/>"), 0).otherwise(1)).alias("depth"),
            # how often the root element is over: at a closing tag that leaves no open one, or an empty root,
            # and at any of its tags behind that
            (acc["ends"] + F.when((acc["ends"] > 0) | (tag.startswith("</") & (acc["depth"] == 1))
                                  | (tag.endswith("/>") & (acc["depth"] == 0)), 1).otherwise(0)).alias("ends")),
        lambda acc: acc["ends"])
    ends_once = ((F.size("_tags") > 0) & (walk == 1)
                 & F.col("_text").endswith(F.get("_tags", F.size("_tags") - 1)))
    prefixed = raw.contains(":") & (_prefixed_name(raw) | (raw.contains("=") & raw.rlike(_PREFIXED_VALUE)))
    bound = F.when(prefixed, prefixes_bound(cleaned)).otherwise(True)
    whole = F.when(F.col("_plain"), True).otherwise(ends_once) & bound
    return (docs.withColumn(as_col, F.coalesce(whole, F.lit(False)))
            .drop("_name", "_marked", "_plain", "_text", "_tags"))


# A start tag without prefix declarations in sight is found whole; an empty root or anything before it is not plain.
_PLAIN_START = r"""^\ufeff?(?:<\?xml\s[^<>]*\?>\s*)?<([^\s/<>!?]+)(?:\s+[^\s=/<>]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*>"""
# A colon that may belong to a prefix: in the name of an element (of 100 characters at most before it), or of something
# that is assigned a quoted value.
_PREFIXED_NAME = r"""</?[^\s<>:='"!?/]{1,100}+:"""
_NAME_ONLY = r"""^/?[^\s<>:='"!?/]{1,100}+\z"""
_COLONS = 4096
_PREFIXED_VALUE = r""":[^\s<>:='"/]+\s*=\s*["']"""
_ANY_TAG = r"""<[^<>"'!?]+(?:"[^"<]*"[^<>"']*+|'[^'<]*'[^<>"']*+)*+>"""


def _prefixed_name(text: Column) -> Column:
    """Does ``_PREFIXED_NAME`` match?  With few colons only what stands before each is looked at; of a malformed text
    it may say yes."""
    pieces = F.split(text, ":", _COLONS)
    at_name = F.exists(pieces, lambda p: F.substring_index(p, "<", -1).rlike(_NAME_ONLY) & p.contains("<"))
    return F.when(F.size(pieces) < _COLONS, at_name).otherwise(text.rlike(_PREFIXED_NAME))


def prefixes_bound(text: Column) -> Column:
    """Is every prefix of a well-formed document (without comments) declared on its element or one around it?

    Walks all tags with the prefixes declared so far and the depth of each
    declaration, which ends with its element.
    """
    def step(acc: Column, tag: Column) -> Column:
        bare = F.regexp_replace(tag, """"[^"]*"|'[^']*'""", "''")
        declared = F.transform(F.regexp_extract_all(bare, F.lit(r"\sxmlns:([^\s=]+)\s*="), F.lit(1)),
                               lambda p: F.struct((acc["depth"] + 1).alias("depth"), p.alias("prefix")))
        inside = F.concat(acc["scopes"], declared)
        used = F.regexp_extract_all(bare, F.lit(r"(?:^<|\s)([^\s<>/:=']+):"), F.lit(1))
        known = F.concat(F.transform(inside, lambda s: s["prefix"]), F.array(F.lit("xml"), F.lit("xmlns")))
        closing, empty = tag.startswith("</"), tag.endswith("/>")
        return F.struct(
            (acc["depth"] + F.when(closing, -1).when(empty, 0).otherwise(1)).alias("depth"),
            F.when(closing, F.filter(acc["scopes"], lambda s: s["depth"] < acc["depth"]))
             .when(empty, acc["scopes"]).otherwise(inside).alias("scopes"),
            (acc["ok"] & (closing | (F.size(F.array_except(used, known)) == 0))).alias("ok"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<struct<depth:int,prefix:string>>").alias("scopes"),
                     F.lit(True).alias("ok"))
    return F.aggregate(F.regexp_extract_all(text, F.lit(_ANY_TAG), F.lit(0)), start, step, lambda acc: acc["ok"])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def document_schema(columns: Sequence[str], row_tags: Sequence[str] = DEFAULT_ROW_TAGS) -> str:
    """DDL of a whole document: one array of records per row tag, plus the
    corrupt-record column."""
    rec = _rec_ddl(columns)
    return ", ".join(f"{_q(t)} array<{rec}>" for t in row_tags) + f", {BAD} string"


def parse_documents(payloads: DataFrame, columns: Sequence[str],
                    row_tags: Sequence[str] = DEFAULT_ROW_TAGS, *, body: str = "body",
                    keep: Sequence[str] | None = None, max_records: int | None = None,
                    check_tags: bool = False) -> DataFrame:
    """Payload level: ``keep`` columns + ``records`` + ``fetched`` + ``malformed``
    + ``n_records`` (+ ``untagged`` with ``check_tags``).

    ``records`` is null for a malformed or missing body and for a document
    without records.  ``max_records`` caps records per document (O-23,
    the request's record limit), in document order whatever their tags; for the parts of a split
    document ``first_record`` tells how many are already counted.
    """
    require_conf(payloads.sparkSession)
    keep = [c for c in (payloads.columns if keep is None else keep) if c != body]
    tags = list(row_tags)
    if max_records is not None and len(tags) > 1:
        payloads = cap_documents(payloads, _room(payloads, max_records), tags, body)
    parsed = read_whole(payloads.select(*keep, *_first(payloads, keep), F.col(body).alias("_body")), document_schema(columns, row_tags), columns)
    if len(tags) == 1:
        recs = F.col(f"_x.{_q(tags[0])}")
    else:
        empty = F.array().cast(parsed.schema["_x"].dataType[tags[0]].dataType)
        recs = F.concat(*[F.coalesce(F.col(f"_x.{_q(t)}"), empty) for t in tags])
    if max_records is not None and len(tags) == 1:
        recs = F.slice(recs, F.lit(1), _room(payloads, max_records))
    fetched = F.col("_body").isNotNull()
    malformed = fetched & (F.col(f"_x.{BAD}").isNotNull() | ~F.col("_whole"))
    recs = F.when(~malformed, recs)
    n_recs = _count(recs)
    out = [*keep, recs.alias("records"), fetched.alias("fetched"), malformed.alias("malformed"),
           n_recs.alias("n_records")]
    if check_tags:
        # Direct children of the root that no configured tag picked up; the
        # XPath count runs only on documents that parsed.
        total = F.when(fetched & ~malformed, root_children_count(F.col("_body")))
        out.append((total - n_recs).alias("untagged"))
    return parsed.select(*out)


FIRST = "first_record"


def _first(payloads: DataFrame, keep: Sequence[str]) -> list[Column]:
    """The column that says how many records stand before a part, where there is one."""
    return [F.col(FIRST)] if FIRST in payloads.columns and FIRST not in keep else []


def _room(payloads: DataFrame, max_records: int) -> Column:
    """How many records of a payload the cap leaves: a part counts those of the parts before it."""
    cap = F.lit(int(max_records))
    if FIRST not in payloads.columns:
        return cap
    return F.greatest(cap - F.coalesce(F.col(FIRST), F.lit(0)), F.lit(0)).cast("int")


def _count(arr: Column) -> Column:
    """Elements of an array column, 0 for null (``size(null)`` is -1 when
    ANSI mode is off)."""
    return F.when(arr.isNotNull(), F.size(arr)).otherwise(F.lit(0))


def document_status(payloads: DataFrame, row_tags: Sequence[str] = DEFAULT_ROW_TAGS, *,
                    body: str = "body", keep: Sequence[str] | None = None,
                    max_records: int | None = None, check_tags: bool = False,
                    probe: str = "mlsSid") -> DataFrame:
    """Per payload: ``keep`` + ``fetched`` + ``malformed`` + ``n_records``
    (+ ``untagged``), from a parse that checks well-formedness and counts
    records but builds no fields (records are read with one ``probe``
    field).  About a fifth of the cost of the full parse, so a load writes
    records from the full parse and its run log from this pass instead of
    caching the parsed documents.
    """
    require_conf(payloads.sparkSession)
    keep = [c for c in (payloads.columns if keep is None else keep) if c != body]
    rec = f"struct<{_q(probe)}: string>"
    ddl = ", ".join(f"{_q(t)} array<{rec}>" for t in row_tags) + f", {BAD} string"
    parsed = read_whole(payloads.select(*keep, *_first(payloads, keep), F.col(body).alias("_body")), ddl, [probe])
    n = sum((_count(F.col(f"_x.{_q(t)}")) for t in row_tags[1:]), _count(F.col(f"_x.{_q(row_tags[0])}")))
    found = n
    if max_records is not None:
        n = F.least(n, _room(payloads, max_records))
    fetched = F.col("_body").isNotNull()
    malformed = fetched & (F.col(f"_x.{BAD}").isNotNull() | ~F.col("_whole"))
    out = [*keep, fetched.alias("fetched"), malformed.alias("malformed"),
           F.when(fetched & ~malformed, n).otherwise(F.lit(0)).alias("n_records")]
    if check_tags:
        total = F.when(fetched & ~malformed, root_children_count(F.col("_body")))
        out.append((total - found).alias("untagged"))
    return parsed.select(*out)


def record_fields(columns: Sequence[str], rec: str = "_r") -> list[Column]:
    """O-16: fixed column set and order; first value; '' -> null."""
    return [F.nullif(F.get(F.col(f"{rec}.{_q(c)}"), 0), F.lit("")).alias(c) for c in columns]


def explode_records(parsed: DataFrame, columns: Sequence[str],
                    keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of every well-formed document."""
    rows = (parsed.select(*keep, F.explode_outer("records").alias("_r"))
                  .where(F.col("_r").isNotNull()))
    return rows.select(*keep, *record_fields(columns))


def parse_records(payloads: DataFrame, columns: Sequence[str],
                  row_tags: Sequence[str] = DEFAULT_ROW_TAGS, *, body: str = "body",
                  keep: Sequence[str] = (), max_records: int | None = None) -> DataFrame:
    """O-03: documents -> flat records (``keep`` columns + declared columns)."""
    parsed = parse_documents(payloads, columns, row_tags, body=body, keep=list(keep),
                             max_records=max_records)
    return explode_records(parsed, columns, keep)


def parse_tagged_records(payloads: DataFrame, columns: Sequence[str], row_tags: Sequence[str],
                         *, body: str = "body", keep: Sequence[str] = (),
                         tag_column: str = "row_tag") -> DataFrame:
    """Records of several row tags with the tag they came from."""
    require_conf(payloads.sparkSession)
    parts = F.concat(*[
        F.coalesce(F.transform(F.col(f"_x.{_q(t)}"), _tagger(t)),
                   F.array().cast(f"array<struct<tag:string, rec:{_rec_ddl(columns)}>>"))
        for t in row_tags])
    rows = (read_whole(payloads.select(*keep, F.col(body).alias("_body")), document_schema(columns, row_tags), columns)
                    .select(*keep, F.explode_outer(F.when(F.col("_whole"), parts)).alias("_t"))
                    .where(F.col("_t").isNotNull()))
    return rows.select(*keep, F.col("_t.tag").alias(tag_column),
                       *record_fields(columns, rec="_t.rec"))


def _tagger(tag: str):
    return lambda r: F.struct(F.lit(tag).alias("tag"), r.alias("rec"))


def _rec_ddl(columns: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"{_q(c)}: array<string>" for c in columns) + ">"


def quarantine(status: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """O-20: payloads rejected whole (missing body or malformed document), from
    ``document_status`` (or ``parse_documents``).

    Taken with ``explode_outer``, not with a filter on the status, which the
    optimizer would push below the parse and so parse every document twice.
    """
    undecodable = F.col("error").startswith("undecodable") if "error" in status.columns else F.lit(False)
    reason = (F.when(~F.col("fetched") & undecodable, F.array(F.lit("undecodable document")))
               .when(~F.col("fetched"), F.array(F.lit("fetch failed")))
               .when(F.col("malformed"), F.array(F.lit("malformed document"))))
    return status.select(*keep, F.explode_outer(reason).alias("reason")).where(F.col("reason").isNotNull())


def to_declared(df: DataFrame, endpoint: str) -> DataFrame:
    """O-05: a DataFrame with exactly the feed's declared schema (missing -> null)."""
    cols = feed_columns(endpoint)
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in cols])


def empty_feed_frame(spark: SparkSession, endpoint: str) -> DataFrame:
    """O-05: zero rows, declared schema (no column-less frames)."""
    return spark.createDataFrame([], feed_schema(endpoint))


def build_documents(rows: DataFrame, doc_key: Sequence[str] | str, fields: Sequence[str] | None = None,
                    *, row_tag: str = "row", root_tag: str = "r", tag_col: str | None = None,
                    tags: Sequence[str] | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Group rows into XML documents (``doc_key`` columns + ``body``).

    Records are sorted by their first field so documents are deterministic.
    Keep groups bounded: a document is one task's work downstream.  With
    ``tag_col``/``tags`` each row is written under the tag named in
    ``tag_col``.  Null values are left out of the document (as ``to_xml``
    does), so they read back as missing -> null.  ``extra`` are further
    aggregates per document.
    """
    keys = [doc_key] if isinstance(doc_key, str) else list(doc_key)
    fields = list(fields if fields is not None else [c for c in rows.columns if c not in keys and c != tag_col])
    rec = F.struct(*[F.col(c) for c in fields])
    if tag_col is None:
        arrays = [F.array_sort(F.collect_list(rec)).alias(row_tag)]
    else:
        arrays = [F.array_sort(F.collect_list(F.when(F.col(tag_col) == t, rec))).alias(t) for t in tags]
    doc = F.to_xml(F.struct(*arrays), {"rowTag": root_tag})
    return rows.groupBy(*keys).agg(doc.alias("body"), *extra)
