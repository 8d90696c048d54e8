"""Dropped files, byte for byte: read as binary, decoded strictly in the JVM.

A text reader replaces bytes that do not fit its encoding, so damaged text
would load as data.  Here a file's bytes are kept (``binaryFile``, in batch and
as a stream) and decoded by its byte-order mark, else by the zero bytes of
unmarked UTF-16, else by the XML declaration, else as UTF-8.  Bytes that do not
fit give no body but an error, one row per file, so that the load reports that
file as failed and goes on with the others.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DECLARED = r"""^\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._-]+)["']"""

# Names under which XML documents declare their encoding, besides UTF-8 (letters in capitals).
SINGLE_BYTE = ["US-ASCII", "ASCII", "LATIN1", "KOI8-R", "KOI8-U",
               *[f"ISO-8859-{n}" for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 15)],
               *[f"WINDOWS-{n}" for n in range(1250, 1259)], *[f"CP{n}" for n in range(1250, 1259)]]
MULTI_BYTE = ["SHIFT_JIS", "EUC-JP", "EUC-KR", "GB2312", "GBK", "BIG5"]
ROUND_TRIP = ["UTF-16LE", "UTF-16BE", "GB18030"]     # can spell the replacement character themselves
UTF8 = ["UTF-8", "UTF8"]
REPLACED = "\ufffd"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


@contextmanager
def _any_charset(spark: SparkSession):
    """All of Java's encodings, malformed bytes replaced: what ``decode`` takes up as the plan is built.

    The caller compares, so nothing that was replaced goes through.  The session is as before afterwards.
    """
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "true")
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def _encoding(data: Column) -> Column:
    """struct(name, skip): the encoding a document is in and the length of its byte-order mark."""
    head = F.hex(F.substring(data, 1, 4))
    declared = F.upper(F.regexp_extract(F.decode(F.substring(data, 1, 1024), "ISO-8859-1"), DECLARED, 1))
    found = lambda name, skip: F.struct(name.alias("name"), F.lit(skip).alias("skip"))
    return (F.when(head.startswith("EFBBBF"), found(F.lit("UTF-8"), 3))
             .when(head.startswith("FFFE"), found(F.lit("UTF-16LE"), 2))
             .when(head.startswith("FEFF"), found(F.lit("UTF-16BE"), 2))
             .when(head == "3C003F00", found(F.lit("UTF-16LE"), 0))
             .when(head == "003C003F", found(F.lit("UTF-16BE"), 0))
             .when(declared != "", found(declared, 0))
             .otherwise(found(F.lit("UTF-8"), 0)))


def decode_documents(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with its bytes replaced by ``body`` and ``error``: the text, or why there is none.

    A null content gives null for both.  A declaration that names UTF-16 in a document of single bytes is an error,
    as are names that are not listed above.
    """
    spark = files.sparkSession
    keep = [c for c in files.columns if c != content]
    with _any_charset(spark):
        sniffed = files.select(*keep, F.col(content).alias("_data"), _encoding(F.col(content)).alias("_enc"))
        name = F.col("_enc.name")
        bytes_ = F.expr("substring(_data, _enc.skip + 1, octet_length(_data))")
        utf8, other = name.isin(UTF8), name.isin(SINGLE_BYTE + MULTI_BYTE + ROUND_TRIP)
        text = F.when(utf8, F.try_validate_utf8(bytes_.cast("string"))).when(other, F.call_function("decode", bytes_, name))
        decoded = sniffed.select(*keep, "_data", "_enc", text.alias("_text"))
        again = F.call_function("encode", F.col("_text"), name)
        fits = (F.when(utf8, F.col("_text").isNotNull())
                 .when(name.isin(ROUND_TRIP), F.coalesce(again == bytes_, F.lit(False)))
                 .otherwise(~F.col("_text").contains(REPLACED)))
        error = (F.when(F.col("_data").isNull(), F.lit(None).cast("string"))
                  .when(~utf8 & ~other, F.concat(F.lit("undecodable body: unknown encoding "), name))
                  .when(~fits, F.concat(F.lit("undecodable body: not "), name)))
        checked = decoded.select(*keep, "_text", error.alias("error"))
        return checked.select(*keep, F.when(F.col("error").isNull(), F.col("_text")).alias("body"), "error")


def read_document_files(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """One row per file under ``path``: file_name, file_path, length, modified, body, error."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path))
    return decode_documents(file_rows(files))


def stream_document_files(reader, path: str, glob: str = "*.xml") -> DataFrame:
    """The same files as a stream of file_name, file_path, length, modified, content; decode each batch."""
    return file_rows(reader.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob).load(path))


def file_rows(files: DataFrame) -> DataFrame:
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("path").alias("file_path"), "length",
                        F.col("modificationTime").alias("modified"), "content")
