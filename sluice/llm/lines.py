"""Line de-duplication by winnowing over line hashes.

A document is the sequence of its lines that are not blank, each as the hash of
its stripped bytes.  A window is the shortest run of lines from a line on that
has ``min_words`` words: one line, if that is long enough.  Every window selects
its least hash (the first of equals): the selected positions are the
document's fingerprints, and two equal windows always select the same one.  So
a repeated run of ``min_words`` words or more shares a fingerprint with its
earlier copy: only positions whose fingerprint occurs again are joined.

There a window is joined to the first place of the same window (compared by a
128-bit hash of its lines), one partner for each, however many copies there are,
and the match is extended both ways along its diagonal.  To the right it takes
the lines behind the window that follow the first place as well, as far as they
make no window of their own.  To the left there is nothing to compare: the window that begins one
line earlier lies in the match, so it is a match itself.  Matches on one
diagonal that touch form one run.

Earlier means a smaller id, then an earlier line.  The first copy of a run
stays, its later copies are deleted: a line goes if and only if it lies in a
window that occurs earlier, or in the extension of one.  Frequent lines are
skewed keys: minima and counts are combined before the shuffle and joins are
sort-merge joins that adaptive execution splits; copies are never paired with
each other.

Defined results: blank lines never match, and stay; lines of fewer than
``min_words`` words go as part of a longer run only; a null text stays null and
has no lines; rows that repeat id and text count as one document and lose the
same lines; a null id comes after all others; other columns are left alone, and
the result column ``as_col`` must not be among them; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import byte_slices, materialise, read_table, texts_as_bytes

#: A shorter run is too likely to repeat by chance.
MIN_WORDS = 5
_BLANK = b" \t\r\x0b\x0c"


def solid_lines(raw: bytes) -> tuple[list[bytes], list[int]]:
    """All lines, and the numbers of those that are not blank."""
    lines = raw.split(b"\n")
    return lines, [i for i, x in enumerate(lines) if x.strip(_BLANK)]


def line_windows(raw: bytes, words: int) -> dict[str, np.ndarray | list]:
    """Of each window: its fingerprint's ``place``, that fingerprint ``fp``, first line ``s``, length ``n``, the 128-bit hash
    (``a``, ``b``) and the hashes of the lines behind it that make no window (``tail``)."""
    lines, solid = solid_lines(raw)
    ends = np.cumsum([0] + [len(lines[i].split()) for i in solid])
    n_windows = int(np.searchsorted(ends, ends[-1] - words, side="right"))
    if not n_windows:
        return {k: np.empty(0, np.int64) for k in ("place", "fp", "s", "n", "a", "b")} | {"tail": []}
    digests = b"".join(xxhash.xxh3_128_digest(lines[i].strip(_BLANK)) for i in solid)
    least = np.frombuffer(digests, "<u8")[::2]
    s = np.arange(n_windows)
    to = np.searchsorted(ends, ends[s] + words, side="left")         # the line behind the window
    place = s.copy()
    for j in range(1, int((to - s).max())):
        at = np.minimum(s + j, to - 1)
        place = np.where(least[at] < least[place], at, place)
    whole = np.frombuffer(b"".join(xxhash.xxh3_128_digest(digests[16 * i:16 * e]) for i, e in zip(s.tolist(), to.tolist(), strict=True)),
                          "<i8").reshape(-1, 2)
    behind = np.searchsorted(ends, ends[to] + words, side="left") - 1   # behind the last line that is no window with those before
    signed = least.view(np.int64)
    return {"place": place, "fp": signed[place], "s": s, "n": to - s, "a": whole[:, 0], "b": whole[:, 1],
            "tail": [signed[x:y].tolist() for x, y in zip(to.tolist(), behind.tolist(), strict=True)]}


_WINDOW = "s:int,n:int,a:long,b:long,tail:array<long>"


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """One row per selected position: fp, key, digest and the windows that selected it."""
    rows = docs.select(F.col(id_col).alias("key"), F.xxhash64(F.col(text_col)).alias("digest"),
                       F.col(text_col).alias("text")).where("text is not null")
    window = pa.struct([("s", pa.int32()), ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("tail", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2):
                found = [line_windows(t, words) for t in texts_as_bytes(batch.column(2))]
                # Windows of one selected position are neighbours.
                starts = [np.flatnonzero(np.r_[True, f["place"][1:] != f["place"][:-1]]) if len(f["place"]) else f["place"]
                          for f in found]
                of = pa.array(np.repeat(np.arange(len(found)), [len(s) for s in starts]), pa.int64())
                base = np.cumsum([0] + [len(f["place"]) for f in found])
                fp = np.concatenate([f["fp"][s] for f, s in zip(found, starts, strict=True)])
                offsets = np.r_[np.concatenate([s + b for s, b in zip(starts, base, strict=False)]), base[-1]]
                columns = [pa.array(np.concatenate([f[c] for f in found]), window.field(c).type) for c in ("s", "n", "a", "b")]
                tails = pa.array([t for f in found for t in f["tail"]], pa.list_(pa.int64()))
                windows = pa.StructArray.from_arrays([*columns, tails], fields=list(window))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp, pa.int64()), batch.column(0).take(of), batch.column(1).take(of),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), windows)],
                    names=["fp", "key", "digest", "windows"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"fp long, key {kind}, digest long, windows array<struct<{_WINDOW}>>")


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, digest, s, e, first): every window that occurs earlier, extended to the right, as lines s to e - 1, and the
    struct of its first place."""
    prints = materialise(_fingerprints(docs, id_col, text_col, min_words), "lines-prints")
    again = materialise(prints.groupBy(F.col("fp").alias("of")).count().where("count > 1").select("of"), "lines-again")
    found = (prints.hint("merge").join(again.hint("merge"), F.col("fp") == F.col("of"), "left_semi")
             .select("key", "digest", F.explode("windows").alias("w"))
             .select("w.a", "w.b", "w.n",
                     F.struct(F.col("key").isNull().alias("none"), "key", "digest", "w.s", "w.tail").alias("at")))
    found = materialise(found, "lines-windows")
    first = materialise(found.groupBy(F.col("a").alias("a1"), F.col("b").alias("b1"))
                        .agg(F.min("at").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"),
                        "lines-first")
    # How far the lines behind both places go on alike.
    alike = F.zip_with("at.tail", "first.tail", lambda x, y: F.coalesce(x == y, F.lit(False)))
    more = F.when(F.size("at.tail") == 0, 0).otherwise(F.array_position(F.concat(alike, F.array(F.lit(False))), F.lit(False)) - 1)
    return (found.hint("merge").join(first.hint("merge"), (F.col("a") == F.col("a1")) & (F.col("b") == F.col("b1")))
            .where(~F.col("at").eqNullSafe(F.col("first")))
            .select(F.col("at.key").alias("key"), F.col("at.digest").alias("digest"), F.col("at.s").alias("s"),
                    (F.col("at.s") + F.col("n") + more).cast("int").alias("e"), "first").distinct())


def _runs(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Matches joined along their diagonals: key, digest, of, of_digest, apart, start, end."""
    rows = later_windows(docs, id_col, text_col, min_words).select(
        "key", "digest", "s", "e", F.col("first.key").alias("of"), F.col("first.digest").alias("of_digest"),
        (F.col("s") - F.col("first.s")).alias("apart"))
    diagonal = ["key", "digest", "of", "of_digest", "apart"]
    before = W.partitionBy(*diagonal).orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("new", F.when(F.coalesce(F.max("e").over(before), F.lit(-1)) < F.col("s"), 1).otherwise(0))
    rows = rows.withColumn("run", F.sum("new").over(W.partitionBy(*diagonal).orderBy("s", "e")
                                                    .rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*diagonal, "run").agg(F.min("s").alias("start"), F.max("e").alias("end")).drop("run")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Repeated runs: id, digest, start and end among the document's solid lines, first id and first start."""
    return (_runs(docs, id_col, text_col, min_words)
            .select(F.col("key").alias(id_col), "digest", F.col("start").alias("start_line"), F.col("end").alias("end_line"),
                    F.col("of").alias("first_id"), (F.col("start") - F.col("apart")).alias("first_line")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                as_col: str = "lines") -> DataFrame:
    """``docs`` with later copies of runs cut from the text; adds n_lines and n_removed as struct ``as_col``."""
    if as_col in docs.columns:
        raise ValueError(f"the table has a column {as_col} already; name another with as_col")
    cuts = materialise(_runs(docs, id_col, text_col, min_words).select("key", "digest", F.struct("start", "end").alias("cut"))
                       .distinct().groupBy("key", "digest").agg(F.collect_list("cut").alias("cuts")), "lines-cuts")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("of"))
    rows = rows.hint("merge").join(cuts.hint("merge"),  # one plan at every size
                                   F.col("id").eqNullSafe(F.col("key")) & (F.col("of") == F.col("digest")), "left")

    @F.arrow_udf("text string, n_lines long, n_removed long")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for raw, found in zip(texts.cast(pa.binary()).to_pylist(), runs.to_pylist(), strict=True):
            if raw is None:
                out.append((None, 0, 0))
                continue
            lines, solid = solid_lines(raw)
            gone = {i for run in found or () for i in solid[run["start"]:run["end"]]}
            out.append((b"\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else raw, len(lines), len(gone)))
        text, n, removed = zip(*out, strict=True) if out else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(text, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                                           pa.array(removed, pa.int64())], names=["text", "n_lines", "n_removed"])

    rows = rows.select("row", cut(F.col(f"row.{text_col}"), "cuts").alias("new"))
    columns = [F.col("new.text").alias(c) if c == text_col else F.col(f"row.{c}") for c in docs.columns]
    return rows.select(*columns, F.struct("new.n_lines", "new.n_removed").alias(as_col))


def op8_query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "lines.n_lines", "lines.n_removed",
                                    F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k FROM l),
n AS (
  SELECT doc_id, i, k, row_number() OVER d AS s, len(string_split_regex(k, '[ \t\r\x0B\f]+')) AS words,
         sum(len(string_split_regex(k, '[ \t\r\x0B\f]+'))) OVER d AS upto
  FROM b WHERE k <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
w AS (
  SELECT x.doc_id, x.s, y.s AS e, y.upto FROM n x ASOF JOIN n y ON x.doc_id = y.doc_id AND x.upto - x.words + 5 <= y.upto),
whole AS (
  SELECT w.doc_id, w.s, w.e, string_agg(n.k, chr(10) ORDER BY n.s) AS content
  FROM w JOIN n ON n.doc_id = w.doc_id AND n.s BETWEEN w.s AND w.e GROUP BY ALL),
behind AS (
  SELECT w.doc_id, w.s, list(n.k ORDER BY n.s) AS tail
  FROM w JOIN n ON n.doc_id = w.doc_id AND n.s > w.e AND n.upto - w.upto < 5 GROUP BY ALL),
p AS (
  SELECT whole.doc_id, whole.s, e, coalesce(tail, []) AS tail, row_number() OVER c AS r, first_value(coalesce(tail, [])) OVER c AS first_tail
  FROM whole LEFT JOIN behind ON behind.doc_id = whole.doc_id AND behind.s = whole.s
  WINDOW c AS (PARTITION BY content ORDER BY whole.doc_id, whole.s)),
cut AS (
  SELECT DISTINCT doc_id, unnest(range(s, e + 1 + coalesce(list_max(list_filter(range(1, len(tail) + 1),
    lambda j: tail[1:j] = first_tail[1:j])), 0))) AS s FROM p WHERE r > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS t, count(*) AS n
  FROM l LEFT JOIN n ON n.doc_id = l.doc_id AND n.i = l.i
         LEFT JOIN cut ON cut.doc_id = n.doc_id AND cut.s = n.s
  WHERE cut.s IS NULL GROUP BY l.doc_id),
total AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(total.n, 0) AS n_lines, coalesce(total.n, 0) - coalesce(kept.n, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.t, '')) END AS text_sha256
FROM documents d LEFT JOIN total ON total.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
