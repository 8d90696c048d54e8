"""Repeated passages by a sparse suffix array.

Texts are sequences of words (A-Z lower-cased, split at white space).  Of all
suffixes only those at content-selected positions are kept: every stretch of
``min_words`` words selects the place of the least hash among its first
``WINDOW`` word groups, so equal stretches select the same place wherever they
stand.  The retained suffixes are sorted by what follows (a hash of the next
``min_words - WINDOW + 1`` words, which lie in every stretch that selects the
place) and neighbours are compared:

* each suffix also carries a hash of its whole extent, all stretches that
  select it, to the left and to the right.  Equal extents of neighbours are one
  match, extended both ways at once; all but the first are later copies;
* where neighbours share the suffix but not the extent (the ends of a
  passage), one suffix for each extent goes back to its text and its
  stretches are compared one by one, each by a 128-bit hash.

Matches on one diagonal (same earlier document, same distance) merge into
maximal spans.  A word is in a span if and only if it lies in a stretch of
``min_words`` words that occurs earlier: smaller id first, then earlier words.

Large groups: rows are range-partitioned by suffix and place, so copies of a
passage spread over partitions, and pass through their tasks one by one.  What
the borders between partitions cut is put together from the first suffix of
each cut extent: two rows for each partition at most, which are broadcast.  No
group is collected and copies are not paired with each other.

Defined results: texts of fewer than ``min_words`` words (also null and empty
ones) have no spans; rows that repeat id and text count as one document; a null
id comes after all others; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import byte_slices, materialise, read_table, shuffle_partitions, texts_as_bytes

MIN_WORDS = 50
WINDOW = 28          # word groups among which a stretch selects its place
GROUP = 4            # words in a group
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _grow(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the bases and of their inverses modulo 2^64, at least ``n`` of each."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, 1 << 12)
        made = []
        for base in _BASES:
            both = []
            for factor in (base, pow(base, -1, 1 << 64)):
                x = np.full(size, factor, np.uint64)
                x[0] = 1
                both.append(np.multiply.accumulate(x))
            made.append(tuple(both))
        _powers[:] = made
    return _powers


class Words:
    """The words of a text as hashes, and hashes of any stretch of them."""

    def __init__(self, raw: bytes) -> None:
        words = raw.lower().split()
        self.n = len(words)
        self.hash = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, self.n)
        self._sums: dict[int, np.ndarray] = {}

    def stretch(self, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        """Hash number ``k`` (0 or 1) of the words from each start to its end."""
        power, inverse = _grow(self.n + 1)[k]
        if k not in self._sums:
            self._sums[k] = np.r_[np.uint64(0), np.cumsum(self.hash * power[:self.n], dtype=np.uint64)]
        sums = self._sums[k]
        x = (sums[end] - sums[start]) * inverse[start]
        x ^= x >> np.uint64(29)
        return x * np.uint64(0xBF58476D1CE4E5B9)

    def selected(self, min_words: int, window: int) -> np.ndarray:
        """For each stretch of ``min_words`` words the place it selects."""
        n = self.n - min_words + 1
        at = np.arange(n + window - 1)
        groups = self.stretch(at, at + GROUP, 0)
        return np.arange(n) + np.lib.stride_tricks.sliding_window_view(groups, window).argmin(axis=1)


def _retained(raw: bytes, min_words: int, window: int) -> tuple[np.ndarray, ...] | None:
    """(h, e1, e2, lo, len) of each retained suffix: its suffix hash, its extent's hashes, start and length."""
    words = Words(raw)
    if words.n < min_words:
        return None
    place = words.selected(min_words, window)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    at, end = place[first], last + min_words
    h = words.stretch(at, at + (min_words - window + 1), 0)
    shape = ((at - first) * 65_537 + (end - first)).astype(np.uint64)  # where in the extent the place is, and its length
    e1 = words.stretch(first, end, 0) + shape * np.uint64(_BASES[1])
    e2 = words.stretch(first, end, 1) ^ (shape * np.uint64(_BASES[0]))
    return h.view(np.int64), e1.view(np.int64), e2.view(np.int64), first, end - first


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("key"), F.xxhash64(F.col(text_col)).alias("digest"),
                       F.col(text_col).alias("text")).where("text is not null")


def _suffixes(docs: DataFrame, id_col: str, text_col: str, min_words: int, window: int) -> DataFrame:
    rows = _keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2):
                found = [_retained(t, min_words, window) for t in texts_as_bytes(batch.column(2))]
                at = [i for i, x in enumerate(found) if x is not None]
                if not at:
                    continue
                of = pa.array(np.repeat(at, [len(found[i][0]) for i in at]))
                h, e1, e2, lo, n = (np.concatenate([found[i][k] for i in at]) for k in range(5))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(e1), pa.array(e2), batch.column(0).take(of), batch.column(1).take(of),
                     pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))], names=_SUFFIX)

    return rows.mapInArrow(run, _schema("h long, e1 long, e2 long, key {k}, digest long, lo int, len int", rows))


_SUFFIX = ["h", "e1", "e2", "key", "digest", "lo", "len"]
#: kind 0: a later copy; 1: the first suffix of its extent, among several extents; 3: the first of its extent in
#: this partition, in a suffix group that the border may cut (``cut``: its extent, too).
_FOUND = ["kind", "cut", *_SUFFIX, "f_key", "f_digest", "f_lo"]


def _schema(ddl: str, rows: DataFrame) -> str:
    return ddl.replace("{k}", rows.schema["key"].dataType.simpleString())


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each sorted suffix with the first of its extent and with its suffix group.

    Only the first suffixes of a group's extents wait for its end; a large group of copies passes through.
    """
    firsts: pa.Table | None = None  # of the open suffix group; the last one is that of the open extent
    outer = True                    # whether the open group is the partition's first

    def out(rows: pa.Table, kind: int, sources: pa.Table | None = None, cut: np.ndarray | None = None):
        n = rows.num_rows
        names = ("key", "digest", "lo")
        source = [sources.column(c) if sources is not None else pa.nulls(n, rows.schema.field(c).type) for c in names]
        flags = pa.array(cut if cut is not None else np.zeros(n, bool))
        yield from pa.table([pa.array(np.full(n, kind, np.int32)), flags, *rows.columns, *source],
                            names=_FOUND).combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if firsts is not None:  # the open extent's first row leads, to be compared with
            table = pa.concat_tables([firsts.slice(firsts.num_rows - 1), table]).combine_chunks()
        h, e1, e2, digest, lo = (table.column(c).to_numpy() for c in ("h", "e1", "e2", "digest", "lo"))
        new = np.r_[True, (h[1:] != h[:-1]) | (e1[1:] != e1[:-1]) | (e2[1:] != e2[:-1])]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        # Rows that repeat id and text stand at the same place as the first.
        later = np.flatnonzero(~new & ~((digest == digest[first]) & (lo == lo[first]) & _equal(table.column("key"), first)))
        if len(later):
            yield from out(table.take(pa.array(later)), 0, table.take(pa.array(first[later])))
        begin = table.take(pa.array(np.flatnonzero(new)))
        firsts = begin if firsts is None else pa.concat_tables([firsts.slice(0, firsts.num_rows - 1), begin]).combine_chunks()
        group = firsts.column("h").to_numpy()
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if len(start) > 1:  # all groups but the last are complete
            at = 0
            if outer:
                at, outer = int(start[1]), False
                yield from out(firsts.slice(0, at), 3, cut=np.arange(at) == 0)
            size = np.repeat(np.diff(np.r_[start, len(group)]), np.diff(np.r_[start, len(group)]))
            several = np.flatnonzero((size > 1) & (np.arange(len(group)) >= at) & (np.arange(len(group)) < start[-1]))
            if len(several):
                yield from out(firsts.take(pa.array(several)), 1)
            firsts = firsts.slice(int(start[-1]))
    if firsts is not None:
        place = np.arange(firsts.num_rows)
        yield from out(firsts, 3, cut=(place == len(place) - 1) | ((place == 0) & outer))


def _equal(column: pa.ChunkedArray, first: np.ndarray) -> np.ndarray:
    other = column.take(pa.array(first))
    same = pc.fill_null(pc.equal(column, other), False)
    both = pc.and_(pc.is_null(column), pc.is_null(other))
    return pc.or_(same, both).to_numpy()


def _place(key: str, digest: str, lo: str) -> Column:
    return F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col(digest).alias("digest"),
                    F.col(lo).alias("lo"))


def _compared(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(later copies: at, len, first; one suffix for each extent among several: at, len)."""
    at = _place("key", "digest", "lo").alias("at")
    border = found.where("kind = 3").select("cut", "h", "e1", "e2", at, "len")
    # Extents that a border may cut: two rows for each partition at most.
    cut = border.where("cut")
    begin = (cut.groupBy(F.col("h").alias("h1"), F.col("e1").alias("x1"), F.col("e2").alias("x2"))
             .agg(F.min("at").alias("begin")))
    same = (F.col("h") == F.col("h1")) & (F.col("e1") == F.col("x1")) & (F.col("e2") == F.col("x2"))
    copies = (found.where("kind = 0").select("h", "e1", "e2", at, "len", _place("f_key", "f_digest", "f_lo").alias("near"))
              .join(F.broadcast(begin), same, "left").select("at", "len", F.coalesce("begin", "near").alias("first")))
    more = (cut.join(F.broadcast(begin), same).where(~F.col("at").eqNullSafe(F.col("begin")))
            .select("at", "len", F.col("begin").alias("first")))
    extents = materialise(border.groupBy("h", "e1", "e2", "len").agg(F.min("at").alias("at")), "suffix-border")
    several = extents.groupBy(F.col("h").alias("h1")).count().where("count > 1").select("h1")
    mixed = extents.join(several, F.col("h") == F.col("h1"), "left_semi").select("at", "len")
    return copies.unionAll(more), mixed.unionAll(found.where("kind = 1").select(at, "len"))


def _stretches(docs: DataFrame, mixed: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Later copies among the single stretches of the given suffixes: at, len, first."""
    wanted = (mixed.select("at.key", "at.digest", F.struct("at.lo", "len").alias("x"))
              .groupBy(F.col("key").alias("of"), F.col("digest").alias("of_digest")).agg(F.collect_set("x").alias("extents")))
    rows = _keyed(docs, id_col, text_col)
    rows = rows.join(wanted, F.col("key").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2):
                at, starts, hashes = [], [], []
                for i, (raw, extents) in enumerate(zip(texts_as_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True)):
                    words = Words(raw)
                    s = np.concatenate([np.arange(x["lo"], x["lo"] + x["len"] - min_words + 1) for x in extents])
                    at.append(np.full(len(s), i))
                    starts.append(s.astype(np.int32))
                    hashes.append([words.stretch(s, s + min_words, k).view(np.int64) for k in (0, 1)])
                of = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.concatenate([x[k] for x in hashes])) for k in (0, 1)), batch.column(0).take(of),
                     batch.column(1).take(of), pa.array(np.concatenate(starts))], names=["a", "b", "key", "digest", "lo"])

    rows = rows.select("key", "digest", "text", "extents")
    found = materialise(rows.mapInArrow(run, _schema("a long, b long, key {k}, digest long, lo int", rows)), "suffix-stretches")
    found = found.select("a", "b", _place("key", "digest", "lo").alias("at"))
    first = materialise(found.groupBy(F.col("a").alias("a1"), F.col("b").alias("b1"))
                        .agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "suffix-firsts")
    return (found.hint("merge").join(first.hint("merge"), (F.col("a") == F.col("a1")) & (F.col("b") == F.col("b1")))
            .where(~F.col("at").eqNullSafe(F.col("first"))).select("at", F.lit(min_words).alias("len"), "first"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   window: int = WINDOW, partitions: int | None = None) -> DataFrame:
    """Maximal later copies: id, digest, start_word, end_word, first_id, first_start_word."""
    if not 1 <= window <= min_words - GROUP + 1:
        raise ValueError("window must leave room for a word group in a stretch")
    spark = docs.sparkSession
    rows = materialise(_suffixes(docs, id_col, text_col, min_words, window), "suffix-rows")
    order = [F.col("h"), F.col("e1"), F.col("e2"), F.col("key").asc_nulls_last(), F.col("digest"), F.col("lo")]
    found = materialise(rows.repartitionByRange(partitions or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                        .mapInArrow(_neighbours, _schema("kind int, cut boolean, h long, e1 long, e2 long, key {k}, digest long, lo int, "
                                                         "len int, f_key {k}, f_digest long, f_lo int", rows)), "suffix-found")
    copies, mixed = _compared(found)
    copies = copies.unionAll(_stretches(docs, mixed, id_col, text_col, min_words))
    rows = copies.select("at.key", "at.digest", "at.lo", (F.col("at.lo") + F.col("len")).alias("hi"),
                         F.col("first.key").alias("f_key"), F.col("first.digest").alias("f_digest"),
                         (F.col("at.lo") - F.col("first.lo")).alias("apart")).distinct()
    diagonal = ["key", "digest", "f_key", "f_digest", "apart"]  # one document's own spans: bounded by its length
    before = W.partitionBy(*diagonal).orderBy("lo", "hi")
    rows = rows.withColumn("reach", F.max("hi").over(before.rowsBetween(W.unboundedPreceding, -1)))
    rows = rows.withColumn("span", F.sum((F.coalesce(F.col("lo") > F.col("reach"), F.lit(True))).cast("int"))
                           .over(before.rowsBetween(W.unboundedPreceding, 0)))
    return (rows.groupBy(*diagonal, "span").agg(F.min("lo").alias("start_word"), F.max("hi").alias("end_word"))
            .select(F.col("key").alias(id_col), "digest", "start_word", "end_word", F.col("f_key").alias("first_id"),
                    (F.col("start_word") - F.col("apart")).alias("first_start_word")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   window: int = WINDOW) -> DataFrame:
    """``docs`` with the words of later copies cut from the text (with the white space after them)."""
    spans = materialise(repeated_spans(docs, id_col, text_col, min_words, window)
                        .groupBy(F.col(id_col).alias("key"), "digest")
                        .agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans")), "suffix-spans")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("of"))
    rows = rows.join(spans, F.col("id").eqNullSafe(F.col("key")) & (F.col("of") == F.col("digest")), "left")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for raw, found in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist(), strict=True):
            if raw and found:
                starts = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
                kept, at = [], 0
                for x in sorted(found, key=lambda x: (x["start_word"], x["end_word"])):
                    if starts[x["start_word"]] > at:
                        kept.append(raw[at:starts[x["start_word"]]])
                    at = max(at, starts[x["end_word"]])
                raw = b"".join([*kept, raw[at:]])
            out.append(raw)
        return pa.array(out, pa.binary()).cast(pa.string())

    return rows.select(*[(cut(F.col(f"row.{c}"), "spans").alias(c) if c == text_col else F.col(f"row.{c}")) for c in docs.columns])


def op1_query(spark, sf_dir: str) -> DataFrame:
    return repeated_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start_word", "end_word", F.col("first_id").alias("first_doc_id"), "first_start_word")
