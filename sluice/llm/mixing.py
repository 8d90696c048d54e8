"""Mixing sources to target weights, with DataFrame functions only.

A source's words are summed, its target is its share of a common budget, and
``rate = target / words``.  Each document is emitted ``floor(rate)`` times,
and once more with probability ``rate - floor(rate)``, drawn from a hash of
the seed and the document's id: reruns take the same documents, whatever the
partitioning.

Budget: ``share`` times all words, dealt by weight.  A target stops at
``limit`` times the words of its source; what is over is dealt again by
weight among the others until none is above.  The weights repeat over the
sources in code-point order, the null source last.

Defined results: a null or empty text has size 0; a source without words has
target 0 and none of its documents is taken; rows with the same id share one
draw, and so do all rows with a null id of one source; an empty table gives an
empty result; any other column (also one named as an output) is left alone.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, with_row_index

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
#: Up to this many bytes of source names and figures, measured, are broadcast.
BROADCAST_BYTES = 8 << 20
SALTS = 16


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, limit: int = 2,
                   weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """(source, size) rows -> source, source_size, weight, target, rate.

    The level (budget left / weights left) only rises from round to round, so
    a capped source stays capped and one small aggregation over the table of
    sources, which stays distributed, does for each round.
    """
    share = Fraction(share).limit_denominator(10_000)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    per = materialise(with_row_index(per, F.col("source").asc_nulls_last(), index="place")
                      .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights)).cast("int") + 1))
                      .drop("place"), "mix-sources")
    num, den = share.numerator, share.denominator
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level_num, level_den, capped = num * total, 0, -1
    over: Column = F.lit(False)
    while True:
        got = per.agg(F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("c"),
                      F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("w"),
                      F.sum(over.cast("long")).alias("n")).first()
        if not got["w"] or got["n"] == capped:
            break
        # budget left = (num * total - den * limit * words capped) / den
        capped, level_num, level_den = got["n"], num * total - den * limit * got["c"], den * got["w"]
        fair = F.lit(float(level_num)) * F.col("weight") / F.lit(float(level_den))
        over = fair > (F.col("source_size") * limit).cast("double")
    if not level_den:  # no source at all, or nothing but capped ones
        fair = F.lit(0.0)
    target = F.when(over, (F.col("source_size") * limit).cast("double")).otherwise(fair)
    return (per.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0))))


def draw(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from the hash of the seed and the given values."""
    text = F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _copies(key: Column, rate: Column, seed: str) -> Column:
    whole = F.floor(rate)
    return whole + (draw(seed, key) < rate - whole).cast("long")


def _join_sources(rows: DataFrame, per: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Add a source's figures (as ``__s``) to its rows; ``rows`` has ``__source``.

    The sources are broadcast only if their measured size is small; else the
    join is salted, since one source may hold a third of all rows.
    """
    per = per.select(F.col("source").alias("__name"), F.struct("source_size", "target", "rate").alias("__s"))
    size = per.agg(F.sum(F.coalesce(F.octet_length("__name"), F.lit(0)) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        return rows.join(F.broadcast(per), F.col("__source").eqNullSafe(F.col("__name"))).drop("__name")
    salted = per.withColumn("__salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__key"), F.lit(SALTS)).cast("int"))
    return (rows.join(salted, F.col("__source").eqNullSafe(F.col("__name")) & (F.col("__salt") == F.col("__salt_of")))
            .drop("__name", "__salt", "__salt_of"))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One light row for each document, written once: the texts are read a single time."""
    return materialise(docs.select(F.col(id_col).alias("key"), F.col(source_col).alias("source"),
                                   word_count(F.col(text_col)).alias("size")), "mix-sizes")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             share: float = 1.5, limit: int = 2, weights: tuple[int, ...] = (3, 1, 2), seed: str = SEED,
             broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: id, size, source_size, target, rate, copies, taken."""
    sizes = _sizes(docs, id_col, text_col, source_col)
    per = materialise(source_targets(sizes, share, limit, weights), "mix-targets")
    rows = _join_sources(sizes.select(F.col("key").alias("__key"), F.col("source").alias("__source"), "size"),
                         per, broadcast_bytes)
    copies = _copies(F.col("__key"), F.col("__s.rate"), seed)
    return (rows.withColumn("copies", copies)
            .select(F.col("__key").alias(id_col), F.col("__source").alias(source_col), "size",
                    "__s.source_size", "__s.target", "__s.rate", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, limit: int = 2, weights: tuple[int, ...] = (3, 1, 2), seed: str = SEED,
        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The mix itself: the documents' rows, each as often as it is taken.

    Texts are not shuffled when the sources can be broadcast.
    """
    per = materialise(source_targets(_sizes(docs, id_col, text_col, source_col), share, limit, weights), "mix-targets")
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__key"), F.col(source_col).alias("__source"))
    rows = _join_sources(rows, per, broadcast_bytes)
    copies = _copies(F.col("__key"), F.col("__s.rate"), seed)
    return (rows.withColumn("__n", copies).where("__n > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select("__row.*"))


def op9_query(spark, sf_dir: str) -> DataFrame:
    from sluice.llm.common import read_table
    return mix_plan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


#: Of a view ``mix_docs`` (doc_id, text, source): what :func:`mix_plan` returns.
PLAN_SQL = r"""
sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM mix_docs),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM per),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS k FROM placed),
level AS (
  SELECT *, (SELECT sum(source_size) FROM per) AS total,
         coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM ranked),
marked AS (
  SELECT *, (3 * total - 4 * done)::DOUBLE * weight / (2 * left_w)::DOUBLE > (2 * source_size)::DOUBLE AS over_limit
  FROM level),
rest AS (
  SELECT coalesce(sum(source_size) FILTER (over_limit), 0) AS c, sum(weight) FILTER (NOT over_limit) AS w FROM marked),
targets AS (
  SELECT source, source_size,
         CASE WHEN over_limit THEN (2 * source_size)::DOUBLE
              ELSE (3 * total - 4 * c)::DOUBLE * weight / (2 * w)::DOUBLE END AS target
  FROM marked, rest),
plan AS (
  SELECT doc_id, s.source, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5(concat_ws(':', 'mix-1', doc_id::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT doc_id, source, size, source_size, target, rate,
         CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM plan)
"""

ORACLE_SQL = f"""
WITH mix_docs AS (SELECT doc_id, text, source FROM documents), {PLAN_SQL}
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken FROM mixed
"""
