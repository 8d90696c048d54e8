"""Phrase collocations by dynamic itemset counting.

The texts are dealt into ``SHARDS`` shards, written once, which are scanned in a
cycle.  Words are counted from the start.  After each shard, a phrase of up to
``most - 1`` words whose running count has reached the threshold opens the next
length: a longer phrase is active from the first shard at which both its
subphrases (without its last, without its first word) have reached it, is
counted through one full cycle from there, and then is complete.  So lengths
interleave, and only phrases that can still reach the threshold are counted.
The scan ends when a whole cycle has activated nothing new, or with that last cycle.

What has reached the threshold goes to the scans as one filter of bits for each
length (two bits for a phrase; at most ``MAX_BITS`` bits, less for small
corpora): bounded, however many phrases there are.  A filter may hold phrases
that did not reach the threshold, so some are counted in vain, but none that
did is ever missing, and bits are never cleared: activity is monotone.  Hence
no activation times are needed: a shard counts the phrases that are active now
and were not when it was scanned one cycle ago - each phrase exactly once in
each shard.  Two cycles in, words and pairs are complete; what is left are late
activations of longer phrases.  The last cycle takes them all at once: there a
phrase is active, too, if its subphrases are still being counted.

In the cycles a phrase is a 64-bit hash of its language and words, so that the
many that fall short stay small; equal hashes can only raise a count.  One
more scan of all shards counts, exactly and by the words themselves, what the
filters hold: a phrase that reaches the threshold is always among it.  Running
counts are one table; of completed phrases it keeps those that reached the
threshold.  A task sums its own counts before they are shuffled.

Defined results: null texts count as empty, null languages as ``und`` (together
with rows that say so); repeated rows count each; a language without words or
without a phrase that often gives no rows; ties go by count, then phrase in
byte order; other columns are not read; an empty table gives an empty result.
A text is scanned in parts with the last words carried over, so very long ones
take no more memory.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_slices, materialise, read_table, small_batches, texts_as_bytes
from sluice.operators.filters import cap_records_per_key

SHARDS = 2
MIN_BITS, MAX_BITS = 1 << 16, 1 << 26
_PART = 1 << 20
_WORDS_KEPT = 200_000       # words that a task's dictionary holds before it starts anew
_BATCH_BYTES = 4 << 20      # texts that a task takes in at a time
_COUNTS_KEPT = 500_000    # places that a task gathers before it hands their counts on
_BREAK = b"."               # any separator of pieces stands as this byte, which no word can hold
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else _BREAK[0] if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c
               for c in range(256))
_HASHED = "k int, hash long, n long"
_EXACT = "lang string, k int, phrase string, n long"


class _Words(dict):
    """word -> number, in the order of appearance; 0 is the break."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if len(self) > len(self.hashes):
            new = list(self)[len(self.hashes):]
            self.hashes = np.concatenate([self.hashes, word_hashes(new)])
        return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _begin(lang: str, first: np.ndarray) -> np.ndarray:
    """Hash of one-word phrases of a language."""
    return _mix(first ^ np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8"), seed=1)))


def _longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word."""
    return _mix(phrase * np.uint64(0x9E3779B97F4A7C15) + word)


def _holds(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes a filter holds: two bits of one 64-bit word of the table."""
    word = table[((hashed >> np.uint64(12)) & np.uint64(len(table) - 1)).astype(np.int64)]
    low = np.uint64(63)
    return ((word >> (hashed & low)) & (word >> ((hashed >> np.uint64(6)) & low)) & np.uint64(1)).astype(bool)


def _walk(lang: str, ids: np.ndarray, hashes: np.ndarray, now: list[np.ndarray], then: list[np.ndarray] | None = None,
          done: list[np.ndarray] | None = None):
    """For k = 1, 2, ...: places and hashes of the phrases of k words whose subphrases the filters hold, and which of
    these were active by the filters ``then`` (all words; of longer phrases none without ``then``).

    With ``done``, the filters of one cycle ago, subphrases that were not active by them will do, too: their counts are
    not complete.
    """
    at, word = np.flatnonzero(ids), hashes[ids]
    value = np.zeros(len(ids), np.uint64)
    value[at] = _begin(lang, word[at])
    marks = [np.ones(len(at), bool) for tables in (then, done) if tables is not None]
    yield 1, at, value[at], np.ones(len(at), bool)
    for k, table in enumerate(now, 2):
        held, good = np.zeros(len(ids) + 1, bool), _holds(table, value[at])
        held[at[good | ~marks[-1] if done is not None else good]] = True
        old = []
        for tables, mark in zip([t for t in (then, done) if t is not None], marks, strict=True):
            old.append(np.zeros(len(ids) + 1, bool))
            old[-1][at[mark][_holds(tables[k - 2], value[at[mark]])]] = True
        at = np.flatnonzero(held[:-1] & held[1:])
        marks = [o[at] & o[at + 1] for o in old]
        value[at] = _longer(value[at], word[at + k - 1])
        yield k, at, value[at], marks[0] if marks else np.zeros(len(at), bool)


def _distinct(ids: np.ndarray, at: np.ndarray, k: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct phrase of k words, how often it stands at the given places); exact."""
    key, span = ids[at], words
    for j in range(1, k):
        if span * words >= 1 << 62:
            key, different = pd.factorize(key)
            span = len(different)
        key, span = key * words + ids[at + j], span * words
    code, different = pd.factorize(key)
    place = np.empty(len(different), np.int64)
    place[code[::-1]] = at[::-1]
    return place, np.bincount(code, minlength=len(different))


def _parts(stream: bytes):
    """The translated stream in parts of about 1 MB, cut between words."""
    at = 0
    while at < len(stream):
        ends = [x for x in (stream.find(b" ", at + _PART), stream.find(_BREAK, at + _PART)) if x >= 0]
        to = min(ends, default=len(stream))
        yield stream[at:to]
        at = to


def _streams(batches, most: int):
    """Of (lang, text) batches: (dictionary, lang, tokens, how many of them were in the part before)."""
    words = _Words()
    for batch in batches:
        for piece in byte_slices(batch, 1, 4 << 20):
            langs, texts = np.array(piece.column(0).to_pylist(), object), texts_as_bytes(piece.column(1))
            for lang in sorted(set(langs)):
                stream = _BREAK.join(texts[i].translate(_TABLE) for i in np.flatnonzero(langs == lang))
                carried: list[bytes] = []
                for part in _parts(stream):
                    tokens = carried + part.replace(_BREAK, b" . ").split()
                    yield words, lang, tokens, len(carried)
                    carried = tokens[-(most - 1):]
                    if len(words) > _WORDS_KEPT:
                        words = _Words()


def scanner(now: list[np.ndarray], then: list[np.ndarray] | None, words_too: bool,
            done: list[np.ndarray] | None = None):
    """(lang, text) batches -> (k, hash, n): counts of the phrases that are active now and were not then."""
    most = len(now) + 1

    def summed(held: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        out = []
        for k, values in held.items():
            code, hashed = pd.factorize(np.concatenate(values))
            out.append((np.full(len(hashed), k, np.int32), hashed.view(np.int64), np.bincount(code, minlength=len(hashed))))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.record_batch([pa.array(c) for c in cols], names=["k", "hash", "n"])

    def scan(batches):
        held, size = {}, 0
        for words, lang, tokens, known in _streams(batches, most):
            ids = words.numbers(tokens)
            for k, at, value, was in _walk(lang, ids, words.hashes, now, then, done):
                fresh = at + k > known          # what ends among the known tokens was counted with the part before
                if k > 1 or not words_too:
                    fresh &= ~was
                if fresh.any():
                    held.setdefault(k, []).append(value[fresh])
                    size += len(held[k][-1])
            if size > _COUNTS_KEPT:
                yield summed(held)
                held, size = {}, 0
        if held:
            yield summed(held)
    return scan


def recounter(filters: list[np.ndarray]):
    """(lang, text) batches -> (lang, k, phrase, n): exact counts of the phrases that the filters hold; k = 0 counts all words."""
    def batch(lang: str, k: int, phrases: list[bytes], n) -> pa.RecordBatch:
        return pa.record_batch([pa.array([lang] * len(phrases), pa.string()), pa.array([k] * len(phrases), pa.int32()),
                                pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                               names=["lang", "k", "phrase", "n"])

    def count(batches):
        for words, lang, tokens, known in _streams(batches, len(filters)):
            ids = words.numbers(tokens)
            yield batch(lang, 0, [b""], [int(np.count_nonzero(ids[known:]))])
            names = list(words)
            for (k, at, value, _), table in zip(_walk(lang, ids, words.hashes, filters[:-1]), filters, strict=True):
                at = at[(at + k > known) & _holds(table, value)]
                if len(at):
                    place, n = _distinct(ids, at, k, len(words))
                    rows = ids[place[:, None] + np.arange(k)].tolist()
                    yield batch(lang, k, [b" ".join([names[w] for w in row]) for row in rows], n)
    return count


def _filled(reached: DataFrame, filters: list[np.ndarray]) -> list[np.ndarray]:
    """The filters with the bits of these phrases (k, hash) set.  A filter's 64-bit words at most reach the driver."""
    words = (reached.select("k", F.shiftrightunsigned("hash", 12).bitwiseAND(len(filters[0]) - 1).alias("word"),
                            F.expr("shiftleft(1L, cast(hash & 63 as int)) | shiftleft(1L, cast((hash >> 6) & 63 as int))").alias("mask"))
             .groupBy("k", "word").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    if not words.num_rows:
        return filters
    filters = [x.copy() for x in filters]
    ks, at, masks = (words.column(c).to_numpy() for c in ("k", "word", "mask"))
    for k, table in enumerate(filters, 1):
        table[at[ks == k]] |= masks[ks == k].astype(np.uint64)
    return filters


def frequent_phrases(docs: DataFrame, threshold: int, most: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to ``most`` words that stand ``threshold`` times or more; k = 0 counts all words."""
    with small_batches(docs.sparkSession, _BATCH_BYTES):
        return _frequent(docs, threshold, most, text_col, lang_col)


def _frequent(docs: DataFrame, threshold: int, most: int, text_col: str, lang_col: str) -> DataFrame:
    spark = docs.sparkSession
    shards = materialise(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                         .withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(SHARDS)).cast("int")),
                         "phrases-shards", partition_by="shard")
    size = shards.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # At most (words / threshold) phrases of a length can reach it; about eight bits for each.
    bits = min(max(MIN_BITS, 1 << int(8 * size / 6 / threshold + 1).bit_length()), MAX_BITS)
    filters = [np.zeros(bits // 64, np.uint64) for _ in range(most)]
    versions, ages = [filters], [0]          # the filters ahead of each step, and when they last changed
    totals = spark.createDataFrame([], _HASHED + ", first int, fresh boolean")
    step = 0
    closing = 2 * SHARDS                   # the step that begins the last cycle
    while step < SHARDS or step < closing + SHARDS and (step > closing or ages[step] != ages[step - SHARDS]):
        then = versions[step - SHARDS][:-1] if step >= SHARDS else None
        # The last cycle reads all shards by the same filters.
        now, done = versions[min(step, closing)][:-1], versions[closing - SHARDS][:-1] if step >= closing else None
        counts = (shards.where(F.col("shard") == step % SHARDS).select("lang", "text")
                  .mapInArrow(scanner(now, then, step < SHARDS, done), _HASHED))
        old = totals.select("k", "hash", "n", "first", F.col("n").alias("before"))
        new = counts.select("k", "hash", "n", F.lit(step).alias("first"), F.lit(0).cast("long").alias("before"))
        summed = (old.unionAll(new).groupBy("k", "hash")
                  .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("before").alias("before")))
        reached = F.col("n") >= threshold
        # First met at step s, active since then or before: complete ahead of step s + SHARDS.
        running = F.col("first") + SHARDS > step + 1
        totals = materialise(summed.where((reached & (F.col("k") < most)) | running | (reached & (F.col("before") < threshold)))
                             .select("k", "hash", "n", "first", (reached & (F.col("before") < threshold)).alias("fresh")),
                             "phrases-counts")
        filters = _filled(totals.where("fresh").select("k", "hash"), versions[step])
        # The longest phrases open no further length: they change nothing about the scans to come.
        changed = any((a != b).any() for a, b in zip(filters[:-1], versions[step][:-1], strict=True))
        step += 1
        versions.append(filters)
        ages.append(step if changed else ages[-1])
        if SHARDS < step <= closing - 1:
            versions[step - SHARDS - 1] = []      # no longer asked for
    exact = (shards.select("lang", "text").mapInArrow(recounter(filters), _EXACT)
             .groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")))
    return materialise(exact.where((F.col("n") >= threshold) | (F.col("k") == 0)), "phrases-exact")


def collocations(docs: DataFrame, threshold: int = 100, most: int = 5, top: int = 2000, text_col: str = "text",
                 lang_col: str = "lang", factor: int = 1000, covered: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    The score of a cut is floor(factor * a * n / (l * r)); the lowest one counts.  A phrase goes if a longer
    candidate holds it that has at least ``covered`` percent of its count.
    """
    found = frequent_phrases(docs, threshold, most, text_col, lang_col)
    phrases, totals = found.where(F.col("k") > 0), found.where(F.col("k") == 0).select("lang", F.col("n").alias("all"))
    cand = phrases.where(F.col("k") > 1).select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = (cand.select("lang", "k", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"),
                    part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right")))
    of = lambda side, count: phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(count))
    # 38 digits: products of counts below 10^15 (a), 10^17 (n), 10^18 (l, r) are exact, larger ones an error.
    score = F.expr(f"(cast({factor} as decimal(4,0)) * cast(a as decimal(15,0))) * cast(all as decimal(17,0)) "
                   "div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))")
    scored = (cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(totals, "lang")
              .groupBy("lang", "phrase", "a", F.col("all").alias("n"))
              .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
              .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))
    inside = (cand.where(F.col("k") > 2).select("lang", "k", "a", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
              .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("s"))
              .select("lang", part(F.col("s"), F.col("m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))).drop("longer"))
    ranked = cap_records_per_key(kept, "lang", [F.desc("score"), F.desc("a"), F.col("phrase")], top, rank_column="rank")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_query(spark, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM spots, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS m FROM c),
s AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, n, m,
         CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:m], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[m + 1:], ' ')
  JOIN n ON n.lang = cut.lang
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, m) = 1),
lens AS (SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM c),
sub AS (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM lens),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM sub GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
       s.phrase, a, l, r, n, score
FROM s LEFT JOIN inside ON inside.lang = s.lang AND inside.phrase = s.phrase
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""
