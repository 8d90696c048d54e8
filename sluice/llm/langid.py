"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  For each bit one linear classifier over
hashed byte n-grams tells the languages with a 1 from those with a 0.  A text
gets the language whose codeword fits the classifiers' margins with the least
loss; each bit counts for a language by how often it was right on that
language's sample rows when those rows were left out (loss-weighted decoding).  A
text whose two best languages are nearly level is flagged as ambiguous.

Learning reads the sample only: ``MAX_ROWS`` rows in the mean, spread evenly
over all languages and drawn by a hash, but ``EACH`` in the mean and one at least
of every language, so with more than ``MAX_ROWS / EACH`` languages it grows with
their number.  Their n-gram counts are made on the executors; the ridge
regressions of all bits share one kernel matrix of that size on the driver.
Prediction is one pass over all whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without any learnable row every text is; with one language every other text
has it, with score 1; rows with a null id or language are predicted like all
others but not learned from; other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import itertools
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import read_table
from sluice.llm.mixing import draw

MAX_ROWS = 1200
EACH = 6
BUCKETS = 1 << 12          # for each of bigrams and trigrams
RIDGE = 0.05
AMBIGUOUS = 0.03           # gap between the two least losses, as a share of the second
UNKNOWN = "und"
_PART = 1 << 20
_ASCII_LETTER = re.compile(rb"[a-z]")
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def has_letter(raw: bytes | None) -> bool:
    return bool(raw) and (bool(_ASCII_LETTER.search(raw.translate(_FOLD)))
                          or any(c.isalpha() for c in raw.decode("utf-8", "replace")))


def features(raw: bytes) -> np.ndarray | None:
    """Unit vector of the square roots of n-gram counts; None for a text without a letter."""
    if not raw:
        return None
    words = raw.translate(_FOLD).split()
    if not words:
        return None
    folded = b" " + b" ".join(words) + b" "
    if not _ASCII_LETTER.search(folded) and not any(c.isalpha() for c in raw.decode("utf-8", "replace")):
        return None
    text = np.frombuffer(folded, np.uint8)
    counts = np.zeros(2 * BUCKETS, np.int64)
    for at in range(0, len(text), _PART):
        a = text[at:at + _PART + 2].astype(np.uint32)
        two = (a[:-1] << np.uint32(8)) | a[1:]
        three = (two[:-1] << np.uint32(8)) | a[2:]
        for k, grams in enumerate((two[:_PART], three[:_PART])):
            hashed = (grams * np.uint32(2654435761)) >> np.uint32(20)
            counts[k * BUCKETS:(k + 1) * BUCKETS] += np.bincount(hashed, minlength=BUCKETS)
    x = np.sqrt(counts.astype(np.float32))
    return x / np.sqrt(np.dot(x, x))


def codewords(n: int) -> np.ndarray:
    """(n, bits) of +1/-1: all splits for few languages, else the widest of some drawn codes."""
    if n < 2:
        return np.zeros((n, 0), np.float32)
    if n <= 5:
        code = np.array([[1, *bits] for bits in itertools.product((1, 0), repeat=n - 1)][1:], np.float32).T
        return 2 * code - 1
    bits, rnd, best = int(np.ceil(10 * np.log2(n))), random.Random(17), (-1.0, None)
    for _ in range(30):
        code = np.array([[rnd.choice((-1, 1)) for _ in range(bits)] for _ in range(n)], np.float32)
        apart = (bits - code @ code.T) / 2 + np.eye(n, dtype=np.float32) * bits
        best = max(best, (float(apart.min()), code), key=lambda x: x[0])
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray      # languages x bits
    weight: np.ndarray    # languages x bits, rows sum to 1
    linear: np.ndarray    # features x bits

    def predict(self, raw: bytes) -> tuple[str, float, float, bool]:
        """(language, score, gap, ambiguous)."""
        x = features(raw) if self.languages else None
        if x is None:
            return UNKNOWN, 0.0, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, 1.0, False
        loss = (self.weight * np.logaddexp(0, -4 * self.code * (x @ self.linear))).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        first, second = loss[order[0]], loss[order[1]]
        gap = float((second - first) / second) if second > 0 else 0.0
        likely = np.exp(4 * (first - loss))
        return self.languages[order[0]], float(1 / likely.sum()), gap, gap < AMBIGUOUS


def fit(labels: list[str], x: np.ndarray) -> Model:
    """Ridge regression for every bit, its weights from leave-one-out margins."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    of = np.array([languages.index(v) for v in labels])
    if len(languages) < 2:
        return Model(languages, code, code, np.zeros((x.shape[1], 0), np.float32))
    y = code[of]
    inverse = np.linalg.inv((x @ x.T).astype(np.float64) + RIDGE * np.eye(len(of)))
    dual = inverse @ y
    left_out = y - dual / np.diag(inverse)[:, None]
    hit = left_out * y > 0
    right = np.stack([hit[of == k].mean(axis=0) for k in range(len(languages))])
    weight = np.maximum(right, 1e-3)
    return Model(languages, code, weight / weight.sum(axis=1, keepdims=True), (x.T @ dual).astype(np.float32))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit the model to a bounded sample of the labelled rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & ~held_out(F.col("id"))).where(F.col("text").rlike(r"\p{L}"))
    drawn = draw("langid", F.col("id"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(drawn).alias("least")).collect()
    if not counts:
        return fit([], np.zeros((0, 2 * BUCKETS), np.float32))
    each = max(MAX_ROWS / len(counts), EACH)
    share = F.create_map(*itertools.chain(*((F.lit(r["lang"]), F.lit(max(each / r["n"], r["least"]))) for r in counts)))

    @F.arrow_udf("binary")
    def sparse(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.cast(pa.binary()).to_pylist():
            x = features(t)
            at = np.flatnonzero(x) if x is not None else None
            out.append(None if at is None else at.astype("<u4").tobytes() + x[at].astype("<f4").tobytes())
        return pa.array(out, pa.binary())

    sample = (rows.where(drawn <= F.element_at(share, F.col("lang")))
              .select("lang", sparse("text").alias("x"), F.xxhash64("id", "text").alias("h"))
              .where("x is not null").toArrow().sort_by([("h", "ascending"), ("lang", "ascending")]))
    x = np.zeros((sample.num_rows, 2 * BUCKETS), np.float32)
    for i, raw in enumerate(sample.column("x").to_pylist()):
        n = len(raw) // 8
        x[i, np.frombuffer(raw, "<u4", n)] = np.frombuffer(raw, "<f4", n, 4 * n)
    return fit(sample.column("lang").to_pylist(), x)


def predictor(model: Model):
    """A column function: text -> struct(lang, score, gap, ambiguous)."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("gap", pa.float64()), ("ambiguous", pa.bool_())])

    @F.arrow_udf("lang string, score double, gap double, ambiguous boolean")
    def predict(texts: pa.Array) -> pa.Array:
        found = [model.predict(t) for t in texts.cast(pa.binary()).to_pylist()]
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
    return predict


def identify(docs: DataFrame, model: Model, text_col: str = "text", as_col: str = "language") -> DataFrame:
    """``docs`` with a new column ``as_col``: struct(lang, score, gap, ambiguous)."""
    if as_col in docs.columns:
        raise ValueError(f"the table has a column {as_col} already; name another with as_col")
    return docs.withColumn(as_col, predictor(model)(F.col(text_col)))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", drop_ambiguous: bool = False) -> DataFrame:
    """The rows of ``docs`` that have a language: those without a letter go, and on demand ambiguous ones.

    Ambiguous texts are mostly clean ones of a few words, so they stay by default.  Where no language could be
    learned, all texts with a letter stay: their language is unknown, not missing.
    """
    if not model.languages:
        @F.arrow_udf("boolean")
        def lettered(texts: pa.Array) -> pa.Array:
            return pa.array([has_letter(t) for t in texts.cast(pa.binary()).to_pylist()], pa.bool_())
        return docs.where(lettered(F.col(text_col)))
    rows = docs.select(F.struct("*").alias("__row"), predictor(model)(F.col(text_col)).alias("__found"))
    keep = F.col("__found.lang") != UNKNOWN
    return rows.where(keep & ~F.col("__found.ambiguous") if drop_ambiguous else keep).select("__row.*")


def op7_query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        predictor(learn(docs))(F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score",
                        "found.ambiguous")
