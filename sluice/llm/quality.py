"""Quality classifier: a factorisation machine.

A text becomes a sparse vector: hashed words (square roots of their counts, as
a unit vector), structure statistics (lengths, shares of capitals, digits,
signs, repeated words and lines) and numeric metadata columns.  The machine
scores it by a bias, a weight for each feature and the inner products of the
features' low-rank factors over all pairs of features.  The sum over pairs is
taken in time linear in the features, as half of
``|sum x_i v_i|^2 - sum x_i^2 |v_i|^2`` (the sum-of-squares identity).

Learning reads a bounded sample: ``MAX_ROWS`` labelled rows in the mean, half
of each label, drawn by a hash of the id; rows are weighted back to the labels'
true shares, so scores are probabilities on the whole table.  The sample's
vectors are made on the executors; the driver fits factors of fixed size
(``BUCKETS`` x ``RANK``).  Scoring is one pass over all whole texts.

Defined results: a null text counts as empty, and an empty text is scored like
any other; null metadata counts as the mean; of an id's labels the more
frequent one counts (a tie: 1), null ids and labels are not learned from; of
rows that repeat a labelled id one is learned from; with one label, or none,
every score is the smoothed share of label 1 (0.5 without any); other columns
are not read, or pass through ``scored``, whose result column must not be there
yet; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import read_table
from sluice.llm.langid import held_out
from sluice.llm.mixing import draw

MAX_ROWS = 3000
BUCKETS = 1 << 12
RANK = 8
EPOCHS, BATCH, STEP, DECAY = 40, 128, 0.02, 1e-3
_PART = 1 << 20
_BLANKS = b" \t\n\r\x0b\f"

_KIND = np.zeros(256, np.int64)          # 0: other signs
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3),
                      (_BLANKS, 4), (b".,;:'\"()-", 5), (b"!?", 6), (bytes(range(128, 256)), 7)):
    _KIND[list(_chars)] = _kind
STATS = ("words", "bytes", "word_length", "distinct", "capitals", "digits", "signs", "points", "calls", "lines", "top_word",
         "repeated_lines", "beyond_ascii", "blanks")


def _parts(raw: bytes):
    """The text in parts of about 1 MB, cut at blanks."""
    at = 0
    while at < len(raw):
        to = at + _PART
        while to < len(raw) and raw[to] not in _BLANKS:
            to += 1
        yield raw[at:to]
        at = to


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of the words, their values, structure statistics) of one text."""
    words, kinds, lines = Counter(), np.zeros(8), Counter()
    for part in _parts(raw):
        words.update(part.lower().split())
        kinds += np.bincount(_KIND, np.bincount(np.frombuffer(part, np.uint8), minlength=256), 8)
        lines.update(zlib.crc32(line) for line in part.split(b"\n") if line)
    hashed = np.zeros(BUCKETS)
    if words:
        at = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % BUCKETS
        hashed = np.bincount(at, np.fromiter(words.values(), np.float64, len(words)), BUCKETS)
    at = np.flatnonzero(hashed)
    x = np.sqrt(hashed[at])
    n, total, letters = len(raw), sum(words.values()), kinds[1] + kinds[2]
    share = lambda a, b: float(a) / b if b else 0.0
    stats = np.array([
        np.log1p(total), np.log1p(n), np.log1p(share(n - kinds[4], total)), share(len(words), total),
        share(kinds[2], letters), np.sqrt(share(kinds[3], n)), np.sqrt(share(kinds[0], n)), np.sqrt(share(kinds[5], n)),
        np.sqrt(share(kinds[6], n)), np.sqrt(share(lines.total(), total)), np.sqrt(share(max(words.values(), default=0), total)),
        share(lines.total() - len(lines), lines.total()), np.sqrt(share(kinds[7], n)), share(kinds[4], n)])
    return at, x / (np.sqrt((x * x).sum()) or 1.0), stats


@dataclass
class Model:
    share: float                        # of label 1, smoothed
    bias: float = 0.0
    mean: np.ndarray | None = None      # of the dense features: statistics, then metadata
    spread: np.ndarray | None = None
    weight: np.ndarray | None = None    # one for each feature: buckets, then dense ones
    factors: np.ndarray | None = None   # features x RANK
    metadata: tuple[str, ...] = field(default=())

    def dense(self, stats: np.ndarray) -> np.ndarray:
        """Statistics and metadata as multiples of their spread; unknown ones are at the mean."""
        z = (stats - self.mean) / self.spread
        return np.clip(np.where(np.isfinite(z), z, 0.0), -4, 4) / np.sqrt(len(self.mean))

    def score(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The probability of label 1 for rows of ``features`` (statistics with metadata behind them)."""
        if self.factors is None:
            return np.full(len(rows), self.share)
        out = np.empty(len(rows))
        tail = BUCKETS + np.arange(len(self.mean))
        for i, (at, x, stats) in enumerate(rows):
            at, x = np.concatenate([at, tail]), np.concatenate([x, self.dense(stats)])
            v = self.factors[at] * x[:, None]
            out[i] = self.bias + self.weight[at] @ x + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(labels: np.ndarray, counts: tuple[int, int], rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]],
        metadata: tuple[str, ...] = ()) -> Model:
    """Adam on the weighted logistic loss; ``counts`` are the labels' numbers in the whole table."""
    model = Model((counts[1] + 1) / (counts[0] + counts[1] + 2), metadata=metadata)
    if len(set(labels.tolist())) < 2:
        return model
    stats = np.array([r[2] for r in rows])
    known = np.isfinite(stats)
    n_known = np.maximum(known.sum(axis=0), 1)
    model.mean = np.where(known, stats, 0).sum(axis=0) / n_known
    model.spread = np.sqrt(np.where(known, (stats - model.mean) ** 2, 0).sum(axis=0) / n_known)
    model.spread[model.spread < 1e-9] = 1.0
    x = np.zeros((len(rows), BUCKETS + stats.shape[1]), np.float32)
    for i, (at, value, s) in enumerate(rows):
        x[i, at] = value
        x[i, BUCKETS:] = model.dense(s)
    y = labels.astype(np.float32)
    per = np.array([counts[0] / max((y == 0).sum(), 1), counts[1] / max((y == 1).sum(), 1)], np.float32)
    w = per[labels] / per[labels].mean()
    rnd = np.random.default_rng(11)
    p = [np.float32(np.log(model.share / (1 - model.share))), np.zeros(x.shape[1], np.float32),
         rnd.normal(0, 0.05, (x.shape[1], RANK)).astype(np.float32)]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(EPOCHS):
        order = rnd.permutation(len(y))
        for k in range(0, len(y), BATCH):
            rows_at = order[k:k + BATCH]
            a, xv = x[rows_at], x[rows_at] @ p[2]
            a2 = a * a
            z = p[0] + a @ p[1] + 0.5 * ((xv ** 2).sum(axis=1) - a2 @ (p[2] ** 2).sum(axis=1))
            g = w[rows_at] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows_at]) / len(rows_at)
            grads = [g.sum(), a.T @ g + DECAY * p[1] / 10,
                     a.T @ (g[:, None] * xv) - p[2] * (a2.T @ g)[:, None] + DECAY * p[2]]
            step += 1
            for j, grad in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * grad
                s[j] = 0.999 * s[j] + 0.001 * grad * grad
                p[j] = p[j] - STEP * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(s[j] / (1 - 0.999 ** step)) + 1e-8)
    model.bias, model.weight, model.factors = float(p[0]), p[1].astype(np.float64), p[2].astype(np.float64)
    return model


def _metadata(names: tuple[str, ...]) -> Column:
    """Named numeric columns as one array, on a log scale; null stays null."""
    scaled = lambda c: F.signum(c) * F.log1p(F.abs(c))
    return F.array(*[scaled(F.col(n).cast("double")) for n in names]).cast("array<double>")


def _rows(texts: pa.Array, metadata: pa.Array):
    for raw, meta in zip(texts.cast(pa.binary()), metadata, strict=True):
        at, x, stats = features(raw.as_py() or b"")
        yield at, x, np.concatenate([stats, np.array([np.nan if v is None else v for v in meta.as_py()], np.float64)])


def learn(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit the model to a bounded sample of the labelled rows that are not held out."""
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("id")).agg((F.avg((F.col(label_col) > 0).cast("int")) >= 0.5).alias("label")))
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = counts.get(False, 0), counts.get(True, 0)
    if not n0 or not n1:
        return fit(np.zeros(0, int), (n0, n1), [], metadata)
    rate = F.when(F.col("label"), F.lit(MAX_ROWS / 2 / n1)).otherwise(F.lit(MAX_ROWS / 2 / n0))
    sample = marked.where(draw("quality", F.col("id")) < rate)

    @F.arrow_udf("binary")
    def packed(texts: pa.Array, meta: pa.Array) -> pa.Array:
        return pa.array([len(at).to_bytes(4, "little") + at.astype("<u4").tobytes() + x.astype("<f4").tobytes()
                         + stats.astype("<f8").tobytes() for at, x, stats in _rows(texts, meta)], pa.binary())

    # The sample has MAX_ROWS ids in the mean, whatever the tables' sizes.
    found = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _metadata(metadata).alias("meta"))
             .join(F.broadcast(sample), "id")
             .select("id", "label", F.struct(F.xxhash64("text", "meta").alias("h"), packed("text", "meta").alias("x")).alias("x"))
             .groupBy("id").agg(F.first("label").alias("label"), F.min("x").alias("x"))
             .select("id", F.col("label").cast("int").alias("label"), "x.x").toArrow().sort_by("id"))
    rows = []
    for raw in found.column("x").to_pylist():
        n = int.from_bytes(raw[:4], "little")
        rows.append((np.frombuffer(raw, "<u4", n, 4).astype(np.int64), np.frombuffer(raw, "<f4", n, 4 + 4 * n).astype(np.float64),
                     np.frombuffer(raw, "<f8", -1, 4 + 8 * n)))
    return fit(found.column("label").to_numpy(), (n0, n1), rows, metadata)


def scorer(model: Model):
    """A column function: (text, metadata array) -> probability of label 1."""
    @F.arrow_udf("double")
    def score(texts: pa.Array, meta: pa.Array) -> pa.Array:
        out, held = [], []
        for row in _rows(texts, meta):
            held.append(row)
            if len(held) == 64:
                out.append(model.score(held))
                held = []
        return pa.array(np.concatenate([*out, model.score(held)]), pa.float64())
    return score


def scored(docs: DataFrame, model: Model, text_col: str = "text", as_col: str = "quality_score") -> DataFrame:
    """``docs`` with the score as a new column ``as_col``."""
    if as_col in docs.columns:
        raise ValueError(f"the table has a column {as_col} already; name another with as_col")
    return docs.withColumn(as_col, scorer(model)(F.col(text_col), _metadata(model.metadata)))


def op11_query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = learn(docs, read_table(spark, sf_dir, "labels"), metadata=("n_chars",))
    return (scored(docs, model, as_col="score")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
