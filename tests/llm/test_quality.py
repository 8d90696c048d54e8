"""Factorisation machine: scores against the sum over all pairs, edge cases, held-out accuracy."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import quality
from sluice.llm.common import read_table
from sluice.llm.langid import held_out

SCHEMA = "doc_id long, text string, n_chars long, lang string, score double, quality int"


def _docs(spark):
    good = "the quiet river runs past the old mill and on to the sea, where small boats wait."
    bad = "BUY!! NOW!! CHEAP!! ### $$$ CLICK!! HERE!! %%%"
    rows = [(i, f"{good if i % 2 else bad} {i}", 60 + i, "en", 0.1, 5) for i in range(300)]
    rows += [(1000, None, None, None, None, None), (1001, "", 0, "en", 0.0, 0), (None, good, 3, "en", 0.0, 0),
             (1002, "word " * 400_000, None, "en", 0.0, 0), (1003, "x" * 3_000_000, 7, "en", 0.0, 0),
             (1, f"{good} 1", 61, "en", 0.1, 5), (1004, "été \U0001f600\x00", -5, "fr", 0.0, 0)]
    return spark.createDataFrame(rows, SCHEMA), len(rows)


def _labels(spark):
    rows = [(i, i % 2, 0) for i in range(300)] + [(4, 1, 0), (4, 0, 0), (4, 0, 0), (None, 1, 0), (7, None, 0), (9999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_score_is_the_sum_over_all_pairs():
    rnd = np.random.default_rng(1)
    texts = [b"", b"one", b"A few words, a FEW 12 words!!\nagain\nagain", "é ## ".encode() * 40]
    rows = [(*quality.features(t)[:2], np.concatenate([quality.features(t)[2], [np.nan]])) for t in texts]
    n = len(quality.STATS) + 1
    model = quality.Model(0.5, 0.3, rnd.normal(size=n), rnd.uniform(1, 2, n), rnd.normal(size=quality.BUCKETS + n),
                          rnd.normal(size=(quality.BUCKETS + n, quality.RANK)))
    for got, (at, x, stats) in zip(model.score(rows), rows, strict=True):
        full = np.zeros(quality.BUCKETS + n)
        full[at] = x
        full[quality.BUCKETS:] = model.dense(stats)
        on = np.flatnonzero(full)
        z = model.bias + model.weight @ full + sum(
            float(model.factors[i] @ model.factors[j]) * full[i] * full[j] for i, j in itertools.combinations(on, 2))
        assert got == pytest.approx(1 / (1 + math.exp(-min(max(z, -40), 40))), abs=1e-12)


def test_features_do_not_depend_on_the_parts(monkeypatch):
    raw = ("Some words, some MORE words; 42 lines.\n" * 500).encode()
    whole = quality.features(raw)
    monkeypatch.setattr(quality, "_PART", 1000)
    cut = quality.features(raw)
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])
    assert np.allclose(whole[2][:9], cut[2][:9])


def test_edge_rows_all_scored(spark):
    docs, n = _docs(spark)
    model = quality.learn(docs, _labels(spark), metadata=("n_chars",))
    out = quality.scored(docs, model).collect()
    assert len(out) == n and all(0 <= r["quality_score"] <= 1 for r in out)
    by = {r["doc_id"]: r["quality_score"] for r in out}
    assert all((by[i] >= 0.5) == (i % 2 == 1) for i in range(300))
    again = {r["doc_id"]: r["quality_score"] for r in quality.scored(docs.repartition(7), quality.learn(
        docs.repartition(5), _labels(spark).repartition(3), metadata=("n_chars",))).collect()}
    assert all(again[i] == pytest.approx(by[i], abs=1e-6) for i in by)
    with pytest.raises(ValueError, match="score"):
        quality.scored(docs, model, as_col="score")


def test_held_out_labels_are_not_read(spark):
    docs, _ = _docs(spark)
    labels = _labels(spark)
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.learn(docs, x, metadata=("n_chars",)) for x in (labels, flipped))
    assert (a.weight == b.weight).all() and a.bias == b.bias


def test_one_label_no_label_empty_table(spark):
    docs, n = _docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r[0] for r in quality.scored(docs, quality.learn(docs, none)).select("quality_score").collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    share = {r[0] for r in quality.scored(docs, quality.learn(docs, ones)).select("quality_score").collect()}
    assert len(share) == 1 and 0.5 < share.pop() < 1
    model = quality.learn(docs.limit(0), _labels(spark))
    assert quality.scored(docs.limit(0), model).count() == 0


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.op11_query(spark, sf).join(read_table(spark, sf, "labels"), "doc_id", "left").collect()
    docs = {r["doc_id"]: r["h"] for r in read_table(spark, sf, "documents").select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert {r["doc_id"]: r["held_out"] for r in out} == docs and len(out) == len(docs)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in out)
    test = [r for r in out if r["held_out"] and r["quality"] is not None]
    assert len(test) > 50 and sum(r["predicted"] == r["quality"] for r in test) >= 0.95 * len(test)
