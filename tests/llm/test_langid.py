"""Language identification: codes, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pytest

from sluice.llm import langid

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, found int"


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 40])
def test_codewords_are_apart_and_split_the_languages(n):
    code = langid.codewords(n)
    assert set(np.unique(code)) == {-1.0, 1.0}
    apart = (code.shape[1] - code @ code.T) / 2
    assert apart[~np.eye(n, dtype=bool)].min() >= max(1, code.shape[1] // 4)


def test_features_of_whole_texts():
    for raw in (b"", b" 12 #%", "€ € ¥".encode()):
        assert langid.features(raw) is None
    assert langid.features("漢字".encode()) is not None
    x = langid.features(b"Ab cd" * 10)
    assert np.isclose(np.dot(x, x), 1) and np.array_equal(x, langid.features(b"aB Cd" * 10))
    long = b"the end of it " * 200_000 + "é".encode() * 99
    old, langid._PART = langid._PART, 1 << 30
    try:
        whole = langid.features(long)
    finally:
        langid._PART = old
    assert np.allclose(langid.features(long), whole)


def test_held_out_accuracy(spark):
    got = langid.op7_query(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98
    assert sum(r["ambiguous"] for r in got) / len(got) < 0.01


def test_edges_and_clashing_columns(spark):
    rows = [(i, ("alpha beta gamma " if i % 2 else "xyzzy quux zork ") * 20, "aa" if i % 2 else "bb", "s", 1) for i in range(200)]
    odd = [(1000, None, "aa", None, None), (1001, "", None, None, None), (1002, "123 !!", "aa", None, None),
           (None, "beta alpha", "cc", None, None), (1003, "zork " * 300_000, None, None, None), (5, rows[5][1], "aa", "s", 1)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    model = langid.learn(docs)
    assert model.languages == ["aa", "bb"]
    got = {(r["doc_id"], r["text"]): r["language"] for r in langid.identify(docs, model).collect()}
    assert [got[i, t]["lang"] for i, t, *_ in odd] == ["und", "und", "und", "aa", "bb", "aa"]
    assert all(got[i, t]["lang"] == lang for i, t, lang, *_ in rows)
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 3
    assert langid.accepted(docs, model, drop_ambiguous=True).count() <= kept.count()


def test_no_rows_and_one_language(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert langid.identify(none, langid.learn(none)).count() == 0
    one = spark.createDataFrame([(i, f"word{i} again", "aa", None, None) for i in range(9)], SCHEMA)
    assert {tuple(r["language"])[:2] for r in langid.identify(one, langid.learn(one)).collect()} == {("aa", 1.0)}
    unlabelled = spark.createDataFrame([(1, "text", None, None, None)], SCHEMA)
    assert langid.identify(unlabelled, langid.learn(unlabelled)).first()["language"]["lang"] == "und"


def test_texts_stay_where_no_language_could_be_learned(spark):
    texts = ["plain words", "12 34 !", None, "", "漢字", "€ ¥", "Ünder"]
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1][:len(texts)]
    for lang in (None, "aa"):  # no labels; labels in the held-out part only
        docs = spark.createDataFrame([(i, t, lang, None, None) for i, t in zip(held, texts, strict=True)], SCHEMA)
        model = langid.learn(docs)
        assert model.languages == []
        kept = langid.accepted(docs, model)
        assert kept.columns == docs.columns
        assert {r["text"] for r in kept.collect()} == {"plain words", "漢字", "Ünder"}
        assert langid.accepted(docs, model, drop_ambiguous=True).count() == 3


def test_every_language_is_learned(spark):
    word = lambda k: "".join(chr(97 + k // 26 ** j % 26) * 2 for j in range(3))
    rows = [(i, f"{word(37 * (i % 230))} " * 5, f"l{i % 230:03d}", None, None) for i in range(230 * 40)]
    docs = spark.createDataFrame(rows + [(10 ** 6 + i, "12 3", "none", None, None) for i in range(5)], SCHEMA)
    model = langid.learn(docs)
    assert model.languages == [f"l{k:03d}" for k in range(230)]
    assert sum(model.predict(t.encode())[0] == lang for _, t, lang, *_ in rows[:230]) > 0.95 * 230


def test_a_column_is_not_overwritten(spark):
    docs = spark.createDataFrame([(1, "some text", "mine")], "doc_id long, text string, language string")
    model = langid.learn(docs.withColumn("lang", docs["language"]))
    with pytest.raises(ValueError, match="language"):
        langid.identify(docs, model)
    assert langid.identify(docs, model, as_col="found").columns == ["doc_id", "text", "language", "found"]
