"""Dynamic itemset counting against counting everything."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, n int, phrase string, shard string"


def _rows():
    rnd = random.Random(9)
    vocab = ["a", "b", "c", "Dd", "É", "ßx", "x-y", "\x1cq", " ", "10%", " z"]
    fixed = ["b c Dd É", "a b c", "c c c c c c", "x-y 10%", "a b c Dd É b"]
    rows = []
    for i in range(260):
        words = []
        for _ in range(rnd.randrange(0, 14)):
            words += rnd.choice(fixed).split(" ") if rnd.random() < 0.4 else [rnd.choice(vocab)]
            if rnd.random() < 0.15:
                words[-1] += rnd.choice([".", ",", "!?", "\n", ":\r", ";\x0b"])
        rows.append((rnd.choice([" ", "  ", "\t"]).join(words), rnd.choice(["en", "en", "fr", None, "und"])))
    rows += [(None, "en"), ("", "en"), ("...", "fr"), (" \t ", None), ("\x00 \x00 \x00", "nul")]
    rows += [("Copy of THE same text", "en")] * 9 + [("a b c Dd " * 700, "long"), ("only " * 3, "few"), ("w" * 5000, "long")]
    return rows


def _plain(rows, threshold, most, top, factor=1000, covered=100):
    f, n, out = Counter(), Counter(), []
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, most + 1) for i in range(len(words) - k + 1))
    f = {x: c for x, c in f.items() if c >= threshold}
    cand = {x: c for x, c in f.items() if len(x[1]) > 1}
    gone = set()
    for (lang, w), c in cand.items():
        gone |= {(lang, w[i:i + m]) for m in range(2, len(w)) for i in range(len(w) - m + 1)
                 if 100 * c >= covered * cand[lang, w[i:i + m]]}
    for lang in {x[0] for x in cand}:
        rows = []
        for (of, w), a in cand.items():
            if of == lang and (of, w) not in gone:
                score, _, left, right = min((factor * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                            for k in range(1, len(w)))
                rows.append((-score, -a, " ".join(w).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def _table(spark, rows):
    return spark.createDataFrame([(i, t, la, 3, "p", "s") for i, (t, la) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("threshold,most,top,part,bits", [(5, 5, 2000, 4 << 20, 1 << 16), (3, 4, 7, 37, 64), (40, 3, 3, 500, 1 << 12)])
def test_equals_counting_everything(spark, monkeypatch, threshold, most, top, part, bits):
    monkeypatch.setattr(co, "_PART", part)
    monkeypatch.setattr(co, "MIN_BITS", bits)
    monkeypatch.setattr(co, "MAX_BITS", bits)
    monkeypatch.setattr(co, "_WORDS_KEPT", 8 if part < 100 else 500_000)
    rows = _rows()
    got = sorted(tuple(r) for r in co.collocations(_table(spark, rows), threshold, most, top).collect())
    assert got == _plain(rows, threshold, most, top) and len(got) > 5


def test_other_cover_and_factor(spark):
    rows = _rows()
    got = sorted(tuple(r) for r in co.collocations(_table(spark, rows), 6, 4, 50, factor=10, covered=60).collect())
    assert got == _plain(rows, 6, 4, 50, 10, 60)


def test_a_phrase_is_counted_only_where_both_parts_reached():
    words = co._Words()
    ids = words.numbers(b"a b a c . b".split())
    hashed = co._begin("en", co.word_hashes([b"a", b"b"]))
    table, none = np.zeros(8, np.uint64), np.zeros(8, np.uint64)
    for h in hashed.tolist():
        table[(h >> 12) & 7] |= np.uint64(1 << (h & 63) | 1 << ((h >> 6) & 63))
    places = lambda lang, tables: [at.tolist() for _, at, _, _ in co._walk(lang, ids, words.hashes, tables)]
    assert places("en", [table, none]) == [[0, 1, 2, 3, 5], [0, 1], []]
    assert places("fr", [table, none])[1:] == [[], []]
    batch = pa.record_batch([pa.array(["en", "en"]), pa.array(["A b a\tc.", "b"])], names=["lang", "text"])
    count = lambda now, then, words_too: {(r["k"], r["hash"]): r["n"] for b in co.scanner(now, then, words_too)([batch])
                                          for r in b.to_pylist()}
    assert sorted(n for (k, _), n in count([table, none], None, True).items() if k == 1) == [1, 2, 2]
    assert sorted(n for _, n in count([table, none], [none, none], False).items()) == [1, 1]
    assert count([table, none], [table, none], False) == {}


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 999_999_999_999_937, 99_999_999_999_999_977, 999_999_999_999_999_989, 999_999_999_999_999_877
    got = spark.range(1).selectExpr(
        f"(cast(1000 as decimal(4,0)) * cast({a} as decimal(15,0))) * cast({n} as decimal(17,0)) "
        f"div (cast({left} as decimal(18,0)) * cast({right} as decimal(19,0))) as s",
        f"(cast(1000 as decimal(4,0)) * cast({a} as decimal(15,0))) * cast({n} as decimal(17,0)) "
        "div (cast(100003 as decimal(18,0)) * cast(100000000000019 as decimal(19,0))) as t").first()
    assert got == (1000 * a * n // (left * right), 1000 * a * n // (100003 * 100000000000019))


def test_empty_table(spark):
    assert co.collocations(_table(spark, _rows()).limit(0)).count() == 0
