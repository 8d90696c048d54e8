"""Repeated passages against a plain scan of all stretches."""

import random
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import suffix

SCHEMA = "doc_id long, text string, lang string, h long, lo int"


def _rows(size):
    rnd = random.Random(33)
    vocabulary = [f"w{i}é" for i in range(60)]
    passages = [rnd.choices(vocabulary, k=rnd.choice([size - 1, size, size + 1, 3 * size])) for _ in range(6)]
    rows = []
    for i in range(110):
        words = rnd.choices(vocabulary, k=rnd.randrange(0, 4 * size))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            p, at = rnd.choice(passages), rnd.randrange(len(words) + 1)
            a = rnd.choice([0, 0, rnd.randrange(len(p))])
            words[at:at] = p[a:] if rnd.random() < 0.7 else p[:len(p) - a]
        rows.append((i, "".join(w.upper().replace("É", "é") + rnd.choice([" ", "\n", " \t"]) if rnd.random() < 0.2 else w + " " for w in words)))
    rows += [(200 + i, rows[5][1]) for i in range(25)]  # copies of one document
    rows += [(500, None), (501, ""), (502, " \n"), (503, "same " * 5 * size), (504, "one " * 3 + "two " * size),
             (None, rows[7][1]), (505, rows[9][1]), (505, rows[9][1])]
    rnd.shuffle(rows)
    return [(*r, "en", 1, 1) for r in rows]


def _plain(rows, size):
    """(id, text) -> the words that lie in a stretch that occurs earlier."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).encode().split()
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1]}, key=lambda d: d[:2])
    seen, gone = set(), defaultdict(set)
    for d in docs:
        words = low(d[2])
        for s in range(len(words) - size + 1):
            w = tuple(words[s:s + size])
            if w in seen:
                gone[None if d[0] else d[1], d[2]] |= set(range(s, s + size))
            seen.add(w)
    return gone


@pytest.mark.parametrize("size,window,parts", [(10, 6, 1), (10, 7, 9), (14, 3, 5)])
def test_equals_scan_of_all_stretches(spark, size, window, parts):
    rows = _rows(size)
    want = _plain(rows, size)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = defaultdict(set)
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1])
    spans = suffix.repeated_spans(df, min_words=size, window=window, partitions=parts).collect()
    for r in spans:
        assert len(texts[r["doc_id"]]) == 1 and r["end_word"] - r["start_word"] >= size
        (text,) = texts[r["doc_id"]]
        got[r["doc_id"], text] |= set(range(r["start_word"], r["end_word"]))
        (other,) = texts[r["first_id"]]  # the span's words stand there, earlier
        n = r["end_word"] - r["start_word"]
        assert other.lower().split()[r["first_start_word"]:][:n] == text.lower().split()[r["start_word"]:][:n]
    assert got == want
    out = suffix.remove_repeats(df, min_words=size, window=window)
    assert out.columns == df.columns
    cut = {(r["doc_id"], r["text"]) for r in out.collect()}
    for i, t, *_ in rows:
        left = None if t is None else [w for k, w in enumerate(t.split()) if k not in want.get((i, t), ())]
        assert any(i == j and (u if u is None else u.split()) == left for j, u in cut)


def test_stretch_hashes():
    a, b = suffix.Words(b"a b c d e f g h " * 40), suffix.Words(b"x " + b"a b c d e f g h " * 40)
    at = np.arange(0, 200, 7)
    for k in (0, 1):
        assert (a.stretch(at, at + 9, k) == b.stretch(at + 1, at + 10, k)).all()
        assert len(set(a.stretch(np.arange(8), np.arange(8) + 9, k).tolist())) == 8


def test_short_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "few words", "", 1, 1), (2, "few words", "", 1, 1)], SCHEMA)
    assert suffix.repeated_spans(df).count() == 0 and suffix.remove_repeats(df).count() == 2
    assert suffix.repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0
