"""Line de-duplication against a plain scan of all windows."""

import random
from collections import defaultdict

import pytest

from sluice.llm import lines

SCHEMA = "doc_id long, text string, lang string, digest string, s int"
BLANK = " \t\r\x0b\x0c"


def _rows():
    rnd = random.Random(21)
    pool = [f"line {i} é" for i in range(30)] + ["one", "two words", "a line of five words", "long line " * 6]
    passage = [f"passage {i}" for i in range(7)]
    rows = []
    for i in range(150):
        body = rnd.choices(pool, k=rnd.randrange(0, 14))
        if i % 3 == 0:
            at = rnd.randrange(len(body) + 1)
            body[at:at] = passage[:rnd.choice([2, 3, 5, 7])]
        body = [x if rnd.random() < 0.9 else rnd.choice(["  " + x + "\t", "", " \r"]) for x in body]
        rows.append((i, "\n".join(body)))
    rows += [(500, None), (501, ""), (502, "\n\n \n"), (503, "same\n" * 9), (504, "x" * 100_000 + "\n" + "y\n" * 5000),
             (None, rows[3][1]), (505, "twin\na\nb\nc"), (505, "twin\na\nb\nc")]
    rnd.shuffle(rows)
    return [(*r, "en", "d", 1) for r in rows]


def _plain(rows, words):
    """(id, text) -> cleaned text."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1] is not None},
                  key=lambda d: d[:2])
    solid = {d: [i for i, x in enumerate(d[2].split("\n")) if x.strip(BLANK)] for d in docs}
    seen, gone = {}, defaultdict(set)

    def upto(keys, at):
        """Behind the shortest run from ``at`` on with enough words; None without."""
        n = 0
        for e in range(at, len(keys)):
            n += len(keys[e].encode().split())
            if n >= words:
                return e + 1
        return None

    for d in docs:
        text = d[2].split("\n")
        keys = [text[i].strip(BLANK) for i in solid[d]]
        for s in range(len(keys)):
            e = upto(keys, s)
            if e is None:
                break
            if tuple(keys[s:e]) not in seen:
                seen[tuple(keys[s:e])] = (keys, e)
                continue
            theirs, at = seen[tuple(keys[s:e])]
            mine, other = (ks[x:(upto(ks, x) or len(ks) + 1) - 1] for ks, x in ((keys, e), (theirs, at)))
            k = 0
            while k < min(len(mine), len(other)) and mine[k] == other[k]:
                k += 1
            gone[d] |= set(solid[d][s:e + k])
    return {(None if d[0] else d[1], d[2]): "\n".join(x for i, x in enumerate(d[2].split("\n")) if i not in gone[d]) for d in docs}


@pytest.mark.parametrize("size", [1, 5, 9])
def test_equals_scan_of_all_windows(spark, size):
    rows = _rows()
    want = _plain(rows, size)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = lines.dedup_lines(df, min_words=size)
    assert out.columns == [*df.columns, "lines"]
    got = sorted(map(str, ((r["doc_id"], r["text"], tuple(r["lines"])) for r in out.collect())))
    plain = []
    for i, t, *_ in rows:
        new = None if t is None else want[i, t]
        n = 0 if t is None else t.count("\n") + 1
        removed = 0 if t is None else n - (new.count("\n") + 1 if new or n == 1 else 0)
        plain.append((i, new, (n, removed)))
    # A text that lost all its lines and one that became a blank line look alike; compare those by text only.
    key = lambda x: x if x[1] else (x[0], x[1], x[2][0])
    assert sorted(str(key(x)) for x in plain) == sorted(str(key(x)) for x in map(eval, got))


def test_runs_name_their_first_copy(spark):
    a = "\n".join(f"this is line {i}" for i in range(8))
    rows = [(1, "head\n" + a), (2, a + "\ntail"), (3, "this is line 2\n\nthis is line 3\nthis is line 4"), (4, "this is line 5")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["start_line"], r["end_line"], r["first_id"], r["first_line"])
                 for r in lines.repeated_runs(df).collect())
    assert got == [(2, 0, 8, 1, 1), (3, 0, 3, 1, 3)]


def test_one_long_line_is_enough_and_short_ones_go_with_their_run(spark):
    line = "Subscribe to our newsletter for updates"
    rows = [(1, f"x\n{line}\nok\nend of one"), (2, f"y\n{line}\nok\nend of two"), (3, f"z\n{line}"), (4, "ok"), (5, "x")]
    out = {r["doc_id"]: (r["text"], r["lines"]["n_removed"]) for r in lines.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("y\nend of two", 2), 3: ("z", 1), 4: ("ok", 0), 5: ("x", 0)}


def test_clashing_result_column(spark):
    df = spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, lines string")
    with pytest.raises(ValueError, match="lines"):
        lines.dedup_lines(df)
    assert lines.dedup_lines(df, as_col="cut").columns == ["doc_id", "text", "lines", "cut"]


def test_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
