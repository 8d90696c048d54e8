"""Content-sort de-duplication against a plain dictionary."""

import hashlib
import random
from collections import defaultdict

import pytest

from sluice.llm import exact

SCHEMA = "doc_id long, text string, lang string, source string, sha string"


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _rows():
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["Same", "sAME", "other É", "other é", "", None, "x" * 200, "x" * 199 + "Y"]), "en", "s", "z")
            for i in range(300)]
    rows += [(1000 + i, "hot copy", "en", "s", "z") for i in range(600)]
    rows += [(5000 + i, f"alone {i}" + "w " * (i % 7) * 2000, None, None, None) for i in range(200)]
    rows += [(None, "same", None, None, None), (None, "only nulls", None, None, None), (None, "only nulls", "q", None, None),
             (7777, "twins", None, None, None), (7777, "twins", None, None, None)]
    rnd.shuffle(rows)
    return rows


def _expected(rows, largest):
    groups = defaultdict(list)
    for r in rows:
        groups[_lower(r[1])].append(r[0])
    keep = {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep[t] = (max if largest else min)(known) if known else None
    return groups, keep


@pytest.mark.parametrize("keep,parts", [("largest", 1), ("largest", 13), ("smallest", 7)])
def test_groups(spark, keep, parts):
    rows = _rows()
    groups, kept = _expected(rows, keep == "largest")
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = exact.duplicate_groups(df, keep=keep, partitions=parts).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    stays = defaultdict(list)
    for r in got:
        t = by_sha[r["text_sha256"]]
        assert r["keep_id"] == kept[t] and r["group_size"] == len(groups[t])
        if r["kept"]:
            stays[t].append(r["doc_id"])
    assert {t: [kept[t]] for t in groups} == dict(stays)
    assert sorted((str(r["doc_id"]), by_sha[r["text_sha256"]]) for r in got) == sorted((str(r[0]), _lower(r[1])) for r in rows)


def test_dedup_keeps_rows_whole(spark):
    rows = _rows()
    groups, kept = _expected(rows, False)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = exact.exact_dedup(df)
    assert got.columns == df.columns
    out = got.collect()
    assert sorted((_lower(r["text"]), str(r["doc_id"])) for r in out) == sorted((t, str(i)) for t, i in kept.items())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact.duplicate_groups(df).count() == 0 and exact.exact_dedup(df).count() == 0
