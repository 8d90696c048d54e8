"""Mixing: targets against a plain loop, draws against md5, plans without Python."""

import hashlib
import random
from collections import Counter

import pytest

from sluice.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, size int"


def _targets(sizes):
    """Deal the budget, cap, deal the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        unit = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return capped | {s: unit * weight[s] for s in free}
        capped |= {s: 2.0 * sizes[s] for s in over}


def _rows():
    rnd = random.Random(11)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 40)) + "\t\n", rnd.choice(["b", "a", "é", "Z", "", "tiny%d" % (i % 25)]), "x", i)
            for i in range(1500)]
    rows += [(5000 + i, "big one two", "hot", None, None) for i in range(1500)]
    rows += [(9000, None, "silent", None, 1), (9001, "", "silent", None, 1), (None, "no id", None, None, 1),
             (None, "no id", None, None, 1), (9002, "of none", None, None, None), (9003, "w " * 50_000, "a", None, None)]
    return rows


@pytest.mark.parametrize("limit_bytes", [mixing.BROADCAST_BYTES, 0])
def test_plan_and_mix(spark, limit_bytes):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = mixing.mix_plan(df, broadcast_bytes=limit_bytes).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += size(r[1])
    want = _targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12, abs=1e-9)
        key = ":".join(["mix-1"] + ([str(r["doc_id"])] if r["doc_id"] is not None else []))
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2 ** 52
        rate = r["target"] / r["source_size"] if r["source_size"] else 0.0
        assert r["copies"] == int(rate) + (u < rate - int(rate))
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert taken["hot"] == pytest.approx(want["hot"], rel=0.1)
    mixed = mixing.mix(df, broadcast_bytes=limit_bytes)
    assert mixed.columns == df.columns
    out = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    plan = Counter()
    for r in got:
        plan[r["doc_id"], r["source"]] += r["copies"]
    seen = Counter()
    for (i, _, s), n in out.items():
        seen[i, s] += n
    assert seen == +plan


def test_reruns_agree_and_no_python(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    one = sorted(map(str, mixing.mix_plan(df.repartition(3)).collect()))
    plan = mixing.mix_plan(df.repartition(7))
    assert one == sorted(map(str, plan.collect()))
    text = plan._jdf.queryExecution().toString() + mixing.mix(df)._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow"))


def test_empty_and_wordless(spark):
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, " ", "a", None, None), (2, None, "b", None, None)], SCHEMA)
    assert [(r["target"], r["taken"]) for r in mixing.mix_plan(df).collect()] == [(0.0, 0)] * 2
