"""Block search against a full search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def _rows():
    rnd = random.Random(8)
    vec = lambda n: [rnd.gauss(0, 1) for _ in range(n)]
    common, rows = vec(8), []
    rows += [(i, vec(8) if i % 3 else common) for i in range(400)]
    rows += [(1000 + i, vec(5)) for i in range(30)]
    rows += [(2000, None), (2010, []), (2020, [0.0] * 8), (2030, [1.0, None] + [0.5] * 6), (2040, [math.nan] + [1.0] * 7),
             (2050, [math.inf] + [1.0] * 7), (None, vec(8)), (2060, [1e-30] * 8), (2070, [3e4] * 8), (2080, vec(3))]
    rows += [(7, vec(8)), (40, rows[40][1])]
    return [(i, v, 1, 0.5, "x") for i, v in rows]


def _plain(rows, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows
          if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = {}
    for q, x in sorted(ok, key=lambda r: (r[0], r[1].tolist())):
        if q % 10 or q in out:
            continue
        cand = [(-float(ann.exact_products(x[None], y[None])[0]), i) for i, y in ok if i != q and len(y) == len(x)]
        out[q] = [(i, -s) for s, i in sorted(cand)[:k]]
    return out


@pytest.mark.parametrize("block,k", [(ann.MAX_BLOCK, 7), (40, 7), (100, 60)])
def test_equals_full_search(spark, monkeypatch, block, k):
    monkeypatch.setattr(ann, "MIN_BLOCK", 50)
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 10 == 0, k, max_block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got == {q: v for q, v in _plain(rows, k).items() if v}


def test_error_bounds_hold():
    rnd = np.random.default_rng(2)
    x, y = rnd.normal(size=(50, 64)), rnd.normal(size=(70, 64)) * rnd.uniform(0.001, 1000, size=(70, 1))
    product, error = ann.tile_bounds(ann.quantise(x), ann.quantise(y))
    assert (np.abs(product - x @ y.T) <= error).all() and (error < 0.1 * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)).all()


def test_empty_table_and_no_query(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0, 5).count() == 0
    assert ann.nearest(spark.createDataFrame([(1, [1.0], 1, 0.0, "")], SCHEMA), F.col("vec_id") % 10 == 0, 5).count() == 0
