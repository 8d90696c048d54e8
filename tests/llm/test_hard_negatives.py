"""Hilbert order, zone-map bounds, and mining against a plain loop."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, block string, v string"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2), (1, 5)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hn.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("size", [100, 1 << 29, 1 << 40])
def test_bounds_and_products(size):
    rnd = np.random.default_rng(3)
    a, b = (rnd.integers(-size, size, (20, 6)) for _ in range(2))
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    low, high = hn.bounds(a, b.min(axis=0)[None, :], b.max(axis=0)[None, :])
    for row, lo, hi in zip(exact, low[:, 0], high[:, 0], strict=True):
        assert all(lo <= x <= hi for x in row)
    if max(abs(x) for row in exact for x in row) < 1 << 63:
        assert hn.products(a, b).tolist() == exact
    else:
        with pytest.raises(OverflowError):
            hn.products(a, b)


def _rows():
    rnd = random.Random(5)
    near = lambda c: [x + rnd.gauss(0, 0.3) for x in c]
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    common = [0.5] * 6
    rows = [(i, near(centres[rnd.randrange(4)]), rnd.randrange(4) if i % 3 else 0) for i in range(300)]
    rows += [(300 + i, common, i % 2) for i in range(120)]                     # ties
    rows += [(500 + i, [rnd.gauss(0, 1) for _ in range(3)], i % 3) for i in range(40)]   # another length
    rows += [(None, common, 1), (600, None, 1), (610, common, None), (620, [], 1), (630, [1.0, None] + common[2:], 1),
             (640, [math.nan] + common[1:], 1), (650, [math.inf] + common[1:], 0), (660, [0.0] * 6, 2), (670, [3.0e9] * 6, 3),
             (680, [-1.0] * 6, 17)]
    rows += [rows[20], (40, rows[41][1], rows[41][2]), rows[7], rows[7]]         # repeated ids and rows
    return rows


def _plain(rows, every, scale=256, positives=5, negatives=3, low=50, high=95):
    ok = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
          if i is not None and lab is not None and v and None not in v and all(map(math.isfinite, v))]
    out = set()
    anchors = {}
    for i, v, lab in ok:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    for i, (lab, v) in anchors.items():
        others = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), j, of) for j, w, of in ok if j != i and len(w) == len(v)),
                        key=lambda x: x[:2])
        for p, j, _ in [x for x in others if x[2] == lab][:positives]:
            fit = [(n, q) for n, q, of in others if of != lab and low * -p <= 100 * -n <= high * -p]
            out |= {(i, j, r + 1, q, -p, -n) for r, (n, q) in enumerate(fit[:negatives])}
    return out


@pytest.mark.parametrize("block,slice_rows,pilot", [(7, 5, 2), (64, 4096, 1), (2048, 4096, 2)])
def test_equals_plain_loop(spark, monkeypatch, block, slice_rows, pilot):
    monkeypatch.setattr(hn, "PILOT", pilot)
    monkeypatch.setattr(hn, "ZONES", 16)
    rows = _rows()
    df = spark.createDataFrame([(i, v, lab, 3, "x", "y") for i, v, lab in rows], SCHEMA).repartition(3)
    got = hn.mine(df, F.col("vec_id") % 10 == 0, block_rows=block, slice_rows=slice_rows).collect()
    assert {tuple(r) for r in got} == _plain(rows, 10) and len(_plain(rows, 10)) > 100


def test_other_windows_and_scale(spark):
    rows = _rows()[:200]
    df = spark.createDataFrame([(i, v, lab, 3, "x", "y") for i, v, lab in rows], SCHEMA)
    got = hn.mine(df, F.col("vec_id") % 4 == 0, scale=1000, positives=2, negatives=7, low=10, high=60, block_rows=16).collect()
    assert {tuple(r) for r in got} == _plain(rows, 4, 1000, 2, 7, 10, 60)


def test_blocks_out_of_reach_are_not_read(spark):
    # Two far clusters a label: the windows of an anchor need its own side only.
    rows = [(i, [10.0 + i % 7 / 100, 1.0] if i < 200 else [-10.0 - i % 5 / 100, 1.0], i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label long").select(
        "id", "label", F.transform("v", lambda x: F.floor(x * 256)).alias("v"), (F.col("id") == 0).alias("asks"))
    blocks, zones = hn.write_blocks(df, 20)
    assert zones.count() == 20
    windows = F.array(F.struct(F.lit(0).alias("w"), F.lit(1).cast("long").alias("lo"), F.lit(hn._MOST).alias("hi")))
    anchors = blocks.where("asks").select(F.lit(0).cast("long").alias("slice"), F.lit(0).alias("no"), "id", "label", "v",
                                          windows.alias("windows"))
    wanted = hn.Search(blocks, zones).choose(anchors, 1, True, 0).select(F.explode("blocks").alias("block"))
    read = {r["id"] for r in wanted.join(blocks, "block").collect()}
    assert read == {i for i in range(200) if i % 2 == 0}


def test_too_large_component_is_an_error(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0], 0, 1, "", ""), (1, [1.0, 1.0], 0, 1, "", "")], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        hn.mine(df, F.col("vec_id") % 10 == 0).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.mine(none, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1, 1, "", ""), (3, [1.0], 2, 1, "", "")], SCHEMA)
    assert hn.mine(one, F.col("vec_id") % 10 == 0).count() == 0 and hn.mine(one, F.col("vec_id") == 5).count() == 0
