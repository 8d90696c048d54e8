"""Fingerprints, covering masks and components against brute force."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash
from sluice.llm.components import components

SCHEMA = "doc_id long, text string, fp string, label int"


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_roots(values, radius):
    """value -> smallest linked value, by all pairs."""
    v = np.array(sorted(set(values)), np.uint64)
    root = list(range(len(v)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {int(x): int(v[find(i)]) for i, x in enumerate(v)}


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_small_difference(radius):
    masks = simhash.covering_masks(radius)
    rnd = random.Random(1)
    some = itertools.combinations(range(64), radius) if radius < 3 else (rnd.sample(range(64), radius) for _ in range(20_000))
    for bits in some:
        diff = sum(1 << b for b in bits)
        assert any(m & diff == 0 for m in masks)


def test_fingerprints(spark):
    texts = ["", None, " \t", "one", "One TWO three", "a b c d", "A\x0bb\tc d e É é", "x " * 70_000,
             *(" ".join(random.Random(i).choices("abc def ghi Jkl", k=i * 7)) for i in range(1, 40))]
    got = {r["key"]: r["fp"] for r in simhash.fingerprints(
        spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    for i, t in enumerate(texts):
        assert got[i] & (2 ** 64 - 1) == plain_fingerprint(t), i


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 6])
def test_components_of_dense_and_sparse_fingerprints(spark, monkeypatch, chunk):
    """Clusters larger than a chunk, spread over partitions: no link is lost."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rnd = random.Random(9)
    values = [rnd.getrandbits(64) for _ in range(300)] + [0, 1, 2 ** 63]
    for n, flips in ((250, 3), (60, 6), (40, 2)):
        center = rnd.getrandbits(64)
        values += [center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(flips + 1))) for _ in range(n)]
    chain = rnd.getrandbits(64)
    for i in range(16):  # each within reach of the next only
        values.append(chain)
        chain ^= sum(1 << b for b in range(4 * i, 4 * i + 4))
    prints = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long").repartition(4)
    got = {r["node"] & (2 ** 64 - 1): r["root"] & (2 ** 64 - 1) for r in simhash._components_of(prints, 4).collect()}
    want = plain_roots(values, 4)
    groups, plain = defaultdict(set), defaultdict(set)
    for v in set(values):
        groups[got.get(v, v)].add(v)
        plain[want[v]].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def _documents():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = rnd.choices(vocabulary, k=rnd.choice([3, 40, 200]))
        for c in range(rnd.choice([1, 1, 2, 9])):
            changed = list(words)
            for _ in range(rnd.choice([0, 0, 1, 3])):
                changed[rnd.randrange(len(changed))] = rnd.choice(vocabulary)
            rows.append((i * 100 + c, " ".join(changed), "f", 1))
    rows += [(-5, "", None, None), (7001, None, None, None), (7002, " ", None, None), (None, "none one", None, None),
             (None, "none one", None, None), (7003, "Twins twins", None, None), (7003, "Twins twins", None, None)]
    rnd.shuffle(rows)
    return rows


def test_groups_and_what_stays(spark):
    rows = _documents()
    roots = plain_roots([plain_fingerprint(r[1]) for r in rows], 4)
    smallest = defaultdict(list)
    for r in rows:
        smallest[roots[plain_fingerprint(r[1])]] += [r[0]] if r[0] is not None else []
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = sorted((str(r[0]), str(min(smallest[roots[plain_fingerprint(r[1])]], default=None))) for r in rows)
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(df).collect()) == want
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    out = kept.collect()
    assert sorted(roots[plain_fingerprint(r["text"])] for r in out) == sorted(set(roots.values()))  # one for each group
    assert all(str(r["doc_id"]) == str(min(smallest[roots[plain_fingerprint(r["text"])]], default=None)) for r in out)


def test_query_on_given_documents(spark):
    got = simhash.op2_query(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    roots = plain_roots(prints.values(), 4)
    smallest = {}
    for i, p in prints.items():
        smallest[roots[p]] = min(i, smallest.get(roots[p], i))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        i: (f"{p:016x}", smallest[roots[p]]) for i, p in prints.items()}


def test_components_long_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 1000 + i) for i in range(50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{1000 + i: 5 for i in range(50)}}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).count() == 0 and simhash.simhash_dedup(df).count() == 0
