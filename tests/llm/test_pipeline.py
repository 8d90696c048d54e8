"""The pipeline against plain Python over a small table."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as public
import tiktoken

import corpus_pipeline
from sluice.llm import bpe, langid
from tests.llm.test_exact import _lower
from tests.llm.test_mixing import _targets
from tests.llm.test_simhash import plain_fingerprint, plain_roots

SF = "/root/testdata/sf0.001"


def _table(spark, path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(90_000, None, "en", "src0", 0), (90_001, "12 34 !", "en", None, 7), (90_002, "", None, "src1", 0)]
    rows += [(90_100 + i, rows[i][1].upper() if rows[i][1].isascii() else rows[i][1], "xx", None, 1) for i in range(20)]
    spark.createDataFrame(rows, docs.schema).repartition(4).write.parquet(f"{path}/documents.parquet")
    return rows


def test_run_equals_brute_force(spark, tmp_path):
    rows = _table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = langid.learn(docs)
    rows = [r for r in rows if model.predict((r[1] or "").encode())[0] != "und"]
    first = {}
    for r in sorted(rows):
        first.setdefault(_lower(r[1]), r)
    rows = list(first.values())
    roots = plain_roots([plain_fingerprint(r[1]) for r in rows], 4)
    groups = defaultdict(list)
    for r in rows:
        groups[roots[plain_fingerprint(r[1])]].append(r)
    rows = [min(g) for g in groups.values()]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].encode().split())
    targets, out = _targets(dict(sizes)), Counter()
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(
        public.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in rows:
        rate = targets[r[3]] / sizes[r[3]]
        u = int(hashlib.md5(f"mix-1:{r[0]}".encode()).hexdigest()[:13], 16) / 2 ** 52
        ids = enc.encode_ordinary(r[1])
        row = (r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256(r[1].encode()).hexdigest())
        out[row] += int(rate) + (u < rate - int(rate))
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == +out


def test_stages_return_the_columns_of_documents_and_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != "byte_bpe":
            assert out.columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "source_mixing", "byte_bpe"]
