"""From raw documents to tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run``
writes every result as Parquet and rereads it as the next stage's documents.
The first four return the columns of ``documents``:

1. language ID: documents without a language (no letter in the text) go;
2. exact de-duplication: of equal texts the smallest id stays;
3. SimHash near-de-duplication: of each group of near copies the smallest id stays;
4. mixing: each document as often as its source's target weight asks;
5. byte-level BPE: one row per document of the mix with its token count and
   the digests of its ids and of what they decode to.

Null and empty texts go in the first stage; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, exact, langid, mixing, simhash
from sluice.llm.common import materialise, read_table
from sluice.session import ship_package

SHINGLE_WORDS = 4
MAX_BITS = 4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.learn(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(docs, keep="smallest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs, shingle=SHINGLE_WORDS, radius=MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return bpe.token_digests(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: The language model, SimHash and BPE are beyond SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
