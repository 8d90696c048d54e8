"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import (ann, bpe, collocations, exact, hard_negatives, langid, licenses, lines, mixing, quality, secret_scan, simhash,
                        suffix)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": suffix.op1_query,
    "op2_simhash_dedup": simhash.op2_query,
    "op3_nearest_neighbours": ann.op3_query,
    "op4_secret_scan": secret_scan.op4_query,
    "op5_exact_dedup": exact.op5_query,
    "op6_byte_bpe": bpe.op6_query,
    "op7_language_id": langid.op7_query,
    "op8_line_dedup": lines.op8_query,
    "op9_source_mixing": mixing.op9_query,
    "op10_license_scan": licenses.op10_query,
    "op11_quality_classifier": quality.op11_query,
    "op12_phrase_collocations": collocations.op12_query,
    "op13_hard_negatives": hard_negatives.op13_query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_nearest_neighbours": ann.ORACLE_SQL,
    "op5_exact_dedup": exact.ORACLE_SQL,
    "op8_line_dedup": lines.ORACLE_SQL,
    "op9_source_mixing": mixing.ORACLE_SQL,
    "op12_phrase_collocations": collocations.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
