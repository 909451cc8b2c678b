"""The registered queries of the operators and, where SQL can say the same, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import op1_topk, op2_substrings, op3_bpe, op4_pii, op5_forest, op6_language, op7_revisits, op8_licenses, op9_packing, op10_minhash, op11_lexical, op12_simhash, op13_resampling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk.op1_topk,
    "op2_substring_dedup": op2_substrings.op2_substring_dedup,
    "op3_bpe": op3_bpe.op3_bpe,
    "op4_pii": op4_pii.op4_pii,
    "op5_forest": op5_forest.op5_forest,
    "op6_language": op6_language.op6_language,
    "op7_revisits": op7_revisits.op7_revisits,
    "op8_licenses": op8_licenses.op8_licenses,
    "op9_packing": op9_packing.op9_packing,
    "op10_minhash": op10_minhash.op10_minhash,
    "op11_lexical": op11_lexical.op11_lexical,
    "op12_simhash": op12_simhash.op12_simhash,
    "op13_resampling": op13_resampling.op13_resampling,
}

CHECKS: dict[str, str] = {
    "op1_topk": op1_topk.SQL,
    "op2_substring_dedup": op2_substrings.SQL,
    "op7_revisits": op7_revisits.SQL,
    "op8_licenses": op8_licenses.SQL,
    "op10_minhash": op10_minhash.SQL,
    "op11_lexical": op11_lexical.SQL,
    "op13_resampling": op13_resampling.SQL,
}
