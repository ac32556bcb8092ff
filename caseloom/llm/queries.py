"""The registry of this subpackage: opN queries over the benchmark tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm.ann import op3_nearest
from caseloom.llm.filter_audit import OP13_SQL, op13_filter_audit
from caseloom.llm.fingerprints import op8_fingerprints
from caseloom.llm.language import op1_language_id
from caseloom.llm.mixing import OP2_SQL, op2_mixing
from caseloom.llm.ngram_join import op7_ngram_join
from caseloom.llm.packing import op10_best_fit_packing
from caseloom.llm.privacy import op4_personal_data
from caseloom.llm.sharding import op12_sharding
from caseloom.llm.substrings import op6_substring_dedup
from caseloom.llm.token_counts import op9_token_counts
from caseloom.llm.toxicity import op5_toxicity
from caseloom.llm.turn_repair import op11_turn_repair

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_nearest": op3_nearest,
    "op4_personal_data": op4_personal_data,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_turn_repair": op11_turn_repair,
    "op12_sharding": op12_sharding,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": OP2_SQL,
    "op13_filter_audit": OP13_SQL,
}
