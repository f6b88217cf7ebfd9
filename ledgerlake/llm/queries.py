"""The registered queries of this package and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ledgerlake.llm import (
    exact_dedup,
    hard_negatives,
    lm_scoring,
    minhash_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_rules,
    resampling,
    sharding,
    suffix_dedup,
    toxicity,
)

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_pii": pii.op3_pii,
    "op4_sharding": sharding.op4_sharding,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_packing": packing.op9_packing,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_minhash_dedup": minhash_dedup.op11_minhash_dedup,
    "op12_resampling": resampling.op12_resampling,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE = {
    "op8_mixing": mixing.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op12_resampling": resampling.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
