"""The registered queries of the text operators, and their SQL for DuckDB."""

from ledgerline.llm import (
    conversation_trie,
    decontamination,
    hard_negatives,
    imatch,
    line_dedup,
    lm_score,
    mixing,
    quality,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
)

QUERIES = {
    "op1_decontamination": decontamination.query,
    "op2_secrets": secrets.query,
    "op3_sharding": sharding.query,
    "op4_line_dedup": line_dedup.query,
    "op5_mixing": mixing.query,
    "op6_lm_score": lm_score.query,
    "op7_imatch": imatch.query,
    "op8_toxicity": toxicity.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_simhash": simhash.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_quality": quality.query,
    "op13_conversation_trie": conversation_trie.query,
}

ORACLE_SQL = {
    "op4_line_dedup": line_dedup.SQL,
    "op5_mixing": mixing.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op13_conversation_trie": conversation_trie.SQL,
}
