"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from poiweave.llm import (
    byte_bpe,
    importance,
    lm_trie,
    mixing,
    mjpeg,
    near_dedup,
    quality_rules,
    secrets_crf,
    token_store,
    url_filter,
)

QUERIES = {
    "op1_importance_resampling": importance.op1_query,
    "op2_minhash_odd_sketch": near_dedup.op2_query,
    "op3_avi_mjpeg": mjpeg.op3_query,
    "op4_elias_fano_lm": lm_trie.op4_query,
    "op5_byte_bpe": byte_bpe.op5_query,
    "op6_secret_crf": secrets_crf.op6_query,
    "op7_url_filter": url_filter.op7_query,
    "op8_poisson_mix": mixing.op8_query,
    "op9_quality_rules": quality_rules.op9_query,
    "op10_zstd_token_store": token_store.op10_query,
}

ORACLE_SQL = {
    "op2_minhash_odd_sketch": near_dedup.OP2_SQL,
    "op7_url_filter": url_filter.OP7_SQL,
}
