"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from lakeaudit.llm import codes, collocations, language, neardup, packing, pieces, pii, quality, sharding, substrings, suffixes, topk, urls

QUERIES = {
    "op1_lstm_crf_pii": pii.op1,
    "op2_rendezvous_shards": sharding.op2,
    "op3_host_rules": quality.op3,
    "op4_block_anchors": substrings.op4,
    "op5_temporal_lists": urls.op5,
    "op6_shared_prefix": pieces.op6,
    "op7_language_families": language.op7,
    "op8_bin_completion": packing.op8,
    "op9_odd_sketches": neardup.op9,
    "op10_tiled_top_k": topk.op10,
    "op11_two_stage_suffixes": suffixes.op11,
    "op12_gnat_codes": codes.op12,
    "op13_stripes": collocations.op13,
}

ORACLES = {
    "op3_host_rules": quality.OP3_SQL,
    "op4_block_anchors": substrings.OP4_SQL,
    "op5_temporal_lists": urls.OP5_SQL,
    "op10_tiled_top_k": topk.OP10_SQL,
    "op12_gnat_codes": codes.OP12_SQL,
    "op13_stripes": collocations.OP13_SQL,
}
