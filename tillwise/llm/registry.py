"""Queries of this subpackage, and the statements that check those SQL can express."""

from __future__ import annotations

import corpus_pipeline
from tillwise.llm import (
    collocations, decontaminate, fim, htmltext, langid, linededup, minhash, mixing, ngrams, pii, sharding, simhash, toxicity,
)

QUERIES = {
    "op1_crf_pii": pii.op1_crf_pii,
    "op2_ring_shards": sharding.op2_ring_shards,
    "op3_prefix_decontaminate": decontaminate.op3_prefix_decontaminate,
    "op4_backoff_scores": ngrams.op4_backoff_scores,
    "op5_suffix_line_dedup": linededup.op5_suffix_line_dedup,
    "op6_tree_mix": mixing.op6_tree_mix,
    "op7_simhash_trie": simhash.op7_simhash_trie,
    "op8_ppm_language": langid.op8_ppm_language,
    "op9_fm_toxicity": toxicity.op9_fm_toxicity,
    "op10_minhash_prints": minhash.op10_minhash_prints,
    "op10_near_duplicates": minhash.op10_near_duplicates,
    "op11_collocations": collocations.op11_collocations,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_main_text": htmltext.op13_main_text,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op3_prefix_decontaminate": decontaminate.SQL,
    "op5_suffix_line_dedup": linededup.SQL,
    "op11_collocations": collocations.SQL,
    "op12_fill_in_middle": fim.SQL,
}
