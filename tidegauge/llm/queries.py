"""Registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from tidegauge.llm import (
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    neighbours,
    packing,
    prefix_trie,
    quotation_threads,
    sentence_pieces,
    sharding,
    simhash_trees,
    spelling_variants,
    token_counts,
)

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_jaccard_join": jaccard_join.query,
    "op3_quotation_threads": quotation_threads.query,
    "op4_sentence_pieces": sentence_pieces.query,
    "op5_packing": packing.query,
    "op6_fingerprints": fingerprints.query,
    "op7_sharding": sharding.query,
    "op8_neighbours": neighbours.query,
    "op9_line_dedup": line_dedup.query,
    "op10_language_id": language_id.query,
    "op11_simhash_trees": simhash_trees.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_spelling_variants": spelling_variants.query,
}
ORACLES = {
    "op3_quotation_threads": quotation_threads.SQL,
    "op7_sharding": sharding.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_spelling_variants": spelling_variants.SQL,
}
