"""The queries of this package and the SQL they are checked against."""

from __future__ import annotations

from triplens.llm import angular, ann, exact, html, jaccard, language, orc_tokens, packing, pieces, pii, substrings, trie, warc

QUERIES = {
    "op10_warc": warc.op10_warc,
    "op11_orc_tokens": orc_tokens.op11_orc_tokens,
    "op12_hard_negatives": angular.op12_hard_negatives,
    "op13_prefix_trie": trie.op13_prefix_trie,
    "op1_language_id": language.op1_language_id,
    "op2_multi_index": ann.op2_multi_index,
    "op3_pii": pii.op3_pii,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_html_labeller": html.op6_html_labeller,
    "op7_packing": packing.op7_packing,
    "op8_exact_dedup": exact.op8_exact_dedup,
    "op9_sentencepiece": pieces.op9_sentencepiece,
}

ORACLES = {
    "op13_prefix_trie": trie.OP13_SQL,
    "op12_hard_negatives": angular.OP12_SQL,
    "op4_ngram_jaccard": jaccard.OP4_SQL,
    "op8_exact_dedup": exact.OP8_SQL,
}
