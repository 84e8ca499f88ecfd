"""The registered queries of this subpackage and their DuckDB SQL (operators that SQL can express)."""

from __future__ import annotations

from . import align, decontaminate, html, jaccard, langid, mixing, quality, substrings, suffixes, topk, trie, urls, warc

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_suffix_dedup": suffixes.op2_suffix_dedup,
    "op3_substring_dedup": substrings.op3_substring_dedup,
    "op4_exact_top_k": topk.op4_exact_top_k,
    "op5_language_id": langid.op5_language_id,
    "op6_url_filter": urls.op6_url_filter,
    "op7_ngram_jaccard": jaccard.op7_ngram_jaccard,
    "op8_mixing": mixing.op8_mixing,
    "op9_html_text": html.op9_html_text,
    "op10_quality": quality.op10_quality,
    "op11_warc_archive": warc.op11_warc_archive,
    "op12_token_alignment": align.op12_token_alignment,
    "op13_conversation_trie": trie.op13_conversation_trie,
}

ORACLE_SQL = {
    "op4_exact_top_k": topk.ORACLE_SQL,
    "op6_url_filter": urls.ORACLE_SQL,
    "op8_mixing": mixing.ORACLE_SQL,
    "op11_warc_archive": warc.ORACLE_SQL,
    "op13_conversation_trie": trie.ORACLE_SQL,
}
