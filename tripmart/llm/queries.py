"""The queries of this package and their SQL, where SQL can state them."""

from __future__ import annotations

from tripmart.llm import (
    collocations, decontaminate, html_text, language, licenses, packing, pii, prefix_trie, quality, simhash, substrings, url_filter, warc,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_language_model": language.op2_language_model,
    "op3_substring_dedup": substrings.op3_substring_dedup,
    "op4_packing": packing.op4_packing,
    "op5_warc": warc.op5_warc,
    "op6_html_text": html_text.op6_html_text,
    "op7_simhash": simhash.op7_simhash,
    "op8_quality": quality.op8_quality,
    "op9_benchmark_passages": decontaminate.op9_benchmark_passages,
    "op10_licenses": licenses.op10_licenses,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_collocations": collocations.op12_collocations,
    "op13_url_filter": url_filter.op13_url_filter,
}
ORACLES = {
    "op1_pii": pii.ORACLE,
    "op3_substring_dedup": substrings.ORACLE,
    "op5_warc": warc.ORACLE,
    "op9_benchmark_passages": decontaminate.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_url_filter": url_filter.ORACLE,
}
