"""Registered queries of the package and their SQL twins."""

from __future__ import annotations

from quizlog.llm import (
    best_fit_packing,
    chat_format,
    decontaminate,
    html_extract,
    language_id,
    license_scan,
    lm_scoring,
    oracles,
    prefix_trie,
    quality_rules,
    ranked_search,
    simhash_dedup,
    token_output,
    url_filter,
)

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_lm_scoring": lm_scoring.query,
    "op3_language_id": language_id.query,
    "op4_html_extract": html_extract.query,
    "op5_chat_format": chat_format.query,
    "op6_license_scan": license_scan.query,
    "op7_token_output": token_output.query,
    "op8_best_fit_packing": best_fit_packing.query,
    "op9_simhash_near_dedup": simhash_dedup.query,
    "op10_quality_rules": quality_rules.query,
    "op11_url_filter": url_filter.query,
    "op12_ranked_search": ranked_search.query,
    "op13_prefix_trie": prefix_trie.query,
}

#: DuckDB twins, where SQL can express the query.
ORACLE: dict[str, str] = dict(oracles.ORACLE)
