"""Registered queries of this package and the DuckDB SQL of those that SQL can express.

op3 (spaced seeds), op7 (components), op8, op9 and op10 (trained models) have no SQL;
tests/llm holds them against brute-force versions and held-out labels. op6 and op12 (all
pairs with a common shingle), op11 (a join on prefixes of spelled-out keys) and op13
(recursive levels and folds) have SQL that suits small tables.
"""

from __future__ import annotations

from tarmac.llm import (
    decontam, html, langid, license, merkle, mixing, neardup, ngramjoin, pii, quality, trie, urlfilter, warc,
)

QUERIES = {
    "op1_host_quality": quality.query,
    "op2_license_scan": license.query,
    "op3_decontamination": decontam.query,
    "op4_source_mixing": mixing.query,
    "op5_warc_revisits": warc.query,
    "op6_near_duplicates": neardup.query,
    "op7_url_filter": urlfilter.query,
    "op8_main_text": html.query,
    "op9_language": langid.query,
    "op10_personal_data": pii.query,
    "op11_prefix_trie": trie.query,
    "op12_ngram_join": ngramjoin.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLE = {
    "op1_host_quality": quality.ORACLE,
    "op2_license_scan": license.ORACLE,
    "op4_source_mixing": mixing.ORACLE,
    "op5_warc_revisits": warc.ORACLE,
    "op6_near_duplicates": neardup.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op12_ngram_join": ngramjoin.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
