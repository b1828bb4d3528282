"""The queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from . import (decontaminate, exact_dedup, fingerprints, hard_negatives, jaccard_join, langid, lexical_search, line_dedup, packing, secrets,
               suffix_dedup, toxicity, warc)

MODULES = {
    "op1_line_dedup": line_dedup,
    "op2_fingerprints": fingerprints,
    "op3_decontaminate": decontaminate,
    "op4_secret_scan": secrets,
    "op5_warc": warc,
    "op6_suffix_dedup": suffix_dedup,
    "op7_packing": packing,
    "op8_language_id": langid,
    "op9_toxicity": toxicity,
    "op10_ngram_join": jaccard_join,
    "op11_hard_negatives": hard_negatives,
    "op12_ranked_search": lexical_search,
    "op13_exact_dedup": exact_dedup,
}


def queries():
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql():
    return {name: module.SQL for name, module in MODULES.items() if module.SQL}
