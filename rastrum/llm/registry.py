"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

_MODULES = {
    "op1_ngram_jaccard": "ngram_jaccard",
    "op3_html_text": "html_text",
    "op4_substring_dedup": "substring_dedup",
    "op5_url_filters": "url_filters",
    "op8_decontamination": "decontamination",
    "op2_toxicity": "toxicity",
    "op9_language_id": "language_id",
    "op6_quality_rules": "quality_rules",
    "op7_token_counts": "token_counts",
    "op10_packing": "packing",
    "op11_hard_negatives": "hard_negatives",
    "op12_periodic_runs": "periodic_runs",
    "op13_quality_classifier": "quality_classifier",
}


def queries() -> dict:
    return {name: importlib.import_module(f".{module}", __package__).query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(importlib.import_module(f".{module}", __package__), "ORACLE_SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
