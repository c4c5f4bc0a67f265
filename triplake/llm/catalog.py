"""The registered queries of this folder's operators and their DuckDB SQL."""

from __future__ import annotations

import importlib

MODULES = ("host_quality", "suffix_dedup", "best_fit_packing", "secret_scan", "exact_dedup", "token_counts",
           "minhash_dedup", "pii_pseudonyms", "source_mixing", "repair_tokens", "merkle_manifest",
           "vector_codes", "html_extraction")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"triplake.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
