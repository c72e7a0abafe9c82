"""Every query of the text operators with its SQL, where SQL can express it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("line_dedup", "exact_dedup", "fingerprints", "license_scan", "simhash", "packing", "suffix_dedup",
           "language_id", "byte_bpe", "quality", "vector_approximation", "spelling_variants",
           "token_alignment")


def all_queries() -> dict:
    found: dict = {}
    for name in MODULES:
        found.update(import_module(f"tidemill.llm.{name}").QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found.update(import_module(f"tidemill.llm.{name}").ORACLES)
    return found
