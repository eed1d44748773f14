"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

from .hamming import SQL as TOP_K

#: name: (module, function)
PLACES = {
    "op1_pitman_yor": ("pitman_yor", "op1"),
    "op2_toxicity_cnn": ("toxicity", "op2"),
    "op3_nested_secrets": ("secrets", "op3"),
    "op4_token_counts": ("wordpiece", "op4"),
    "op5_compression_bands": ("quality", "op5"),
    "op6_hamming_top_k": ("hamming", "op6"),
    "op7_best_fit_packing": ("packing", "op7"),
    "op8_simhash_pivots": ("simhash", "op8"),
    "op9_pareto_mixing": ("mixing", "op9"),
    "op10_lookup_sharding": ("sharding", "op10"),
}
ORACLES = {"op6_hamming_top_k": TOP_K}


def queries() -> dict:
    return {k: getattr(importlib.import_module(f"{__package__}.{m}"), f) for k, (m, f) in PLACES.items()}
