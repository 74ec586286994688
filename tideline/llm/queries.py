"""Imports every operator module, which registers its query."""

from __future__ import annotations

import importlib

from tideline.llm.registry import LLM_ORACLES, LLM_QUERIES

MODULES = ("op1_line_frequency", "op2_disclosure", "op3_cnn_toxicity", "op4_consensus_html", "op5_poisson_mixing", "op6_trigram_secrets",
           "op7_covering_simhash", "op8_wfst_pieces", "op9_itq_embeddings", "op10_license_classifier", "op11_angular_negatives", "op12_plane_files", "op13_polarised_whitening")

for _module in MODULES:
    importlib.import_module(f"tideline.llm.{_module}")

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
