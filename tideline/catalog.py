"""All registered queries and their SQL twins."""

from __future__ import annotations

import importlib

from tideline.plans.registry import ORACLES, QUERIES

MODULES = ("market", "technical", "risk", "tables", "ingest", "social", "learning", "live", "flows")

for _module in MODULES:
    importlib.import_module(f"tideline.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
