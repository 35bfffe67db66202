"""Registered queries of this package and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("q_survivor", "q_components", "q_leakage", "q_mixture", "q_encoding", "q_variants", "q_linkage")

_loaded = [importlib.import_module(f"corvane.llm.{m}") for m in MODULES]
QUERIES = {k: q for m in _loaded for k, q in m.QUERIES.items()}
SQL = {k: s for m in _loaded for k, s in m.SQL.items()}
