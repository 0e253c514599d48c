"""All queries of the core with their SQL, by name."""

from __future__ import annotations

import importlib.util

_NAMES = ("evaluation", "records", "scalars", "ingest", "health", "curation", "drawing", "numeric", "stateful")
_MODULES = [importlib.import_module(f"marlstone.plans.{n}") for n in _NAMES if importlib.util.find_spec(f"marlstone.plans.{n}")]
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: f for m in _MODULES for k, f in m.ORACLE.items()}
