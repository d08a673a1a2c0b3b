"""All catalog queries and their oracles, by name."""

from __future__ import annotations

from shelfspark.plans import business, catalog, checks, extraction, scalars

MODULES = (scalars, catalog, business, extraction, checks)
QUERIES: dict = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES: dict = {k: s for m in MODULES for k, s in m.ORACLES.items()}
