"""Registry of the library's own queries and their DuckDB oracles."""

from __future__ import annotations

from sieveline.plans import differences, evidence, extracts, flows, measure

QUERIES: dict = {}
ORACLES: dict = {}
for _part in (measure, differences, flows, evidence, extracts):
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES
