"""All queries of the library's core, by name."""

from __future__ import annotations

from isolake.plans import analysis, further, io, more, problems, relational

MODULES = (problems, relational, analysis, io, more, further)
FLAGSHIP = "s158_fisher_scan"


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
