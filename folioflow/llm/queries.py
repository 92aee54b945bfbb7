"""All queries of the llm subpackage by name."""

from __future__ import annotations

from . import golden, history, leaks, linkage, mixture, names, spans

PARTS = (golden, history, linkage, names, leaks, mixture, spans)
QUERIES = {k: v for m in PARTS for k, v in m.QUERIES.items()}
SQL = {k: v for m in PARTS for k, v in m.SQL.items()}
