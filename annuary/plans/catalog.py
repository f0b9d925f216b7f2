"""All core queries and their SQL."""

from __future__ import annotations

from annuary.plans import bridge_queries, check_queries, panel_queries, pipeline_queries, problems

_MODULES = (panel_queries, bridge_queries, check_queries, pipeline_queries, problems)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: query for m in _MODULES for name, query in m.ORACLE.items()}
