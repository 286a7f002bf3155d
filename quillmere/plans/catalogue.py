"""All queries and oracles outside the optional subpackage."""

from __future__ import annotations

from . import entity_queries, file_queries, problems, progress_queries, report_queries, stat_queries, text_queries

MODULES = [problems]
REGISTRIES = [text_queries.R, entity_queries.R, stat_queries.R, report_queries.R, progress_queries.R, file_queries.R]


def queries():
    return {k: v for m in MODULES for k, v in m.QUERIES.items()} | {k: v for r in REGISTRIES for k, v in r.queries.items()}


def oracles():
    return {k: v for m in MODULES for k, v in m.ORACLES.items()} | {k: v for r in REGISTRIES for k, v in r.oracles.items()}
