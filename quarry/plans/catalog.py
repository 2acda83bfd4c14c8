"""All registered queries and oracle SQL, gathered from the topic modules."""

from __future__ import annotations

from quarry.plans import agg_queries, ingest_queries, search_queries, source_queries


def _modules():
    return [search_queries, agg_queries, ingest_queries, source_queries]


def queries() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.ORACLE)
    return out
