"""The registered query catalogue: Spark plans and their DuckDB oracle SQL."""

from quarry.plans.catalog import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
