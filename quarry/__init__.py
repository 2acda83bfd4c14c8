"""quarry: document search and analytics expressed as Spark DataFrame plans.

Sub-packages:
    functions  -- Column -> Column helpers (analyzers, predicates, projections)
    sources    -- readers: tables, name patterns, typed delimited files, commit records
    operators  -- DataFrame -> DataFrame operators (search, aggregations, ingest, graph)
    streaming  -- Structured Streaming ingest
    plans      -- the registered query catalogue and its DuckDB oracle SQL
"""

from quarry.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
