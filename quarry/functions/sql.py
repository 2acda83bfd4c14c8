"""Analyzers, full-text tests and scores as SQL functions, for conditions written as SQL text (Q1s)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quarry.functions.analysis import WORD_SPLIT
from quarry.operators.search import BM25_B, BM25_K1


def sql_functions() -> dict[str, str]:
    """Name -> signature and body, as after ``CREATE TEMPORARY FUNCTION``. All are SQL expressions that Catalyst inlines."""
    split = WORD_SPLIT.replace("\\", "\\\\")
    tokens = f"filter(split(lower(s), '{split}'), t -> t <> '')"
    return {
        "text_tokens": f"(s STRING) RETURNS ARRAY<STRING> RETURN {tokens}",
        "path_tokens": "(s STRING) RETURNS ARRAY<STRING> RETURN filter(transform(sequence(1, size(split(lower(s), '/'))), "
                       "i -> array_join(slice(split(lower(s), '/'), 1, i), '/')), t -> t <> '')",
        "matches": "(s STRING, query STRING) RETURNS BOOLEAN RETURN arrays_overlap(text_tokens(s), text_tokens(query))",
        "matches_all": "(s STRING, query STRING) RETURNS BOOLEAN RETURN size(text_tokens(query)) > 0 "
                       "AND size(array_except(text_tokens(query), text_tokens(s))) = 0",
        "token_count": "(tokens ARRAY<STRING>, token STRING) RETURNS INT RETURN size(filter(tokens, t -> t = token))",
        "bm25": f"(tf INT, len INT, corpus STRUCT<n: BIGINT, avgdl: DOUBLE, df: BIGINT>) RETURNS DOUBLE RETURN "
                f"ln(1D + (corpus.n - corpus.df + 0.5D) / (corpus.df + 0.5D)) * tf / (tf + {BM25_K1}D * ({1 - BM25_B}D + {BM25_B}D * len / corpus.avgdl))",
        # a generator takes no SQL function, so the expression is written out
        "tokens_of": f"(s STRING) RETURNS TABLE(position INT, token STRING) RETURN SELECT pos, col FROM posexplode({tokens})",
    }


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``sql_functions`` known to the session (again, if they are)."""
    for name, rest in sql_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{rest}")
