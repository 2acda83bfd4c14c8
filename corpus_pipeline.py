"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is written as Parquet below the shared checkpoint folder and read again as the
next one's documents, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import stored, table
from quarry.llm.exact_dedup import unique_documents
from quarry.llm.language import documents_in_a_language
from quarry.llm.mixing import mixed_documents
from quarry.llm.ngram_join import distinct_documents
from quarry.llm.packing import packed_documents

STAGES = [
    ("language_id", documents_in_a_language),
    ("exact_dedup", unique_documents),
    ("ngram_jaccard_join", distinct_documents),
    ("mixing", mixed_documents),
    ("best_fit_packing", packed_documents),
]

# Language ID learns a model, which SQL cannot express; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the result is the last stage's packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
