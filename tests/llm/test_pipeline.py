"""The pipeline against a brute-force version of its stages."""

import collections
import re

import corpus_pipeline
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_operators import ODD, brute_components, saved

from quarry.llm.mixing import word_count


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    found = stages["language_id"](spark, docs, SF_SMALL)
    assert found.columns == columns
    assert {r.doc_id for r in found.collect()} == {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}

    unique = stages["exact_dedup"](spark, docs, SF_SMALL)
    first = {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == set(first.values())

    near = stages["ngram_jaccard_join"](spark, docs, SF_SMALL)
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert near.columns == columns and {r.doc_id for r in near.collect()} == {i for i, (_, c) in want.items() if i == c}

    mixed = stages["mixing"](spark, docs, SF_SMALL)
    total = docs.agg(F.sum(word_count(F.col("text")))).first()[0]
    assert mixed.columns == columns
    assert abs(mixed.agg(F.sum(word_count(F.col("text")))).first()[0] - 1.5 * total) <= 20


def test_run_packs_what_the_stages_keep(spark):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    loads = collections.Counter()
    for r in got:
        loads[r.sequence_id] += r.length
    assert got and max(loads.values()) <= 2048
    assert len(loads) <= 1.02 * sum(loads.values()) / 2048 + 1


def test_run_on_odd_rows(spark, tmp_dir):
    saved(spark, tmp_dir, ODD)
    assert corpus_pipeline.run(spark, tmp_dir).count() > 0
