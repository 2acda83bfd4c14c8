"""The stored text index: one shuffle of the texts, segments of bounded size, no text moved for hits."""

import glob

import pytest
from pyspark.sql import functions as F

from quarry.operators.postings import (bm25_postings, doc_lengths, docs_with_ids, match_postings, postings, top_page,
                                       write_impacts, write_postings)
from quarry.plans import common


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """As with large tables: Spark does not broadcast by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _stored(spark, path, rows, schema="doc_id long, text string, source string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_first_page_moves_no_texts(spark, tmp_dir, no_broadcast):
    rows = [(i // 2, "common " * (1 + i % 5) + "filler " * (i % 40), f"s{i % 7}") for i in range(600)]  # every id twice
    docs = _stored(spark, f"{tmp_dir}/d", rows)
    post, lengths = postings(docs, "doc_id", "text"), doc_lengths(docs, "doc_id", "text")
    write_impacts(post, lengths, f"{tmp_dir}/i")
    best = {r.doc_id: r.s for r in bm25_postings(post, lengths, ["common"]).select("doc_id", F.round("_score", 6).alias("s")).collect()}
    for source in (None, "s3", "none"):
        keep = None if source is None else F.col("source") == source
        got = top_page(spark, f"{tmp_dir}/i", ["common"], digits=6, docs=docs, keep=keep)
        want = sorted((-best[i], i) for i, _, s in rows if source in (None, s))[:10]
        assert [(-r._score, r.doc_id) for r in got.collect()] == want
        assert got.columns == ["doc_id", "text", "source", "_score"]
        assert "hashpartitioning(doc_id" not in _plan(got) and "SortMergeJoin" not in _plan(got)


def test_segments_are_written_without_a_shuffle(spark, tmp_dir):
    docs = spark.createDataFrame([(i % 50, f"the word{i} the") for i in range(60)], "doc_id long, text string")  # ids repeat
    post = postings(docs.repartition(6, "doc_id"), "doc_id", "text")
    assert _plan(post).count("Exchange") == 1
    write_postings(post, f"{tmp_dir}/p")
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, postings(docs, "doc_id", "text").collect()))
    assert back.where("token = 'the'").select(F.input_file_name()).distinct().count() > 1


def test_segments_follow_the_number_of_words(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(common, "SEGMENT_WORDS", 100)
    for name, step in (("one", 1), ("twice", 2)):  # unique and repeated ids
        docs = _stored(spark, f"{tmp_dir}/{name}/documents.parquet", [(i // step, "w%d the the end" % (i % 9), "s") for i in range(1000)])
        post, lengths = common.text_index(spark, f"{tmp_dir}/{name}")
        assert sorted(map(tuple, post.collect())) == sorted(map(tuple, postings(docs, "doc_id", "text").collect()))
        assert lengths.count() == 1000
        assert 30 < len(glob.glob(f"{common.text_index_path(spark, f'{tmp_dir}/{name}').removeprefix('file:')}/postings/part-*")) <= 40


def test_hits_are_fetched_where_they_are(spark, tmp_dir, no_broadcast):
    docs = _stored(spark, f"{tmp_dir}/d", [(i // 2, "fix" if i % 3 else "no", "s") for i in range(90)])
    ids = match_postings(postings(docs, "doc_id", "text"), ["fix"])
    near, far = docs_with_ids(docs, ids), docs_with_ids(docs, ids, broadcast_ids=3)
    assert "BroadcastHashJoin" in _plan(near) and "SortMergeJoin" in _plan(far)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.collect()))
    assert near.count() == sum(1 for i in range(90) if (2 * (i // 2)) % 3 or (2 * (i // 2) + 1) % 3)
