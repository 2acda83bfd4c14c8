import math

from pyspark.sql import functions as F

from quarry.operators.aggs import (count_rows, date_histogram, stats_metric, terms_agg,
                                   top_keys_then)
from quarry.operators.search import bm25_score, hits_total, search


def test_quarter_histogram_fills_gaps(spark):
    df = spark.createDataFrame([("2020-01-05",), ("2020-11-05",)], "d string").withColumn("d", F.to_timestamp("d"))
    got = [r.doc_count for r in date_histogram(df, "d", unit="quarter").orderBy("bucket").collect()]
    assert got == [1, 0, 0, 1]


def test_terms_agg_order_and_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "k string")
    rows = [(r.k, r.doc_count) for r in terms_agg(df, "k", size=2).collect()]
    assert rows == [("a", 2), ("b", 2)]
    assert terms_agg(df, "k", size=None).count() == 3


def test_terms_agg_array_counts_documents(spark):
    df = spark.createDataFrame([(["x", "x", "y"],), (["x"],)], "t array<string>")
    rows = {r.t: r.doc_count for r in terms_agg(df, "t", array=True).collect()}
    assert rows == {"x": 2, "y": 1}


def test_stats_metric(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    r = {x.k: x for x in terms_agg(df, "k", stats_metric("v", "v")).collect()}
    assert (r["a"].v_count, r["a"].v_min, r["a"].v_max, r["a"].v_avg, r["a"].v_sum) == (2, 1.0, 3.0, 2.0, 4.0)
    assert r["b"].v_count == 0 and r["b"].doc_count == 1


def test_date_histogram_zero_fill_per_key(spark):
    rows = [("a", "2020-01-15"), ("a", "2020-04-02"), ("b", "2021-06-30"), ("a", "2020-01-20")]
    df = spark.createDataFrame(rows, "k string, d string").withColumn("ts", F.to_timestamp("d"))
    out = sorted((r.k, r.bucket.strftime("%Y-%m"), r.doc_count)
                 for r in date_histogram(df, "ts", by=["k"]).collect())
    assert out == [("a", "2020-01", 2), ("a", "2020-02", 0), ("a", "2020-03", 0),
                   ("a", "2020-04", 1), ("b", "2021-06", 1)]
    # counts sum to the documents per bucket key
    assert sum(x[2] for x in out) == df.count()


def test_top_keys_then_limits_outer(spark):
    df = spark.createDataFrame([(k, 1) for k in "aaabbc"], "k string, v int")
    out = top_keys_then(df, "k", lambda d: d.groupBy("k").count(), size=2)
    assert sorted(r.k for r in out.collect()) == ["a", "b"]


def test_counts(spark):
    df = spark.range(7)
    assert count_rows(df).first()["count"] == 7
    assert hits_total(df, F.col("id") > 4).first()["total"] == 2


def test_bm25_against_brute_force(spark):
    docs = [(1, "fix the fix"), (2, "fix"), (3, "nothing here at all"), (4, "a fix for the bug here")]
    df = spark.createDataFrame(docs, "id int, text string")
    got = {r.id: r._score for r in search(df, "fix bug", "text", "id", k=10).collect()}
    toks = {i: t.split() for i, t in docs}
    n = len(docs)
    avgdl = sum(len(t) for t in toks.values()) / n
    want = {}
    for i, t in toks.items():
        s = 0.0
        for q in ["fix", "bug"]:
            tf = t.count(q)
            dfreq = sum(q in x for x in toks.values())
            idf = math.log(1 + (n - dfreq + 0.5) / (dfreq + 0.5))
            s += idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(t) / avgdl))
        if s > 0:
            want[i] = s
    assert set(got) == set(want)
    for i in want:
        assert abs(got[i] - want[i]) < 1e-9


def test_search_plan_is_top_k_without_python(spark):
    df = spark.createDataFrame([(1, "fix")], "id int, text string")
    plan = search(df, "fix", "text", "id", k=3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
