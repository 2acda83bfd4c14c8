
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.analysis import path_tokens, text_tokens
from quarry.functions.predicates import at_least, not_
from quarry.operators.aggs import date_histogram
from quarry.operators.ingest import upsert

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ALPHABET = "abcXYZ019 .,;:/-_\n\téÉñÑüß"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=8)


def _python_tokens(s):
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", s.lower()) if t]


@SETTINGS
@given(texts)
def test_text_tokens_match_reference_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.t for r in df.select("i", text_tokens("v").alias("t")).collect()}
    assert got == {i: _python_tokens(v) for i, v in enumerate(values)}


@SETTINGS
@given(st.lists(st.text(alphabet="ab/.", max_size=12), min_size=1, max_size=8))
def test_path_tokens_are_nested_prefixes(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    for r in df.select("i", path_tokens("v").alias("t")).collect():
        src = values[r.i].lower()
        parts = src.split("/")
        want = [x for x in ("/".join(parts[:k]) for k in range(1, len(parts) + 1)) if x]
        assert r.t == want
        assert all(b.startswith(a) for a, b in zip(r.t, r.t[1:]))


bools = st.lists(st.tuples(st.sampled_from([True, False, None]), st.sampled_from([True, False, None]),
                           st.sampled_from([True, False, None])), min_size=1, max_size=12)


@SETTINGS
@given(bools)
def test_at_least_and_not(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a boolean, b boolean, c boolean")
    ps = [F.col("a"), F.col("b"), F.col("c")]

    def ids(pred):
        return {r.i for r in df.where(pred).select("i").collect()}

    assert ids(at_least(ps, 1)) == ids(F.coalesce(ps[0] | ps[1] | ps[2], F.lit(False)))
    assert ids(at_least(ps, 3)) == ids(F.coalesce(ps[0] & ps[1] & ps[2], F.lit(False)))
    every = set(range(len(rows)))
    assert ids(ps[0]) | ids(not_(ps[0])) == every
    assert not (ids(ps[0]) & ids(not_(ps[0])))


changes = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 99)),
                   min_size=1, max_size=15)


@SETTINGS
@given(changes, changes)
def test_upsert_idempotent_and_newest_wins(spark, base_rows, change_rows):
    schema = "k int, v int, x int"
    base = spark.createDataFrame(base_rows, schema)
    ch = spark.createDataFrame(change_rows, schema)
    once = upsert(base, ch, "k", ["v", "x"])
    twice = upsert(once, ch, "k", ["v", "x"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    best = {}
    for k, v, x in base_rows + change_rows:
        best[k] = max(best.get(k, (v, x)), (v, x))
    assert a == sorted((k, v, x) for k, (v, x) in best.items())


dates = st.lists(st.tuples(st.sampled_from("pq"), st.integers(0, 40)), min_size=1, max_size=20)


@SETTINGS
@given(dates)
def test_histogram_sums_and_contiguous(spark, rows):
    df = spark.createDataFrame(rows, "k string, m int") \
              .withColumn("ts", F.expr("timestamp_ntz'2020-01-15 10:00:00' + make_interval(0, m)"))
    out = date_histogram(df, "ts", by=["k"]).collect()
    assert sum(r.doc_count for r in out) == len(rows)
    for key in {k for k, _ in rows}:
        months = sorted((r.bucket.year * 12 + r.bucket.month) for r in out if r.k == key)
        assert months == list(range(months[0], months[-1] + 1))
        used = {m for k, m in rows if k == key}
        assert len(months) == max(used) - min(used) + 1
