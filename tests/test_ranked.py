"""Stemmed matching, compound ranked pages, any-field search in nested columns, nested buckets."""

import datetime

from pyspark.sql import functions as F

from quarry.functions.predicates import any_field, bool_query, match, term
from quarry.functions.stem import porter_stem
from quarry.operators.aggs import nested_buckets
from quarry.operators.search import Clause, ranked_page, search
from quarry.operators.stemming import EnglishAnalyzer, english_analyzer
from test_stem import PAIRS


def _docs(spark):
    return spark.createDataFrame(
        [(1, "Fixed the tests", "a"), (2, "fixing bugs", "b"), (3, "the fixture", "a"), (4, None, "a"), (5, "", "b"),
         (6, "a bug, a fix, a FIX", "c")], "id long, text string, src string")


def test_stemmed_match_in_bool_query(spark):
    docs = _docs(spark)
    hits = docs.where(bool_query(must=[match("text", "fix", english_analyzer)], must_not=[term("src", "b")]))
    assert sorted(r.id for r in hits.collect()) == [1, 6]
    both = docs.where(match("text", "bugs fixes", english_analyzer, operator="and"))
    assert sorted(r.id for r in both.collect()) == [2, 6]
    assert docs.where(match("text", "the", english_analyzer)).count() == 0
    assert docs.where(match("text", "the", EnglishAnalyzer(stop_words=()))).count() == 2


def test_every_word_holds_the_common_part_of_its_stem():
    for w in PAIRS:
        assert EnglishAnalyzer.common_part(porter_stem(w)) in w


def test_the_cheap_test_runs_before_the_stems(spark):
    plan = _docs(spark).where(match("text", "fix", english_analyzer))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_ranked_page_of_one_clause_is_search(spark):
    docs = _docs(spark)
    one = ranked_page(docs, [Clause("text", "fix bug")], "id", digits=9).collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in search(docs, "fix bug", "text", "id", digits=9).collect()]


def test_ranked_page_adds_clauses_and_filters_without_scoring(spark):
    docs = _docs(spark)
    stem = Clause("text", "fix", english_analyzer)
    plain = {r.id: r._score for r in ranked_page(docs, [stem], "id").collect()}
    assert set(plain) == {1, 2, 6}
    more = {r.id: r._score for r in ranked_page(docs, [stem, Clause("src", "c", required=False)], "id").collect()}
    assert set(more) == set(plain) and more[6] > plain[6] and abs(more[1] - plain[1]) < 1e-12
    some = {r.id: r._score for r in ranked_page(docs, [stem], "id", filter=[F.col("src") != "b"]).collect()}
    assert some == {i: plain[i] for i in (1, 6)}
    assert {r.id for r in ranked_page(docs, [Clause("src", "c", required=False)], "id").collect()} == {6}
    assert ranked_page(docs, [Clause("text", "absent")], "id").count() == 0


def test_any_field_reads_arrays_structs_and_maps(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, array('src/fix.py'), array(named_struct('patch', 'x', 'n', 1)), map('k', 'y')),
        (2, array('a'), array(named_struct('patch', 'the fix', 'n', 1)), map('k', 'y')),
        (3, array('a'), array(named_struct('patch', 'x', 'n', 1)), map('fix', 'a fix')),
        (4, NULL, NULL, NULL) AS t(id, files, diffs, notes)""")
    assert sorted(r.id for r in df.where(any_field(df, "fix")).collect()) == [1, 2, 3]
    assert sorted(r.id for r in df.where(any_field(df, "fix", exclude=["diffs.patch"])).collect()) == [1, 3]


def test_nested_buckets_keep_undated_keys(spark):
    day = datetime.datetime(2020, 1, 5)
    df = spark.createDataFrame([("a", None, 1)] * 3 + [("b", day, 5), ("b", None, 6)], "k string, t timestamp, v long")
    got = {(r.k, r.outer_doc_count, r.total, r.doc_count) for r in nested_buckets(df, "k", "t", [F.sum("v").alias("total")]).collect()}
    assert got == {("a", 3, 3, None), ("b", 2, 11, 1)}


def _rows_scanned(df):
    """Rows that the scans of a finished plan read, from its metrics."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif name.endswith("QueryStage"):
            walk(node.plan())
        elif name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
    walk(plan)
    return sum(found)


def test_top_page_reads_the_tops_of_its_lists(spark, tmp_dir):
    from quarry.operators.postings import TopPage, bm25_postings, doc_lengths, postings, top_page, write_impacts
    rows = [(i, "common " * (1 + i % 7) + f"word{i % 50} " + "filler " * (i % 90)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    post, lengths = postings(docs, "doc_id", "text").cache(), doc_lengths(docs, "doc_id", "text").cache()
    write_impacts(post, lengths, f"{tmp_dir}/i", partitions=4, page_rows=100)
    for tokens in (["common"], ["common", "word3"], ["word3", "word4", "word3"], ["nothing"], ["common", "nothing"]):
        best = bm25_postings(post, lengths, tokens).select("doc_id", F.round("_score", 6).alias("s")).collect()
        want = sorted(((r.doc_id, r.s) for r in best), key=lambda x: (-x[1], x[0]))[:10]
        got = top_page(spark, f"{tmp_dir}/i", tokens, digits=6).collect()
        assert [(r.doc_id, r._score) for r in got] == want, tokens
    index = TopPage(spark, f"{tmp_dir}/i", ["common"])
    assert index.hits == 6000 and _rows_scanned(index.scored(10, 1e-6)[0]) < 1500
    # a filter that drops the best hits: further postings are asked for
    some = docs.select("doc_id", (F.col("doc_id") % 500 == 7).alias("kept"))
    got = top_page(spark, f"{tmp_dir}/i", ["common"], digits=6, docs=some, keep=F.col("kept")).collect()
    best = {r.doc_id: r.s for r in bm25_postings(post, lengths, ["common"]).select("doc_id", F.round("_score", 6).alias("s")).collect()}
    assert [r.doc_id for r in got] == sorted((i for i in best if i % 500 == 7), key=lambda i: (-best[i], i))[:10]


def test_sql_functions_equal_the_column_helpers(spark):
    from quarry.functions.analysis import path_tokens, text_tokens
    from quarry.functions.predicates import match
    from quarry.functions.sql import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([("Fix the-Parser, ünï",), ("A/b/C.py",), ("",), (None,), ("/x//y",)], "s string")
    df.createOrReplaceTempView("quarry_sql")
    sql = spark.sql("SELECT text_tokens(s) AS a, path_tokens(s) AS b, matches(s, 'parser FIX') AS c, matches_all(s, 'parser fix') AS d FROM quarry_sql").collect()
    own = df.select(text_tokens("s").alias("a"), path_tokens("s").alias("b"), match("s", "parser FIX").alias("c"), match("s", "parser fix", operator="and").alias("d")).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in own]
