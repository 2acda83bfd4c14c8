import datetime as dt

from pyspark.sql import functions as F

from quarry.functions.project import (bucket_line, first_present, format_day, hit_line,
                                      parse_date, prefix)
from quarry.operators.ingest import append, create_table, with_generated_id
from quarry.operators.search import search
from quarry.sources.commits import COMMIT_V2, with_computed_columns
from quarry.sources.tables import export, spread


def test_parse_date_formats_and_bad_input(spark):
    df = spark.createDataFrame([("2019-01-02",), ("2019-01-02T03:04:05",), ("2019-01-02 03:04:05",),
                                ("not a date",), (None,)], "s string")
    got = [r.t for r in df.select(parse_date("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2019, 1, 2) and got[1] == dt.datetime(2019, 1, 2, 3, 4, 5)
    assert got[2] == dt.datetime(2019, 1, 2, 3, 4, 5) and got[3] is None and got[4] is None


def test_hit_and_bucket_lines(spark):
    df = spark.createDataFrame([("git", "abc", None, dt.datetime(2020, 5, 6), "Fix it\nmore")],
                               "i string, id string, created timestamp, authored timestamp, d string")
    r = df.select(hit_line("i", F.lit("_doc"), "id", first_present("created", "authored"), "d").alias("l"),
                  bucket_line(F.lit("Ann"), F.lit(3), F.lit(42)).alias("b"),
                  prefix("d", 3).alias("p"), format_day("authored").alias("f")).first()
    assert r.l == "/git/_doc/abc (2020-05-06): Fix it"
    assert r.b == "            Ann:   3 commits changing     42 lines"
    assert (r.p, r.f) == ("Fix", "2020-05-06")


def test_filter_does_not_change_scores(spark):
    df = spark.createDataFrame([(1, "fix a", "x"), (2, "fix b fix", "y"), (3, "c", "x")],
                               "id int, text string, g string")
    full = {r.id: r._score for r in search(df, "fix", "text", "id").collect()}
    only_x = {r.id: r._score for r in search(df, "fix", "text", "id", filter=F.col("g") == "x").collect()}
    assert set(only_x) == {1} and abs(only_x[1] - full[1]) < 1e-12


def test_entity_table_created_under_other_name(spark, tmp_dir):
    path = f"{tmp_dir}/git-v2"
    create_table(spark, path, COMMIT_V2)
    t = spark.read.parquet(path)
    assert t.schema.fieldNames() == COMMIT_V2.fieldNames()
    rows = spark.createDataFrame([("Line one\nrest", None, "Ann", [("a.py", "+x")])], COMMIT_V2)
    append(rows, path)
    e = with_computed_columns(spark.read.parquet(path)).first()
    assert e.subject == "Line one" and e.files[0].filename == "a.py"


def test_append_without_key_appends_again(spark, tmp_dir):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    path = f"{tmp_dir}/cars"
    append(with_generated_id(df), path)
    append(with_generated_id(df), path)
    assert spark.read.parquet(path).count() == 4
    assert spark.read.parquet(path).select("_id").distinct().count() == 4


def test_export_spread(spark, tmp_dir):
    df = spark.range(25).withColumn("v", F.col("id") * 2)
    export(df, f"{tmp_dir}/out")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 25
    one = spark.range(10).coalesce(1)
    assert spread(one, ["id"], min_partitions=4).rdd.getNumPartitions() == 4
    many = spark.range(0, 10, 1, 8)
    assert spread(many, min_partitions=4).rdd.getNumPartitions() == 8


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_push_filters_and_prune_columns(spark):
    from __spark_entry__ import queries
    from conftest import SF_SMALL
    q = queries()
    p = _plan(q["range_before"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p
    p = _plan(q["point_lookup"](spark, SF_SMALL))
    assert "EqualTo(c_custkey,1)" in p
    p = _plan(q["terms_any_of"](spark, SF_SMALL))
    assert "In(c_mktsegment" in p
    p = _plan(q["top_terms_stats"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p and "partial_count" in p


def test_no_python_in_plans_except_stemming(spark):
    from __spark_entry__ import queries
    from conftest import SF_SMALL
    for name in ["match_not_term", "bm25_top10", "postings", "path_tokens", "pattern_capture_tokens",
                 "top_terms_stats", "month_histogram", "upsert_latest", "partial_update",
                 "typed_load_quarantine", "any_field_text", "nested_exists"]:
        p = _plan(queries()[name](spark, SF_SMALL))
        assert "PythonUDF" not in p and "EvalPython" not in p and "MapInPandas" not in p, name


def test_postings_written_clustered_and_read_with_pushdown(spark, tmp_dir):
    from quarry.operators.postings import match_postings, postings, write_postings
    docs = spark.createDataFrame([(i, "the common word w%d" % (i % 7)) for i in range(200)],
                                 "doc_id long, text string")
    post = postings(docs, "doc_id", "text")
    write_postings(post, f"{tmp_dir}/post", partitions=8, salt_buckets=4)
    back = spark.read.parquet(f"{tmp_dir}/post")
    # a token present in every document is spread over several files
    files = back.where(F.col("token") == "the").select(F.input_file_name()).distinct().count()
    assert files > 1
    hits = match_postings(back, ["w3"])
    assert sorted(r.doc_id for r in hits.collect()) == [i for i in range(200) if i % 7 == 3]
    assert "In(token" in _plan(hits) or "EqualTo(token" in _plan(hits)


def test_index_queries_read_the_stored_index(spark):
    from __spark_entry__ import queries
    from conftest import SF_SMALL
    from quarry.plans import common
    q = queries()
    q["match_postings"](spark, SF_SMALL)
    built = dict(common._text_indexes)
    for name in ("match_postings", "bm25_postings_top10"):
        p = _plan(q[name](spark, SF_SMALL))
        assert "EqualTo(token,heti)" in p or "In(token, [heti])" in p, p
        assert "split(" not in p
    assert common._text_indexes == built


def test_a_table_never_written_has_no_versions(spark, tmp_dir):
    from quarry.operators.ingest import SNAPSHOT, read_current, versions
    assert versions(spark, f"{tmp_dir}/nothing-here", SNAPSHOT) == {} and read_current(spark, f"{tmp_dir}/nothing-here") is None


def test_change_log_keeps_new_columns_and_a_batch_column(spark, tmp_dir):
    from quarry.operators.ingest import ChangeLogTable
    t = ChangeLogTable(spark, f"{tmp_dir}/t", "k", ["v"])
    t.append_changes(spark.createDataFrame([(1, 1, "x")], "k int, v int, batch string"), 0)
    t.append_changes(spark.createDataFrame([(2, 1, "y", 7)], "k int, v int, batch string, extra int"), 1)
    got = {r.k: (r.batch, r.extra) for r in t.current().collect()}
    assert got == {1: ("x", None), 2: ("y", 7)}


def test_delimited_quotes_line_breaks_and_upper_case_data(spark, tmp_dir):
    import os

    from quarry.sources.delimited import load_typed_delimited
    os.makedirs(f"{tmp_dir}/c")
    with open(f"{tmp_dir}/c/a.csv", "w", newline="") as f:
        f.write('Car;Origin\r\nSTRING;CAT\r\nFORD;US\r\n"say ""hi""\nnow; yes";FR\r\n')
    loaded = load_typed_delimited(spark, f"{tmp_dir}/c")
    rows = loaded.rows.collect()
    assert sorted((r.Car, r.Origin) for r in rows) == [("FORD", "US"), ('say "hi"\nnow; yes', "FR")]


def test_wrong_field_counts_reach_the_quarantine(spark, tmp_dir):
    from quarry.sources.delimited import load_typed_delimited
    with open(f"{tmp_dir}/a.csv", "w", newline="") as f:
        f.write("A;B\nSTRING;INT\nx;1\nz;3;EXTRA\nshort\ny;bad\n")
    loaded = load_typed_delimited(spark, f"{tmp_dir}/a.csv")
    assert [(r.A, r.B) for r in loaded.rows.collect()] == [("x", 1)]
    got = {r._raw: r._errors for r in loaded.quarantine.collect()}
    assert got == {"z;3;EXTRA": ["field count"], "short": ["field count"], '{"A":"y","B":"bad"}': ["B"]}
    summary = loaded.summary.first()
    assert (summary.accepted, summary.failed) == (1, 3)


def test_top_terms_rank_undated_rows_too(spark):
    from quarry.operators.aggs import top_terms_histogram
    df = spark.createDataFrame([("a", None)] * 5 + [("a", "2020-01-01"), ("b", "2020-01-01"), ("b", "2020-02-01")], "k string, d string")
    got = top_terms_histogram(df.withColumn("d", F.to_timestamp("d")), "k", "d", size=1).collect()
    assert {r.k for r in got} == {"a"}


def test_untyped_load_keeps_wrong_field_counts(spark, tmp_dir):
    from quarry.sources.delimited import MALFORMED, load_typed_delimited
    with open(f"{tmp_dir}/u.csv", "w") as f:
        f.write("A;B\nSTRING;INT\nx;1\nz;3;EXTRA\nshort\ny;bad\n")
    df = load_typed_delimited(spark, f"{tmp_dir}/u.csv", type_row=False)
    rows = df.collect()
    assert df.columns == ["A", "B", MALFORMED]  # whatever the data
    assert {r[MALFORMED] for r in rows} == {None, "z;3;EXTRA", "short"}
    assert {(r.A, r.B) for r in rows if r[MALFORMED] is None} == {("STRING", "INT"), ("x", "1"), ("y", "bad")}


def test_text_index_follows_a_changed_table(spark, tmp_dir):
    from quarry.plans import common
    path = f"{tmp_dir}/documents.parquet"

    def ids():
        return sorted(r.doc_id for r in common.text_index(spark, tmp_dir)[0].where("token = 'fix'").collect())

    spark.createDataFrame([(1, "fix it"), (2, "no")], "doc_id long, text string").write.parquet(path)
    assert ids() == [1] and ids() == [1]
    built = len(common._text_indexes)
    spark.createDataFrame([(3, "a fix")], "doc_id long, text string").write.mode("append").parquet(path)
    assert ids() == [1, 3] and len(common._text_indexes) == built + 1
    spark.createDataFrame([(4, "fix")], "doc_id long, text string").write.mode("overwrite").parquet(path)
    assert ids() == [4]
