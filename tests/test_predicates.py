from pyspark.sql import functions as F

from quarry.functions.predicates import (any_field, at_least, bool_query, field, match, nested,
                                         not_, range_, term, terms)


def _ids(df, pred):
    return sorted(r.id for r in df.where(pred).select("id").collect())


def _docs(spark):
    return spark.createDataFrame(
        [(1, "Fix the bug", "a"), (2, "add tests", None), (3, None, "b"), (4, "fixed FIX", "a")],
        "id int, text string, tag string")


def test_match_and_term(spark):
    df = _docs(spark)
    assert _ids(df, match("text", "fix")) == [1, 4]
    assert _ids(df, match("text", "fix tests")) == [1, 2, 4]
    assert _ids(df, match("text", "fix bug", operator="and")) == [1]
    assert _ids(df, term("tag", "a")) == [1, 4]
    assert _ids(df, terms("tag", ["a", "b"])) == [1, 3, 4]


def test_must_not_keeps_missing_field(spark):
    df = _docs(spark)
    # rows without a tag are kept by must_not (Q5); plain NOT would drop them
    assert _ids(df, not_(term("tag", "a"))) == [2, 3]
    assert _ids(df, ~term("tag", "a")) == [3]
    # complement property
    assert sorted(_ids(df, term("tag", "a")) + _ids(df, not_(term("tag", "a")))) == [1, 2, 3, 4]


def test_min_should_match_properties(spark):
    df = _docs(spark)
    cl = [match("text", "fix"), term("tag", "a"), F.col("id") > 2]
    assert _ids(df, at_least(cl, 1)) == _ids(df, cl[0] | cl[1] | cl[2])
    assert _ids(df, at_least(cl, 3)) == _ids(df, F.coalesce(cl[0] & cl[1] & cl[2], F.lit(False)))
    assert _ids(df, at_least(cl, 2)) == [1, 4]


def test_bool_query_rules(spark):
    df = _docs(spark)
    # should alone: at least one required
    assert _ids(df, bool_query(should=[term("tag", "b"), match("text", "tests")])) == [2, 3]
    # should next to must: optional
    assert _ids(df, bool_query(must=[term("tag", "a")], should=[term("id", 99)])) == [1, 4]
    q = bool_query(must=[match("text", "fix")], must_not=[term("id", 4)], filter=[range_("id", lt=5)])
    assert _ids(df, q) == [1]


def test_range_and_field_resolver(spark):
    df = _docs(spark)
    assert _ids(df, range_("id", gt=1, lte=3)) == [2, 3]
    assert field("committer__name__keyword") == "committer.name"
    assert field("author.name.keyword") == "author.name"
    assert field("description") == "description"


def test_nested_same_element(spark):
    df = spark.createDataFrame(
        [(1, [("a.py", "x"), ("b.py", "y")]), (2, [("a.py", "y")])],
        "id int, files array<struct<filename:string, patch:string>>")
    pred = nested("files", lambda f: (f["filename"] == "a.py") & (f["patch"] == "y"))
    assert _ids(df, pred) == [2]


def test_any_field(spark):
    df = spark.createDataFrame([(1, "red ring", ("x", "blue")), (2, "rod", ("ring", "z"))],
                               "id int, name string, s struct<a:string, b:string>")
    assert _ids(df, any_field(df, "ring")) == [1, 2]
    assert _ids(df, any_field(df, "blue")) == [1]
