from pyspark.sql import functions as F

from quarry.functions.analysis import (analyze_array, file_name_analyzer, file_path_analyzer,
                                       path_tokens, text_tokens, token_rows, url_path)


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("t")).first()["t"]


def test_path_tokens_fixture_cases(spark):
    # expected tokens from FIXTURES.md section 2
    cases = {
        "test/integration/search.py": ["test", "test/integration", "test/integration/search.py"],
        "README": ["readme"],
        ".gitignore": [".gitignore"],
        "a.b/c.py": ["a.b", "a.b/c.py"],
        "/abs/x": ["/abs", "/abs/x"],
        "A/B": ["a", "a/b"],
    }
    for src, want in cases.items():
        assert _one(spark, path_tokens, src) == want
        assert _one(spark, file_path_analyzer, src) == want


def test_pattern_capture_fixture_cases(spark):
    extra = {"test/integration/search.py": {"test/integration/search"}, "README": set(),
             ".gitignore": set(), "a.b/c.py": {"a"}, "/abs/x": set(), "A/B": set()}
    for src, add in extra.items():
        base = set(_one(spark, path_tokens, src))
        got = _one(spark, file_name_analyzer, src)
        assert len(got) == len(set(got))
        assert set(got) == base | add


def test_text_tokens_edges(spark):
    assert _one(spark, text_tokens, None) is None
    assert _one(spark, text_tokens, "") == []
    assert _one(spark, text_tokens, "  --  ") == []
    assert _one(spark, text_tokens, "Élan, vital! x2 ñu") == ["élan", "vital", "x2", "ñu"]
    assert _one(spark, text_tokens, "Fix: the fix.") == ["fix", "the", "fix"]


def test_path_token_count_property(spark):
    # as many tokens as non-empty prefixes
    for p in ["a/b/c", "/x/y", "q", "a//b"]:
        toks = _one(spark, path_tokens, p)
        parts = p.lower().split("/")
        prefixes = ["/".join(parts[:i]) for i in range(1, len(parts) + 1)]
        assert toks == [x for x in prefixes if x]


def test_analyze_array_and_token_rows(spark):
    df = spark.createDataFrame([(1, ["a/b.py", "a/c"])], "id int, files array<string>")
    got = df.select(analyze_array("files", file_path_analyzer, distinct=True).alias("t")).first()["t"]
    assert got == ["a", "a/b.py", "a/c"]
    rows = token_rows(df, "id", text_tokens(F.array_join("files", " "))).collect()
    assert [(r.position, r.token) for r in rows] == [(0, "a"), (1, "b"), (2, "py"), (3, "a"), (4, "c")]


def test_url_path(spark):
    u = "https://m.host.example.net/en/25?x=1#top"
    assert _one(spark, lambda c: url_path(c, True), u) == "m.host.example.net/en/25"
    assert _one(spark, lambda c: url_path(c, False), u) == "en/25"
