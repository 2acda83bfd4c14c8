import json

import pytest
from pyspark.sql import functions as F

from quarry.sources.commits import commit_edges, read_commits, with_analysed_fields, with_computed_columns
from quarry.sources.delimited import MALFORMED, load_typed_delimited
from quarry.sources.tables import lookup, scan_pattern


def _write(path, text):
    with open(path, "wb") as f:
        f.write(text.encode())


def test_typed_csv_crlf_bad_number(spark, tmp_dir):
    # made-up rows, CRLF, one bad number (FIXTURES.md "Typed CSV")
    p = f"{tmp_dir}/cars.csv"
    _write(p, "Car;MPG;Cyl;Origin\r\nSTRING;DOUBLE;INT;CAT\r\n"
              "Alpha One;18.0;8;US\r\nBeta's Two;3504.;4;Japan\r\nGamma;fast;6;Europe\r\n")
    t = load_typed_delimited(spark, p)
    rows = sorted((r.Car, r.MPG, r.Cyl, r.Origin) for r in t.tagged.collect())
    assert rows == [("Alpha One", 18.0, 8, "US"), ("Beta's Two", 3504.0, 4, "Japan"),
                    ("Gamma", None, 6, "Europe")]
    assert [r.Car for r in t.quarantine.collect()] == ["Gamma"]
    assert t.rows.count() == 2
    assert dict(t.rows.dtypes) == {"Car": "string", "MPG": "double", "Cyl": "int", "Origin": "string"}


def test_untyped_csv_keeps_type_row(spark, tmp_dir):
    p = f"{tmp_dir}/u.csv"
    _write(p, "A;B\nSTRING;INT\nx;1\n")
    raw = load_typed_delimited(spark, p, type_row=False)
    assert raw.count() == 2 and dict(raw.dtypes) == {"A": "string", "B": "string", MALFORMED: "string"}
    assert raw.where(F.col(MALFORMED).isNotNull()).count() == 0


def test_unknown_type_name_raises(spark, tmp_dir):
    p = f"{tmp_dir}/bad.csv"
    _write(p, "A;B\nSTRING;DATE\nx;2020\n")
    with pytest.raises(ValueError):
        load_typed_delimited(spark, p)


def test_scan_pattern(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, True)], "id int, flag boolean")
    c = spark.createDataFrame([(3,)], "id int")
    out = scan_pattern(spark, {"git": a, "git-v2": b, "cars": c}, "git*")
    assert sorted((r._index, r.id) for r in out.collect()) == [("git", 1), ("git-v2", 2)]
    assert scan_pattern(spark, {"git": a, "cars": c}).count() == 2
    assert lookup(out, "id", 2).first()._index == "git-v2"


def test_commit_reader(spark, tmp_dir):
    recs = [
        {"hexsha": "c2", "committed_date": 1500000000, "authored_date": 1499990000,
         "committer": {"name": "Ann", "email": "a@x"}, "author": {"name": "Bob", "email": "b@x"},
         "message": "Fix parser\n\nlong text", "parents": [{"hexsha": "c1"}],
         "stats": {"files": {"src/Parser.py": {"lines": 3}, "README": {"lines": 1}},
                   "total": {"insertions": 3, "deletions": 1, "lines": 4, "files": 2}}},
        {"hexsha": "c1", "committed_date": 1400000000, "authored_date": 1400000000,
         "committer": {"name": "Ann", "email": "a@x"}, "author": {"name": "Ann", "email": "a@x"},
         "message": "Initial", "parents": [], "stats": {"files": {}, "total": {"lines": 0}}},
    ]
    p = f"{tmp_dir}/commits.json"
    _write(p, "\n".join(json.dumps(r) for r in recs))
    c = read_commits(spark, p, "repo")
    r = c.where(F.col("_id") == "c2").first()
    assert r.repository == "repo" and r.parent_shas == ["c1"] and r.stats.lines == 4
    assert sorted(r.files) == ["README", "src/Parser.py"]
    assert r.committed_date.year == 2017 and r.committer.name == "Ann"
    a = with_analysed_fields(c).where(F.col("_id") == "c2").first()
    assert "src" in a.files_tokens and "src/parser.py" in a.files_tokens
    assert with_computed_columns(c).where(F.col("_id") == "c2").first().subject == "Fix parser"
    assert [(e.child, e.parent) for e in commit_edges(c).collect()] == [("c2", "c1")]
