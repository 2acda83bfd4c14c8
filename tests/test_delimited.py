"""Delimited files cut into splits, against the reader that takes a file as one piece."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.sources.delimited import MALFORMED, RECORD, _Quotes, load_typed_delimited, read_delimited, read_whole_files


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def made_up(seed, n=300, end="\n"):
    """Quoted values with separators, doubled quotes and line breaks, some many lines long, and quotes inside plain values."""
    rng = random.Random(seed)
    out = ["id;text;note"]
    for i in range(n):
        kind = rng.randrange(6)
        text = {0: f"plain {i}", 1: f'"a;b {i}"', 2: f'"he said ""{i}"""', 3: '"' + "\n".join(f"line {k}; {i}" for k in range(rng.randrange(2, 30))) + '"',
                4: f'in"side {i}', 5: ""}[kind]
        out.append(f"{i};{text};" + rng.choice(["n", '"x\ny"', '""', "", '"q"""']))
    return end.join(out) + end


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_one_file_in_many_splits_equals_the_whole_file_reader(spark, tmp_dir, small_splits, seed, end):
    p = f"{tmp_dir}/a.csv"
    write(p, made_up(seed, end=end))
    got = read_delimited(spark, p)
    assert spark.read.option("lineSep", "\n").text(p).rdd.getNumPartitions() > 10
    assert rows(got) == rows(read_whole_files(spark, p)) and got.count() == 300
    ids = [r.id for r in got.collect()]
    assert sorted(map(int, ids)) == list(range(300))


def test_records_are_numbered_within_their_file(spark, tmp_dir, small_splits):
    os.makedirs(f"{tmp_dir}/d")
    for k in range(3):
        write(f"{tmp_dir}/d/{k}.csv", made_up(k, 100))
    got = read_delimited(spark, f"{tmp_dir}/d", record=True)
    assert all(int(r.id) + 1 == r[RECORD] for r in got.collect()) and got.count() == 300


def test_malformed_records_blank_lines_and_no_line_end(spark, tmp_dir, small_splits):
    p = f"{tmp_dir}/m.csv"
    write(p, "A;B\n\n1;2\n\n\n3\n4;5;6\n\"x\ny\";7\n8;\"\"\nlast;9")
    got = rows(read_delimited(spark, p, keep_malformed=True))
    assert got == rows(read_whole_files(spark, p, keep_malformed=True).select("A", "B", MALFORMED))
    assert {(a, b) for a, b, bad in got if bad is None} >= {("1", "2"), ("x\ny", "7"), ("last", "9")}
    assert {bad for *_, bad in got if bad} == {"3", "4;5;6"}
    empty = f"{tmp_dir}/e.csv"
    write(empty, "A;B\n")
    assert read_delimited(spark, empty).collect() == []


def test_a_quote_that_is_never_closed_is_an_error(spark, tmp_dir, small_splits, monkeypatch):
    from quarry.sources import delimited
    monkeypatch.setattr(delimited, "RECORD_BYTES", 2000)
    p = f"{tmp_dir}/q.csv"
    write(p, "A;B\n1;\"open\n" + "more;lines\n" * 400)
    with pytest.raises(Exception, match="too long"):
        read_delimited(spark, p).collect()


def test_line_states_follow_a_parser_of_characters():
    def walk(line, inside):
        at_start = not inside
        i = 0
        while i < len(line):
            ch = line[i]
            if inside:
                if ch == '"':
                    if line[i + 1:i + 2] == '"':
                        i += 1
                    else:
                        inside = False
                        at_start = False
            elif ch == ";":
                at_start = True
            elif ch == '"' and at_start:
                inside, at_start = True, False
            else:
                at_start = False
            i += 1
        return inside
    rng = random.Random(4)
    quotes = _Quotes(";")
    for _ in range(4000):
        line = "".join(rng.choice('a;"" ') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            assert quotes.after(line, inside) == walk(line, inside), (line, inside)


def test_type_line_is_the_first_data_line_and_nothing_else(spark, tmp_dir):
    p = f"{tmp_dir}/t.csv"
    write(p, "A;B\nSTRING;CAT\nINT;CAT\nSTRING;CAT\nx;y\n")
    assert rows(load_typed_delimited(spark, p).rows) == [("INT", "CAT"), ("STRING", "CAT"), ("x", "y")]
    one = f"{tmp_dir}/one.csv"
    write(one, "A\nSTRING\nSTRING\nfoo\n")
    assert rows(load_typed_delimited(spark, one).rows) == [("STRING",), ("foo",)]
    os.makedirs(f"{tmp_dir}/two")
    write(f"{tmp_dir}/two/a.csv", "A;B\nSTRING;INT\nx;1\n")
    write(f"{tmp_dir}/two/b.csv", "A;B\ny;2\nz;3\n")
    both = load_typed_delimited(spark, f"{tmp_dir}/two")
    assert rows(both.rows) == [("x", 1), ("z", 3)] and [list(r._errors) for r in both.quarantine.collect()] == [["type line"]]
    bare = f"{tmp_dir}/bare.csv"
    write(bare, "A;B\n")
    assert load_typed_delimited(spark, bare).rows.collect() == []


def test_reasons_name_every_error(spark, tmp_dir):
    from quarry.operators.ingest import outcomes
    from quarry.sources.delimited import schema_from_types
    p = f"{tmp_dir}/r.csv"
    write(p, "A;B\nSTRING;INT\nx;1\nz;3;EXTRA\ny;bad\n")
    out = outcomes(load_typed_delimited(spark, p).tagged, schema_from_types(["A", "B"], ["STRING", "INT"]))
    assert {r.reason for r in out.where("status = 'rejected'").collect()} == {"field count: z;3;EXTRA", "B: bad is not int"}
    assert {r.reason for r in out.where("status = 'accepted'").collect()} == {None}


def test_python_reader_agrees(spark, tmp_dir, small_splits):
    p = f"{tmp_dir}/c.csv"
    write(p, made_up(9, 120).replace('in"side', "inside"))
    with open(p, newline="") as f:
        want = sorted((r["id"], r["text"] or None, r["note"] or None) for r in csv.DictReader(f, delimiter=";"))
    got = sorted((r.id, r.text or None, r.note or None) for r in read_delimited(spark, p).select("id", "text", F.col("note")).collect())
    assert got == want
