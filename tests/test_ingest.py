import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ingest import (create_table, grow_schema, latest_per_key, partial_update,
                                     read_current, typed_load, accepted, quarantined,
                                     load_summary, upsert, upsert_table, with_generated_id)


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_newest_wins_and_is_idempotent(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "_id string, v int, val string")
    ch = spark.createDataFrame([("a", 2, "x2"), ("c", 1, "z"), ("b", 0, "old")], "_id string, v int, val string")
    once = upsert(base, ch, "_id", ["v"])
    assert _rows(once, "_id", "val") == [("a", "x2"), ("b", "y"), ("c", "z")]
    twice = upsert(once, ch, "_id", ["v"])
    assert _rows(twice, "_id", "v", "val") == _rows(once, "_id", "v", "val")


def test_latest_per_key_tie_break_by_second_column(spark):
    df = spark.createDataFrame([(1, 5, 10, "p"), (1, 5, 11, "q"), (2, 1, 1, "r")],
                               "k int, ts int, eid int, x string")
    assert _rows(latest_per_key(df, "k", ["ts", "eid"]), "k", "x") == [(1, "q"), (2, "r")]


def test_upsert_table_snapshots_replay(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    a = spark.createDataFrame([("a", 1)], "_id string, v int")
    b = spark.createDataFrame([("a", 2), ("b", 1)], "_id string, v int")
    upsert_table(spark, path, a, "_id", ["v"], 0)
    upsert_table(spark, path, b, "_id", ["v"], 1)
    first = _rows(read_current(spark, path), "_id", "v")
    upsert_table(spark, path, b, "_id", ["v"], 1)   # replay of batch 1
    assert _rows(read_current(spark, path), "_id", "v") == first == [("a", 2), ("b", 1)]


def test_partial_update(spark):
    base = spark.createDataFrame([("x", "n1", 1.0), ("y", "n2", 2.0)], "_id string, name string, amt double")
    upd = spark.createDataFrame(
        [("x", None, True, 1), ("y", "n2b", None, 1), ("y", "n2c", None, 2), ("z", "n9", None, 1)],
        "_id string, name string, initial_commit boolean, seq int")
    table, errors = partial_update(base, upd, "_id", seq="seq")
    assert table.columns == ["_id", "name", "amt", "initial_commit"]
    assert _rows(table, "_id", "name", "amt", "initial_commit") == [
        ("x", "n1", 1.0, True), ("y", "n2c", 2.0, None)]
    assert [r._id for r in errors.collect()] == ["z"]


def test_typed_load_quarantine(spark):
    raw = spark.createDataFrame([("1", "2.5", "a"), ("x", "3", "b"), (None, "oops", "c")],
                                "n string, d string, s string")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DoubleType())])
    tagged = typed_load(raw, schema)
    assert _rows(accepted(tagged), "n", "d", "s") == [(1, 2.5, "a")]
    q = {r.s: list(r._errors) for r in quarantined(tagged).collect()}
    assert q == {"b": ["n"], "c": ["d"]}
    s = load_summary(tagged).first()
    assert (s.accepted, s.failed) == (1, 2)


def test_grow_schema(spark):
    a = spark.createDataFrame([(1, ("n", "e"))], "id long, p struct<name:string, email:string>")
    b = spark.createDataFrame([(2, ("m",), True)], "id int, p struct<name:string>, flag boolean")
    out = grow_schema(a, b)
    assert set(out.columns) == {"id", "p", "flag"}
    assert _rows(out.select("id", "p.email"), "id", "email") == [(1, "e"), (2, None)]
    c = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(ValueError):
        grow_schema(a, c)


def test_create_table_modes(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.StringType())])
    path = f"{tmp_dir}/c"
    create_table(spark, path, schema)
    create_table(spark, path, schema)   # ignored
    with pytest.raises(Exception):
        create_table(spark, path, schema, if_exists="error")
    assert spark.read.parquet(path).count() == 0


def test_generated_ids(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    k1 = _rows(with_generated_id(df, content_key=True), "_id")
    k2 = _rows(with_generated_id(df, content_key=True), "_id")
    assert k1 == k2 and len(set(k1)) == 2
    u = with_generated_id(df).collect()
    assert len({r._id for r in u}) == 2
