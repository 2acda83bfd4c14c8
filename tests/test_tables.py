"""Keyed tables under crashes, tables found by pattern, lookups by key, the commit data source."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from quarry.operators.ingest import ChangeLogTable, grow_schema, read_current, upsert, upsert_table
from quarry.sources import commit_export
from quarry.sources.commits import read_commits
from quarry.sources.tables import find_tables, lookup_many, scan_tables, write_by_key


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def crash(folder):
    """What a crash leaves of a folder: files, but no mark that it is whole."""
    for name in os.listdir(folder):
        if "_SUCCESS" in name:
            os.remove(f"{folder}/{name}")


@pytest.mark.parametrize("left", ["nothing", "temporary", "files"])
@pytest.mark.parametrize("at", [1, 2])
def test_upsert_table_loses_no_batch_wherever_it_crashes(spark, tmp_dir, left, at):
    path, key = f"{tmp_dir}/t", "k"
    batches = {v: spark.createDataFrame([(v, v, f"b{v}"), (0, v, f"b{v}")], "k int, v int, s string") for v in (1, 2, 3)}
    for v in (1, 2, 3):
        if v == at:  # the first try of this batch fails
            folder = f"{path}/snapshot-{v:012d}"
            if left == "temporary":
                os.makedirs(f"{folder}/_temporary/0")
            elif left == "files":
                upsert_table(spark, path, batches[v], key, ["v"], v)
                crash(folder)
            current = read_current(spark, path)
            assert current is None if v == 1 else rows(current, "k") == [(k,) for k in range(v)]
        upsert_table(spark, path, batches[v], key, ["v"], v)
    assert rows(read_current(spark, path), "k", "v", "s") == [(0, 3, "b3"), (1, 1, "b1"), (2, 2, "b2"), (3, 3, "b3")]


def test_change_log_under_crashes_ties_and_wider_types(spark, tmp_dir):
    t = ChangeLogTable(spark, f"{tmp_dir}/t", "k", ["v"])
    t.append_changes(spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], "k int, v int, s string"), 0)
    t.append_changes(spark.createDataFrame([(1, 1, "b"), (3, 1, "b")], "k int, v int, s string"), 1)
    assert rows(t.current(), "k", "s") == [(1, "b"), (2, "a"), (3, "b")]  # equal versions: the later batch
    os.makedirs(f"{tmp_dir}/t/log/quarry_batch=000000000002/_temporary")
    shutil.copytree(f"{tmp_dir}/t/log/quarry_batch=000000000001", f"{tmp_dir}/t/snapshot-000000000001")
    crash(f"{tmp_dir}/t/snapshot-000000000001")  # a compaction that failed
    assert rows(t.current(), "k", "s") == [(1, "b"), (2, "a"), (3, "b")]
    t.compact(1)
    t.append_changes(spark.createDataFrame([(2, 1 << 40, "c")], "k int, v long, s string"), 2)
    t.append_changes(spark.createDataFrame([(3, 1, "d")], "k int, v int, s string"), 3)
    want = [(1, 1, "b"), (2, 1 << 40, "c"), (3, 1, "d")]
    assert rows(t.current(), "k", "v", "s") == want and dict(t.current().dtypes)["v"] == "bigint"
    t.compact(3)
    assert rows(t.current(), "k", "v", "s") == want
    assert rows(t.current(upto=1), "k", "s") == [(1, "b"), (2, "a"), (3, "b")]


def test_upsert_ties_go_to_the_change(spark):
    base = spark.createDataFrame([(1, 1, "z"), (2, 2, "z")], "k int, v int, s string")
    changes = spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], "k int, v int, s string")
    assert rows(upsert(base, changes, "k", ["v"]), "k", "s") == [(1, "a"), (2, "z")]


def test_grow_schema_widens_inside_structs(spark):
    a = spark.createDataFrame([((1, "x"),)], "s struct<n: int, t: string>")
    b = spark.createDataFrame([((1 << 40, True),)], "s struct<n: long, f: boolean>")
    assert rows(grow_schema(a, b).select("s.n", "s.t", "s.f").fillna({"t": "", "f": False}), "n", "t", "f") == [(1, "x", False), (1 << 40, "", True)]


def test_tables_found_below_a_path_and_in_the_catalog(spark, tmp_dir):
    for name in ("git-1", "git-2.parquet", "cars", "_hidden"):
        spark.range(2).withColumn("n", F.lit(name)).write.parquet(f"{tmp_dir}/base/{name}")
    assert list(find_tables(spark, "git*", base=f"{tmp_dir}/base")) == ["git-1", "git-2"]
    got = scan_tables(spark, "git*", base=f"{tmp_dir}/base")
    assert rows(got.select("_index", "n").distinct(), "_index", "n") == [("git-1", "git-1"), ("git-2", "git-2.parquet")]
    assert scan_tables(spark, base=f"{tmp_dir}/base").count() == 6
    spark.range(3).createOrReplaceTempView("quarry_found_a")
    spark.range(4).createOrReplaceTempView("quarry_found_b")
    assert scan_tables(spark, "quarry_found_?").count() == 7
    with pytest.raises(ValueError, match="no table"):
        scan_tables(spark, "nothing*", base=f"{tmp_dir}/base")


def test_lookups_skip_row_groups(spark, tmp_dir):
    from test_ranked import _rows_scanned
    df = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("_id"), "id")
    for part in (0, 1):  # loaded in two goes, so files overlap in range
        write_by_key(df.where(F.col("id") % 2 == part), f"{tmp_dir}/t", "_id", files=3, row_group_bytes=64 << 10, keys_per_group=2000)
    table = spark.read.parquet(f"{tmp_dir}/t")
    wanted = [5, 777, 12_345, 39_999]
    keys = [r._id for r in df.where(F.col("id").isin(wanted)).collect()]
    found = lookup_many(table, "_id", [*keys, "0" * 64, keys[0]])
    assert _rows_scanned(found) < 20_000 and sorted(r.id for r in found.collect()) == wanted
    assert lookup_many(table, "_id", []).count() == 0
    many = [r._id for r in df.where("id < 300").collect()]
    assert lookup_many(table, "_id", many).count() == 300


def test_commit_source_equals_the_reader_in_batch_and_stream(spark, tmp_dir):
    def commit(i):
        return {"hexsha": f"c{i}", "committed_date": 1500000000 + i, "authored_date": None if i % 3 == 0 else 1490000000 + i,
                "committer": {"name": "Änn", "email": "a@x"}, "author": {"name": None, "email": "b@x"}, "message": f"Fix {i}\n\nwhy",
                "parents": [] if i == 0 else [{"hexsha": f"c{i - 1}"}], "stats": {"files": {"a.py": {"lines": 1}}, "total": {"lines": i, "files": 1}}}
    os.makedirs(f"{tmp_dir}/in")

    def export(name, numbers):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write("\n".join(json.dumps(commit(i)) for i in numbers) + "\n\n")
    export("a.json", range(5))
    export("b.json", range(5, 9))
    commit_export.register(spark)
    source = spark.read.format("commit_export").option("repository", "r")
    got, want = source.load(f"{tmp_dir}/in"), read_commits(spark, f"{tmp_dir}/in", "r")
    assert got.rdd.getNumPartitions() == 2

    def flat(df):
        return sorted(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j")).toPandas()["j"])
    assert flat(got) == flat(want) and len(flat(got)) == 9

    def run():
        stream = spark.readStream.format("commit_export").option("repository", "r").load(f"{tmp_dir}/in")
        (stream.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(once=True).start().awaitTermination())
    run()
    export("c.json", range(9, 12))
    run()
    run()
    assert sorted(r._id for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == sorted(f"c{i}" for i in range(12))


def test_scratch_space_removes_its_tables(spark):
    from quarry.session import scratch_dir, scratch_space
    with scratch_space(spark):
        path = scratch_dir(spark, "space-test")
        spark.range(3).write.parquet(path)
        with scratch_space(spark):
            inner = scratch_dir(spark, "space-inner")
            spark.range(3).write.parquet(inner)
        assert spark.read.parquet(path).count() == 3
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(inner)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_query_words_are_analysed_without_a_job(spark):
    from quarry.functions.analysis import analyze_literal, file_name_analyzer
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quarry-literal", "analysis of query words")
    assert analyze_literal(spark, "Fix the-Parser") == ["fix", "the", "parser"]
    assert analyze_literal(spark, "a/b.py", file_name_analyzer) == ["a", "a/b.py", "a/b"]
    assert len(tracker.getJobIdsForGroup("quarry-literal")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
