from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.graph import previous_in_group, reachable
from pyspark.sql import types as T

from quarry.operators.ingest import ChangeLogTable, latest_per_key
from quarry.streaming.ingest import run_keyed_ingest


def test_reachable_diamond_each_node_once(spark):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "z"),
                                   ("x", "a")], "child string, parent string")
    roots = spark.createDataFrame([("d",)], "node string")
    out = {r.node: r.depth for r in reachable(edges, roots).collect()}
    assert out == {"d": 0, "b": 1, "c": 1, "a": 2, "z": 3}


def brute_depths(edges, roots):
    """Least distances by a plain breadth-first search."""
    onward = {}
    for a, b in edges:
        onward.setdefault(a, set()).add(b)
    depth, level = {r: 0 for r in roots}, list(roots)
    while level:
        level = [b for a in level for b in onward.get(a, ()) if depth.setdefault(b, depth[a] + 1) == depth[a] + 1]
        level = list(dict.fromkeys(level))
    return depth


def depths(spark, edges, roots, stats=None):
    e = spark.createDataFrame(edges, "child long, parent long").repartition(4)
    r = spark.createDataFrame([(x,) for x in roots], "node long")
    got = reachable(e, r, stats=stats).collect()
    assert len(got) == len({x.node for x in got})
    return {x.node: x.depth for x in got}


def test_reachable_deep_history_in_few_rounds(spark):
    """100,000 commits in a line, 300 branches that were merged back, and one that never was."""
    n = 100_000
    edges = [(i, i - 1) for i in range(1, n)]
    for k in range(300):
        tip, first = 310 * (k + 1), n + 10 * k
        edges += [(tip, first), (first, first + 1), (first + 1, tip - 7 - k % 5)]
    edges += [(n + 5000, n + 5001), (n + 5001, 17)]
    stats = {}
    assert depths(spark, edges, [n - 1], stats) == brute_depths(edges, [n - 1])
    assert stats["rounds"] < 60


def test_reachable_circles_entries_inside_chains_and_several_roots(spark):
    edges = [(1, 2), (2, 3), (3, 1), (4, 2), (5, 4), (5, 6), (6, 6), (6, 7), (7, 8), (8, 9), (20, 8), (21, 20), (9, 1), (30, 31), (None, 5), (5, None)]
    for roots in ([5], [21, 7], [3], [9, 30], [99], []):
        got = depths(spark, edges, roots)
        assert got == brute_depths([e for e in edges if None not in e], roots), roots


def test_previous_in_group_equals_lag(spark):
    rows = [(g, k) for g in (1, 2, None) for k in range(g or 0, 60, 3)] + [(3, 7)]
    df = spark.createDataFrame(rows, "g long, k long")
    got = {(r.g, r.k): r.previous for r in previous_in_group(df, "g", "k", block=4, cuts=3).collect()}
    w = Window.partitionBy("g").orderBy("k")
    want = {(r.g, r.k): r.p for r in df.withColumn("p", F.lag("k").over(w)).collect()}
    assert got == want


def test_previous_in_group_cuts_sparse_orders_evenly(spark):
    """Orders far apart (hash-like) still fall into blocks of many rows."""
    df = spark.range(1, 400).selectExpr("1 as g", "id * id * 1000003 as k")
    out = previous_in_group(df, "g", "k", block=50, cuts=8)
    got = {r.k: r.previous for r in out.collect()}
    keys = sorted(got)
    assert got == dict(zip(keys, [None] + keys[:-1]))


def test_stream_upsert_equals_batch(spark, tmp_dir):
    data = [(i, i % 5, i * 10) for i in range(40)]
    df = spark.createDataFrame(data, "event_id long, user_id long, ts long")
    src = f"{tmp_dir}/src"
    df.repartition(4, "event_id").write.parquet(src)
    run_keyed_ingest(spark, src, df.schema, f"{tmp_dir}/table", f"{tmp_dir}/ckpt",
                     key="user_id", order=["ts", "event_id"], compact_every=3)
    table = ChangeLogTable(spark, f"{tmp_dir}/table", "user_id", ["ts", "event_id"])
    got = sorted(tuple(r) for r in table.current().select("user_id", "event_id").collect())
    want = sorted(tuple(r) for r in latest_per_key(df, "user_id", ["ts", "event_id"])
                  .select("user_id", "event_id").collect())
    assert got == want
    # rerun with the same checkpoint: nothing new, same table
    run_keyed_ingest(spark, src, df.schema, f"{tmp_dir}/table", f"{tmp_dir}/ckpt",
                     key="user_id", order=["ts", "event_id"], compact_every=3)
    assert sorted(tuple(r) for r in table.current().select("user_id", "event_id").collect()) == want


def test_change_log_replay_and_compaction(spark, tmp_dir):
    t = ChangeLogTable(spark, f"{tmp_dir}/t", "k", ["v"])
    a = spark.createDataFrame([("x", 1, "a"), ("y", 1, "b")], "k string, v int, s string")
    b = spark.createDataFrame([("x", 2, "c"), ("x", 3, "d")], "k string, v int, s string")
    t.append_changes(a, 0)
    t.compact(0)
    t.append_changes(b, 1)
    t.append_changes(b, 1)          # replayed batch
    want = [("x", 3, "d"), ("y", 1, "b")]
    assert sorted(tuple(r) for r in t.current().select("k", "v", "s").collect()) == want
    t.compact(1)
    t.compact(1)                    # replayed compaction is a no-op
    assert sorted(tuple(r) for r in t.current().select("k", "v", "s").collect()) == want


def test_stream_quarantine(spark, tmp_dir):
    raw = spark.createDataFrame([("1", "5", "a"), ("bad", "6", "b"), ("2", "7", "c")],
                                "k string, v string, s string")
    src = f"{tmp_dir}/src"
    raw.write.parquet(src)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    run_keyed_ingest(spark, src, raw.schema, f"{tmp_dir}/table", f"{tmp_dir}/ckpt", key="k",
                     order=["v"], schema=schema, quarantine_path=f"{tmp_dir}/q")
    table = ChangeLogTable(spark, f"{tmp_dir}/table", "k", ["v"]).current()
    assert sorted(tuple(r) for r in table.select("k", "v", "s").collect()) == [(1, 5, "a"), (2, 7, "c")]
    assert [r.s for r in spark.read.parquet(f"{tmp_dir}/q").collect()] == ["b"]
