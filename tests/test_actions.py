"""Action streams against a replay action by action."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.actions import action_outcomes, actions_from_json, apply_actions
from quarry.operators.graph import last_before

FIELDS = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("flag", T.BooleanType())])


def made_up(seed, n=400, keys=12):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        key = rng.choice([f"k{rng.randrange(keys)}", "hot", None]) if seq % 5 else "hot"
        op = rng.choice(["update"] * 5 + ["index", "delete", None, "upsert"])
        doc = {f: v for f, v in (("name", rng.choice(["a", None])), ("n", rng.choice([1, 2, None])), ("flag", rng.choice([True, None]))) if rng.random() < 0.5}
        line = {"_id": key, **({"_op_type": op} if op else {}), **({"doc": doc} if op == "update" else doc if op in ("index", None) else {})}
        out.append((seq, line))
    return out


def replay(base, lines):
    docs, results = {k: dict(v) for k, v in base.items()}, {}
    for seq, line in lines:
        key, op = line["_id"], line.get("_op_type") or "index"
        if op not in ("index", "update", "delete"):
            results[seq] = ("failed", "unknown_action")
            continue
        if key is None and op != "index":
            results[seq] = ("failed", "key_missing")
            continue
        if key is None:
            key = f"made-{seq}"
        there = key in docs
        if op == "index":
            docs[key] = {f: line.get(f) for f in ("name", "n", "flag")} | {"kept": None}
            results[seq] = ("updated" if there else "created", None)
        elif not there:
            results[seq] = ("failed", "document_missing" if op == "update" else "not_found")
        elif op == "delete":
            del docs[key]
            results[seq] = ("deleted", None)
        else:
            docs[key] |= line["doc"]
            results[seq] = ("updated", None)
    return docs, results


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_interleaving_composes(spark, seed):
    base = {f"k{i}": {"name": f"b{i}", "n": None, "flag": None, "kept": i} for i in range(0, 12, 2)}
    lines = made_up(seed)
    docs, results = replay(base, lines)
    b = spark.createDataFrame([(k, v["name"], v["kept"]) for k, v in base.items()], "_id string, name string, kept int")
    rng = random.Random(seed)
    acts = actions_from_json(spark.createDataFrame([(s, json.dumps(x)) for s, x in rng.sample(lines, len(lines))], "seq long, value string").repartition(5), FIELDS)
    got = apply_actions(b, acts, "_id", "seq").collect()
    seen = [(r._id if not len(r._id) == 64 else "made", r.name, r.kept, r.n, r.flag) for r in got]
    want = [(k if not k.startswith("made-") else "made", v["name"], v["kept"], v["n"], v["flag"]) for k, v in docs.items()]
    assert sorted(map(repr, seen)) == sorted(map(repr, want))
    out = action_outcomes(b, acts, "_id", "seq").collect()
    assert {r.seq: (r.status, r._error) for r in out} == results and len(out) == len(lines)


def test_update_without_given_takes_what_is_not_null(spark):
    b = spark.createDataFrame([("x", "n1", 1)], "_id string, name string, n long")
    acts = spark.createDataFrame([("x", 1, "update", (None, 5)), ("x", 2, "update", ("n2", None))], "_id string, seq int, _op_type string, doc struct<name: string, n: long>")
    assert [tuple(r) for r in apply_actions(b, acts, "_id", "seq").collect()] == [("x", "n2", 5)]
    assert apply_actions(b, acts.limit(0), "_id", "seq").collect() == b.collect()


def test_aggregation_combines_before_the_shuffle(spark):
    b = spark.createDataFrame([("x", "n1", 1)], "_id string, name string, n long")
    acts = spark.createDataFrame([("x", 1, "update", (None, 5))], "_id string, seq int, _op_type string, doc struct<name: string, n: long>")
    plan = apply_actions(b, acts, "_id", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_last_before_in_blocks(spark):
    rng = random.Random(5)
    rows = [(g, k, rng.choice([None, None, rng.randrange(100)])) for g in (1, 2, None) for k in rng.sample(range(1000), 80)] + [(3, 1, 7)]
    df = spark.createDataFrame(rows, "g int, k long, v int")
    want, last = {}, {}
    for g, k, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        want[g, k] = last.get(g)
        last[g] = v if v is not None else last.get(g)
    for block in (10, 1 << 16):
        got = {(r.g, r.k): r.was for r in last_before(df, "g", "k", "v", "was", block=block, cuts=6).collect()}
        assert got == want
    assert last_before(df, "g", "k", "v", "was").select(F.count("*")).first()[0] == len(rows)
