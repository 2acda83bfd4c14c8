"""Loading, changing, multi-table, graph, streaming and stemming queries
(K*, S2-S5, S7/S8, W1/W2, T2, A5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.graph import previous_in_group, reachable
from quarry.operators.ingest import (ChangeLogTable, latest_per_key, load_summary, outcomes,
                                     partial_update, quarantined, typed_load, upsert)
from quarry.operators.stemming import stemmed_match
from quarry.plans.common import load
from quarry.session import scratch_dir
from quarry.sources.delimited import load_typed_delimited, write_typed_delimited
from quarry.sources.tables import scan_pattern
from quarry.streaming.ingest import run_keyed_ingest

EVENT_ORDER = ["ts", "event_id"]


def upsert_latest(spark, d):
    ev = load(spark, d, "events")
    return latest_per_key(ev, "user_id", EVENT_ORDER)


def upsert_base_changes(spark, d):
    """A base table and changes, many of them older than the row they meet."""
    ev = load(spark, d, "events")
    late = F.col("event_id") % 3 == 0
    return upsert(latest_per_key(ev.where(~late), "user_id", EVENT_ORDER), ev.where(late), "user_id", EVENT_ORDER)


def _customer_updates(spark, d):
    orders = load(spark, d, "orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey") \
                   .agg(F.lit(True).alias("urgent")) \
                   .select(F.col("o_custkey").alias("c_custkey"), "urgent",
                           F.lit(None).cast("double").alias("pending_total"),
                           F.lit(1).alias("seq"))
    pending = orders.where(F.col("o_orderstatus") == "P").groupBy("o_custkey") \
                    .agg(F.round(F.sum("o_totalprice"), 2).alias("pending_total")) \
                    .select(F.col("o_custkey").alias("c_custkey"),
                            F.lit(None).cast("boolean").alias("urgent"), "pending_total",
                            F.lit(2).alias("seq"))
    return urgent.unionByName(pending)


def partial_update_q(spark, d):
    cust = load(spark, d, "customer")
    table, _errors = partial_update(cust, _customer_updates(spark, d), "c_custkey", seq="seq")
    return table


def partial_update_errors(spark, d):
    """Updates of every seventh customer go to a key that no row has."""
    cust = load(spark, d, "customer")
    updates = _customer_updates(spark, d).withColumn(
        "c_custkey", F.when(F.col("c_custkey") % 7 == 0, -1 - F.col("c_custkey")).otherwise(F.col("c_custkey")))
    _table, errors = partial_update(cust, updates, "c_custkey", seq="seq")
    return errors.select("c_custkey", "_error")


EVENT_TYPES = T.StructType([T.StructField("event_id", T.LongType()),
                            T.StructField("user_id", T.LongType()),
                            T.StructField("value", T.DoubleType())])


def _events_as_text(spark, d):
    """The bad-value stream: ids and values as text, every 97th event id unreadable."""
    ev = load(spark, d, "events")
    bad_id = F.when(F.col("event_id") % 97 == 0, F.lit("bad")).otherwise(F.col("event_id").cast("string"))
    return ev.select(bad_id.alias("event_id"), "ts", F.col("user_id").cast("string").alias("user_id"),
                     "event_type", F.col("value").cast("string").alias("value"), "props")


def typed_load_quarantine(spark, d):
    tagged = typed_load(_events_as_text(spark, d), EVENT_TYPES)
    q = quarantined(tagged)
    return q.select(F.get_json_object("_raw", "$.event_id").alias("raw_event_id"),
                    "user_id", "value", F.array_join("_errors", ",").alias("errors"))


def record_outcomes(spark, d):
    tagged = typed_load(_events_as_text(spark, d), EVENT_TYPES)
    return outcomes(tagged, EVENT_TYPES).select("ts", "user_id", "status", "reason")


def typed_load_summary(spark, d):
    return load_summary(typed_load(_events_as_text(spark, d), EVENT_TYPES))


# Type line of the part table written as a delimited file.
PART_TYPES = {"p_partkey": "INT", "p_name": "STRING", "p_brand": "CAT", "p_type": "CAT",
              "p_size": "INT", "p_retailprice": "DOUBLE"}


def part_lines(spark, d):
    """The part table as delimited files with a type line."""
    path = scratch_dir(spark, f"csv-{uuid.uuid4().hex}")
    write_typed_delimited(load(spark, d, "part"), path, PART_TYPES)
    return path


def csv_typed_load(spark, d):
    return load_typed_delimited(spark, part_lines(spark, d)).rows


def multi_table_scan(spark, d):
    cust = load(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    supp = load(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return scan_pattern(spark, {"customer": cust, "supplier": supp}, "*")


def order_dag(spark, d):
    """Commit-DAG stand-in: child -> child div 2, and child -> previous order of its customer."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    halves = o.where(F.col("o_orderkey") > 0).select(
        F.col("o_orderkey").alias("child"), F.expr("o_orderkey div 2").alias("parent"))
    prev = previous_in_group(o, "o_custkey", "o_orderkey", out="parent") \
        .where(F.col("parent").isNotNull()).select(F.col("o_orderkey").alias("child"), "parent")
    return halves.unionByName(prev)


def reachable_q(spark, d):
    edges = order_dag(spark, d)
    root = load(spark, d, "orders").agg(F.max("o_orderkey").alias("node"))
    return reachable(edges, root)


def stream_upsert(spark, d):
    ev = load(spark, d, "events")
    base = scratch_dir(spark, f"stream-{uuid.uuid4().hex}")
    src = f"{base}/source"
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ev.repartition(files, "event_id").write.mode("overwrite").parquet(src)
    run_keyed_ingest(spark, src, ev.schema, f"{base}/table", f"{base}/_checkpoint",
                     key="user_id", order=EVENT_ORDER, max_files_per_trigger=max(1, files // 4), compact_every=2)
    return ChangeLogTable(spark, f"{base}/table", "user_id", EVENT_ORDER).current()


def stemmed_match_q(spark, d):
    docs = load(spark, d, "documents", spread_on="doc_id").where(F.col("lang") == "en")
    return stemmed_match(docs, "doc_id", "text", "ating")


QUERIES = {
    "upsert_latest": upsert_latest,
    "upsert_base_changes": upsert_base_changes,
    "record_outcomes": record_outcomes,
    "partial_update": partial_update_q,
    "partial_update_errors": partial_update_errors,
    "typed_load_quarantine": typed_load_quarantine,
    "typed_load_summary": typed_load_summary,
    "csv_typed_load": csv_typed_load,
    "multi_table_scan": multi_table_scan,
    "reachable": reachable_q,
    "stream_upsert": stream_upsert,
    "stemmed_match": stemmed_match_q,
}

_LATEST = """
    SELECT user_id, event_id, ts, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

_UPDATES = """
    u AS (SELECT o_custkey AS c_custkey, true AS urgent FROM orders
          WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey),
    p AS (SELECT o_custkey AS c_custkey, round(sum(o_totalprice), 2) AS pending_total FROM orders
          WHERE o_orderstatus = 'P' GROUP BY o_custkey)"""

_TEXT_EVENTS = """
    t AS (SELECT CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST(event_id AS VARCHAR) END AS event_id,
                 CAST(user_id AS VARCHAR) AS user_id, CAST(value AS VARCHAR) AS value FROM events)"""

ORACLE = {
    "upsert_base_changes": _LATEST,
    "record_outcomes": """
        SELECT ts, user_id, CASE WHEN event_id % 97 = 0 THEN 'rejected' ELSE 'accepted' END AS status,
               CASE WHEN event_id % 97 = 0 THEN 'event_id: bad is not bigint' END AS reason
        FROM events""",
    "upsert_latest": _LATEST,
    "partial_update": f"""
        WITH {_UPDATES}
        SELECT c.*, u.urgent, p.pending_total FROM customer c
        LEFT JOIN u USING (c_custkey) LEFT JOIN p USING (c_custkey)""",
    "partial_update_errors": f"""
        WITH {_UPDATES}, k AS (SELECT c_custkey FROM u UNION SELECT c_custkey FROM p),
        m AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey FROM k)
        SELECT c_custkey, 'document_missing' AS _error FROM m
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""",
    "typed_load_quarantine": f"""
        WITH {_TEXT_EVENTS}
        SELECT event_id AS raw_event_id, TRY_CAST(user_id AS BIGINT) AS user_id,
               TRY_CAST(value AS DOUBLE) AS value, 'event_id' AS errors
        FROM t WHERE TRY_CAST(event_id AS BIGINT) IS NULL""",
    "typed_load_summary": f"""
        WITH {_TEXT_EVENTS}
        SELECT CAST(count_if(TRY_CAST(event_id AS BIGINT) IS NOT NULL) AS BIGINT) AS accepted,
               CAST(count_if(TRY_CAST(event_id AS BIGINT) IS NULL) AS BIGINT) AS failed FROM t""",
    "csv_typed_load": """
        SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type,
               CAST(p_size AS INTEGER) AS p_size, p_retailprice FROM part""",
    "multi_table_scan": """
        SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
               c_mktsegment AS mktsegment, 'customer' AS _index FROM customer
        UNION ALL BY NAME
        SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
               'supplier' AS _index FROM supplier""",
    "reachable": """
        WITH RECURSIVE e AS (
            SELECT o_orderkey AS child, o_orderkey // 2 AS parent FROM orders WHERE o_orderkey > 0
            UNION ALL
            SELECT child, parent FROM (
                SELECT o_orderkey AS child,
                       lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS parent
                FROM orders) WHERE parent IS NOT NULL),
        r(node, depth) AS (
            SELECT max(o_orderkey), 0 FROM orders
            UNION
            SELECT e.parent, r.depth + 1 FROM r JOIN e ON e.child = r.node)
        SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY node""",
    "stream_upsert": _LATEST,
}
