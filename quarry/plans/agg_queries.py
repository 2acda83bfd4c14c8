"""Aggregation queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions.project import bucket_line
from quarry.operators.aggs import (cardinality, count_rows, date_histogram, distinct_sketches, nested_buckets,
                                   roll_up_distinct, stats_metric, terms_agg, top_terms_histogram)
from quarry.functions.predicates import term
from quarry.plans.common import load
from quarry.session import scratch_dir


def top_terms_stats(spark, d):
    orders = load(spark, d, "orders")
    out = terms_agg(orders, "o_custkey", stats_metric("o_totalprice", "price"))
    return out.withColumn("price_avg", F.round("price_avg", 2)) \
              .withColumn("price_sum", F.round("price_sum", 2))


def terms_multi_metric(spark, d):
    li = load(spark, d, "lineitem")
    return terms_agg(li, "l_suppkey", [F.sum("l_quantity").alias("qty_sum"),
                                       cardinality("l_partkey", "parts", exact=True)])


def cardinality_approx(spark, d):
    li = load(spark, d, "lineitem")
    return li.agg(cardinality("l_partkey", "parts_approx"))


def agg_under_query(spark, d):
    orders = load(spark, d, "orders")
    return terms_agg(orders.where(term("o_orderstatus", "F")), "o_orderpriority")


def month_histogram(spark, d):
    orders = load(spark, d, "orders")
    return date_histogram(orders, "o_orderdate")


def customer_month_histogram(spark, d):
    orders = load(spark, d, "orders")
    return date_histogram(orders, "o_orderdate", by=["o_custkey"])


def terms_by_month(spark, d):
    orders = load(spark, d, "orders")
    return top_terms_histogram(orders, "o_orderpriority", "o_orderdate")


def _shipped(spark, d):
    """Orders with the date only of those that are not pending: a column with nulls."""
    return load(spark, d, "orders").withColumn("done", F.when(~term("o_orderstatus", "P"), F.col("o_orderdate")))


def terms_by_month_undated(spark, d):
    """More keys than buckets, and rows without a date that count in the ranking."""
    return top_terms_histogram(_shipped(spark, d), "o_custkey", "done")


def nested_bucket_metrics(spark, d):
    out = nested_buckets(_shipped(spark, d), "o_custkey", "done", [F.sum("o_totalprice").alias("total")])
    return out.withColumn("total", F.round("total", 2))


def cardinality_error(spark, d):
    """The approximate count stays within three standard errors of the exact one."""
    li = load(spark, d, "lineitem")
    both = li.agg(cardinality("l_partkey", "approx"), cardinality("l_partkey", "parts", exact=True))
    return both.select("parts", (F.abs(F.col("approx") - F.col("parts")) <= 3 * 0.05 * F.col("parts")).alias("close"))


def distinct_by_year_from_months(spark, d):
    """Customers per year, from stored sketches per priority and month: within four standard errors of the exact count."""
    orders = load(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderpriority", "o_custkey")
    path = scratch_dir(spark, f"sketches-{uuid.uuid4().hex}")
    distinct_sketches(orders, ["year", "month", "o_orderpriority"], "o_custkey").write.parquet(path)
    rolled = roll_up_distinct(spark.read.parquet(path), ["year"], count="estimate")
    exact = orders.groupBy("year").agg(F.count_distinct("o_custkey").alias("customers"))
    return rolled.join(exact, "year").select("year", "customers", (F.abs(F.col("estimate") - F.col("customers")) <= 0.066 * F.col("customers") + 1).alias("close"))


def table_count(spark, d):
    return count_rows(load(spark, d, "orders"))


def query_count(spark, d):
    return count_rows(load(spark, d, "orders").where(term("o_orderstatus", "F")))


def bucket_lines(spark, d):
    li = load(spark, d, "lineitem")
    top = terms_agg(li, "l_suppkey", [F.sum("l_quantity").alias("lines")])
    return top.select(bucket_line(F.col("l_suppkey").cast("string"), "doc_count",
                                  F.floor("lines")).alias("line"))


QUERIES = {
    "distinct_by_year_from_months": distinct_by_year_from_months,
    "top_terms_stats": top_terms_stats,
    "terms_multi_metric": terms_multi_metric,
    "cardinality_approx": cardinality_approx,
    "agg_under_query": agg_under_query,
    "month_histogram": month_histogram,
    "customer_month_histogram": customer_month_histogram,
    "terms_by_month": terms_by_month,
    "terms_by_month_undated": terms_by_month_undated,
    "nested_bucket_metrics": nested_bucket_metrics,
    "cardinality_error": cardinality_error,
    "table_count": table_count,
    "query_count": query_count,
    "bucket_lines": bucket_lines,
}

_HIST = """
    WITH c AS (SELECT {by}date_trunc('month', o_orderdate) AS bucket, count(*) AS doc_count
               FROM {src} WHERE o_orderdate IS NOT NULL GROUP BY ALL),
    r AS (SELECT {by}min(bucket) AS lo, max(bucket) AS hi FROM c GROUP BY ALL),
    g AS (SELECT {by}unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS bucket FROM r)
    SELECT g.*, coalesce(c.doc_count, 0) AS doc_count FROM g LEFT JOIN c USING ({keys}bucket)"""

_TOP = "SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10"
_UNDATED = _HIST.format(
    by="o_custkey, ", keys="o_custkey, ",
    src=f"""(SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS o_orderdate
             FROM orders WHERE o_custkey IN ({_TOP}))""")

ORACLE = {
    "distinct_by_year_from_months": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS customers, true AS close
        FROM orders GROUP BY 1""",
    "terms_by_month_undated": _UNDATED,
    "nested_bucket_metrics": f"""
        WITH h AS ({_UNDATED}),
        o AS (SELECT o_custkey, count(*) AS outer_doc_count, round(sum(o_totalprice), 2) AS total
              FROM orders WHERE o_custkey IN ({_TOP}) GROUP BY 1)
        SELECT o_custkey, outer_doc_count, total, bucket, doc_count FROM o LEFT JOIN h USING (o_custkey)""",
    "cardinality_error": "SELECT count(DISTINCT l_partkey) AS parts, true AS close FROM lineitem",
    "top_terms_stats": """
        SELECT o_custkey, count(*) AS doc_count, count(o_totalprice) AS price_count,
               min(o_totalprice) AS price_min, max(o_totalprice) AS price_max,
               round(avg(o_totalprice), 2) AS price_avg, round(sum(o_totalprice), 2) AS price_sum
        FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
        ORDER BY doc_count DESC, o_custkey LIMIT 10""",
    "terms_multi_metric": """
        SELECT l_suppkey, count(*) AS doc_count, sum(l_quantity) AS qty_sum,
               count(DISTINCT l_partkey) AS parts
        FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
        ORDER BY doc_count DESC, l_suppkey LIMIT 10""",
    "agg_under_query": """
        SELECT o_orderpriority, count(*) AS doc_count FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority IS NOT NULL GROUP BY o_orderpriority
        ORDER BY doc_count DESC, o_orderpriority LIMIT 10""",
    "month_histogram": _HIST.format(by="", src="orders", keys=""),
    "customer_month_histogram": _HIST.format(by="o_custkey, ", src="orders", keys="o_custkey, "),
    "terms_by_month": _HIST.format(
        by="o_orderpriority, ",
        src="""(SELECT * FROM orders WHERE o_orderpriority IN (
                 SELECT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL
                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10))""",
        keys="o_orderpriority, "),
    "table_count": "SELECT count(*) AS count FROM orders",
    "query_count": "SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'F'",
    "bucket_lines": """
        SELECT printf('%15s: %3d commits changing %6d lines', CAST(l_suppkey AS VARCHAR),
                      count(*), CAST(floor(sum(l_quantity)) AS BIGINT)) AS line
        FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
        ORDER BY count(*) DESC, l_suppkey LIMIT 10""",
}
