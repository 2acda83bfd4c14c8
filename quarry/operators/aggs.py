"""Bucket and metric aggregations.

All of them are ``groupBy`` plans: Spark aggregates partially before the
shuffle, so a key that holds a large share of the rows costs one partial row
per task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKETS = 10


def stats_metric(c: Column | str, prefix: str) -> list[Column]:
    """Stats metric (A3): count, min, max, avg, sum of one column, one pass."""
    col = F.col(c) if isinstance(c, str) else c
    return [F.count(col).alias(f"{prefix}_count"), F.min(col).alias(f"{prefix}_min"),
            F.max(col).alias(f"{prefix}_max"), F.avg(col).alias(f"{prefix}_avg"),
            F.sum(col).alias(f"{prefix}_sum")]


def cardinality(c: Column | str, name: str, exact: bool = False, rsd: float = 0.05) -> Column:
    """Distinct count metric (A5): HyperLogLog++ by default, exact on request."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.count_distinct(col) if exact else F.approx_count_distinct(col, rsd)).alias(name)


# Log2 of a sketch's registers; the standard error is about 1.04 / sqrt(2 ** SKETCH_LOG_K), here 1.6 %.
SKETCH_LOG_K = 12


def distinct_sketches(df: DataFrame, by: Sequence[str], c: Column | str, name: str = "sketch") -> DataFrame:
    """A mergeable distinct-count sketch per group (A5 inside A8): a small row however many values a group has.

    Stored sketches of inner buckets (months) roll up to outer ones (years) by
    ``roll_up_distinct`` without a second look at the rows. Nulls do not count.
    """
    col = F.col(c) if isinstance(c, str) else c
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, F.lit(SKETCH_LOG_K)).alias(name))


def roll_up_distinct(sketches: DataFrame, by: Sequence[str], name: str = "sketch", count: str = "distinct") -> DataFrame:
    """Distinct counts of coarser groups from stored sketches: values in several of them count once."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(count))


def terms_agg(df: DataFrame, key: Column | str, metrics: Sequence[Column] = (),
              size: int | None = DEFAULT_BUCKETS, name: str | None = None,
              array: bool = False) -> DataFrame:
    """Terms bucket (A1/A2/A7/A9/A10/L4): documents per key plus sub-metrics.

    Buckets are ordered by ``doc_count`` descending, then key ascending, and
    the first ``size`` are kept (``size=None`` keeps all). NULL keys form no
    bucket. With ``array=True`` each distinct element of an array column is a
    key, so a document counts once per bucket.
    """
    kname = name or (key if isinstance(key, str) else "key")
    kcol = F.col(key) if isinstance(key, str) else key
    if array:
        src = df.withColumn(kname, F.explode(F.array_distinct(kcol)))
    else:
        src = df.withColumn(kname, kcol)
    out = src.where(F.col(kname).isNotNull()).groupBy(kname) \
             .agg(F.count(F.lit(1)).alias("doc_count"), *metrics)
    if size is None:
        return out
    return out.orderBy(F.col("doc_count").desc(), F.col(kname).asc()).limit(size)


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    """Count of a table or query (A12) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def date_histogram(df: DataFrame, ts: str, by: Sequence[str] = (), unit: str = "month",
                   metrics: Sequence[Column] = (), bucket: str = "bucket") -> DataFrame:
    """Calendar histogram (A6), zero-filled.

    Every ``unit`` between the first and last non-empty bucket *of each outer
    key* appears; empty ones have ``doc_count = 0`` (metrics NULL). The data is
    aggregated once to (key, bucket); the empty buckets are the gaps between
    consecutive non-empty ones, found with a ``lag`` over that aggregate, whose
    size is keys x buckets whatever the number of rows. No join.
    """
    return fill_gaps(bucket_counts(df, ts, by, unit, metrics, bucket), by, unit, bucket)


def bucket_counts(df: DataFrame, ts: str, by: Sequence[str] = (), unit: str = "month",
                  metrics: Sequence[Column] = (), bucket: str = "bucket") -> DataFrame:
    """Non-empty calendar buckets per key with their document counts."""
    src_type = df.schema[ts].dataType.simpleString()
    b = F.date_trunc(unit, F.col(ts)).cast(src_type)
    return df.where(F.col(ts).isNotNull()).groupBy(*by, b.alias(bucket)) \
             .agg(F.count(F.lit(1)).alias("doc_count"), *metrics)


def fill_gaps(counts: DataFrame, by: Sequence[str] = (), unit: str = "month",
              bucket: str = "bucket") -> DataFrame:
    """Add the empty buckets between consecutive non-empty ones of each key.

    Each non-empty bucket row is expanded, in one ``explode``, into the empty
    buckets just before it followed by itself, so the aggregate is read once.
    """
    by = list(by)
    rest = [f for f in counts.schema.fields if f.name not in by and f.name != bucket]
    step = F.expr("INTERVAL 3 MONTH" if unit == "quarter" else f"INTERVAL 1 {unit.upper()}")
    w = Window.partitionBy(*by).orderBy(bucket) if by else Window.orderBy(bucket)
    prev = F.col("_prev")
    lo, hi = prev + step, F.col(bucket) - step
    btype = counts.schema[bucket].dataType

    def empty(b: Column) -> Column:
        vals = [(F.lit(0).cast(f.dataType) if f.name == "doc_count" else F.lit(None).cast(f.dataType))
                .alias(f.name) for f in rest]
        return F.struct(b.cast(btype).alias(bucket), *vals)

    own = F.struct(F.col(bucket).alias(bucket), *[F.col(f.name) for f in rest])
    gaps = F.when(prev.isNotNull() & (lo <= hi), F.transform(F.sequence(lo, hi, step), empty)) \
            .otherwise(F.array().cast(T.ArrayType(own_type(counts, bucket, rest))))
    return counts.withColumn("_prev", F.lag(bucket).over(w)) \
                 .select(*by, F.explode(F.concat(gaps, F.array(own))).alias("_b")) \
                 .select(*by, "_b.*")


def own_type(counts: DataFrame, bucket: str, rest) -> T.StructType:
    return T.StructType([T.StructField(bucket, counts.schema[bucket].dataType)] +
                        [T.StructField(f.name, f.dataType) for f in rest])


def top_terms_histogram(df: DataFrame, outer: str, ts: str, size: int = DEFAULT_BUCKETS,
                        unit: str = "month", metrics: Sequence[Column] = (),
                        bucket: str = "bucket") -> DataFrame:
    """Terms bucket with a calendar histogram inside (A1 + A6 + A8).

    The top ``size`` keys are ranked on all rows, those without a date included, and kept
    by a broadcast semi-join whose build side has at most ``size`` rows.
    """
    counts = bucket_counts(df.where(F.col(outer).isNotNull()), ts, [outer], unit, metrics, bucket)
    top = terms_agg(df, outer, size=size).select(outer)
    kept = counts.join(F.broadcast(top), outer, "left_semi")
    return fill_gaps(kept, [outer], unit, bucket)


def nested_buckets(df: DataFrame, outer: str, ts: str, outer_metrics: Sequence[Column] = (),
                   size: int = DEFAULT_BUCKETS, unit: str = "month", metrics: Sequence[Column] = (),
                   bucket: str = "bucket") -> DataFrame:
    """``top_terms_histogram`` with each outer bucket's own document count and metrics beside it.

    ``outer_doc_count`` and ``outer_metrics`` cover all rows of the key, undated ones too;
    a key without any dated row has one row with a null bucket. The outer side has at most
    ``size`` rows.
    """
    top = terms_agg(df, outer, outer_metrics, size=size).withColumnRenamed("doc_count", "outer_doc_count")
    inner = top_terms_histogram(df, outer, ts, size, unit, metrics, bucket)
    return top.join(inner, outer, "left")


def top_keys_then(df: DataFrame, outer: str, inner, size: int = DEFAULT_BUCKETS) -> DataFrame:
    """Sub-bucket (A8): run ``inner(df)`` only on the top ``size`` outer keys.

    The key list has at most ``size`` rows, a bound known before the job runs,
    so it is broadcast and the semi-join is a map-side filter with no shuffle.
    """
    top = terms_agg(df, outer, size=size).select(outer)
    return inner(df.join(F.broadcast(top), outer, "left_semi"))
