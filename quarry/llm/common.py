"""Small helpers of the pipeline operators: tables, shared scratch folder, hashing, samples."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import scratch_dir

BLANK = "\\x20\\x09-\\x0D"
_HASH_STEPS = 1 << 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


def stored(spark: SparkSession, df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: short lineage
    that survives lost executors, and no second run of what made it.

    ``batch_rows`` bounds the rows that go to a Python worker at once while it is written:
    fewer texts are then in memory at a time, in the worker and on their way.
    """
    path = scratch(spark, name)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    if batch_rows:
        spark.conf.set(setting, str(min(batch_rows, int(before))) if int(before) > 0 else str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that this Python worker has freed to the system: it may idle beside the workers of the next stage."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not a glibc system
        pass


def maybe_in(spark: SparkSession, rows: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that every value of the long ``column`` of stored ``rows`` passes, and few others.

    A bitmap of about 16 bits a row, of 4 KiB to 32 MiB, is broadcast, so that a scan can leave out most
    of what a join would drop; with more rows than it has bits for, it lets more through.
    """
    size = 1 << max(15, min(28, (16 * rows.count()).bit_length()))
    slot = F.pmod(column, F.lit(size))
    parts = (rows.groupBy(F.bitmap_bucket_number(slot + 1).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits")).collect())
    packed = np.zeros(size >> 3, np.uint8)
    for r in parts:
        some = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["part"] - 1) * len(some)
        packed[at: at + len(some)] = some[: len(packed) - at]
    wanted = spark.sparkContext.broadcast(packed)

    @F.pandas_udf("boolean")
    def test(slots: pd.Series) -> pd.Series:
        s = slots.fillna(0).to_numpy(dtype=np.int64)
        return pd.Series((wanted.value[s >> 3] >> (s & 7)) & 1 == 1)

    return lambda value: test(F.pmod(value, F.lit(size)))


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5 (null for a null key)."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def held_out(key: Column) -> Column:
    """Rows that no model may learn from: fold 0, and rows without a key."""
    return F.coalesce(fold(key) == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    key: str = "doc_id", text: str = "text", most_rows: int | None = None) -> tuple[DataFrame, dict]:
    """Up to ``per_class`` learnable rows of each label value (``most_rows`` of all), picked by hash of the key.

    ``labels`` holds ``key`` and ``label``. Returns (rows with ``text``, ``label`` and
    ``part``, a stable number from 0 to 5 for cross-fitting; learnable rows by label).
    Only keys and labels are looked at, and few ranked; the texts of the bounded sample are joined after.
    """
    pool = (labels.where(~held_out(F.col(key)) & F.col(label).isNotNull())
            .select(F.col(key), F.col(label).alias("label"), F.pmod(F.xxhash64(key), F.lit(_HASH_STEPS)).alias("__u")))
    totals = {r["label"]: r["n"] for r in pool.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if most_rows and totals:
        per_class = max(1, min(per_class, most_rows // len(totals)))
    # a label's hash limit lets through a few more rows than wanted, and only those are ranked
    limit = F.lit(_HASH_STEPS)
    for value, n in totals.items():
        if n > 2 * per_class:
            limit = F.when(F.col("label") == value, F.lit(int(_HASH_STEPS * 1.3 * per_class / n))).otherwise(limit)
    order = Window.partitionBy("label").orderBy("__u", key)
    ids = (pool.where(F.col("__u") < limit).withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= per_class)
           .select(F.col(key).alias("__key"), "label", F.pmod("__u", F.lit(6)).cast("int").alias("part")))
    rows = (docs.select(F.col(key).alias("__id"), F.col(text).alias("text"))
            .join(F.broadcast(ids), F.col("__id") == F.col("__key")).select("text", "label", "part"))
    return rows, totals
