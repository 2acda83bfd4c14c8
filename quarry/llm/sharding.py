"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import table

SHARDS = 40
VIRTUAL_NODES = 64


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all virtual nodes on the ring (signed 64-bit, ascending) and their shards."""
    at = [(int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
          for s in range(shards) for v in range(virtual_nodes)]
    at.sort()
    return np.array([p for p, _ in at], np.int64), np.array([s for _, s in at], np.int64)


def bounded_flow(counts: np.ndarray, owner: np.ndarray, caps: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Where the keys of each arc go: (arc, first rank in the arc, shard, first slot in the shard).

    A shard first takes keys of its own arcs, clockwise, until it is full. The keys of an arc
    that are left continue clockwise to the next virtual nodes whose shards have room. Only
    one number per arc is worked on, so the cost does not depend on the keys.
    """
    room, used = caps.copy(), np.zeros(len(caps), np.int64)
    out, left = [], []

    def take(arc: int, rank: int, want: int, shard: int) -> int:
        got = int(min(want, room[shard]))
        if got:
            out.append((arc, rank, int(shard), int(used[shard])))
            room[shard] -= got
            used[shard] += got
        return got

    for arc, n in enumerate(counts):
        got = take(arc, 0, int(n), owner[arc])
        if got < n:
            left.append((arc, got, int(n) - got))
    for arc, rank, rest in left:
        node = arc
        while rest:
            node = (node + 1) % len(owner)
            got = take(arc, rank, rest, owner[node])
            rank, rest = rank + got, rest - got
    return sorted(out)


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
                    virtual_nodes: int = VIRTUAL_NODES, slack: float = 0.0) -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row.

    A row belongs to the first virtual node clockwise of its key's hash. Loads are bounded by
    rows: with ``slack`` 0 the caps are the total cut into parts at most one apart, so every
    shard ends exactly full; with more, a shard takes up to (1 + slack) times the mean and
    fewer rows move when shards are added. Rows that overflow a full shard continue
    clockwise.

    The rows of each arc are counted in Spark; the driver sees ``shards * virtual_nodes``
    counts and sends back about as many ranges. A row's rank in its arc is one window over
    arcs, which hold about 1 / (shards * virtual_nodes) of the keys each, however sources
    and copies are spread.

    Defined cases: a null text has no bytes (size 16, crc 0); a null key hashes like the
    empty key; rows that share a key are ordered by size and crc, and identical rows are
    interchangeable; an empty table gives no rows; other columns are not carried.
    """
    spark = docs.sparkSession
    points, owner = ring(shards, virtual_nodes)
    shared = spark.sparkContext.broadcast(points)

    @F.pandas_udf("int")
    def arc_of(h: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(shared.value, h.to_numpy()) % len(shared.value)).astype("int32"))

    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    placed = docs.select(F.col(key).alias(key),
                         F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("__h"),
                         (F.octet_length(raw) + 16).cast("long").alias("size"),
                         F.crc32(raw).alias("text_crc32")).withColumn("__arc", arc_of("__h"))
    counts = np.zeros(len(points), np.int64)
    for r in placed.groupBy("__arc").agg(F.count("*").alias("n")).collect():  # one row per arc
        counts[r["__arc"]] = r["n"]
    total = int(counts.sum())
    caps = total // shards + (np.arange(shards) < total % shards)
    if slack > 0:
        caps = np.full(shards, int(np.ceil((1 + slack) * total / shards)))
    flow = np.array(bounded_flow(counts, owner, caps) or [(0, 0, 0, 0)], np.int64)
    plan = spark.sparkContext.broadcast(flow)
    inside = Window.partitionBy("__arc").orderBy("__h", key, "size", "text_crc32")
    ranked = placed.withColumn("__rank", (F.row_number().over(inside) - 1).cast("long"))

    @F.pandas_udf("struct<shard: int, slot: long>")
    def place(arc: pd.Series, rank: pd.Series) -> pd.DataFrame:
        f = plan.value
        span = 1 << 48
        at = np.searchsorted(f[:, 0] * span + f[:, 1], arc.to_numpy().astype(np.int64) * span + rank.to_numpy(), "right") - 1
        hit = f[at]
        return pd.DataFrame({"shard": hit[:, 2].astype("int32"), "slot": hit[:, 3] + rank.to_numpy() - hit[:, 1]})

    return ranked.withColumn("__p", place("__arc", "__rank")).select(
        key, "size", "text_crc32", F.col("__p.shard").alias("shard"), F.col("__p.slot").alias("slot"))


def op7_consistent_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the ``rows`` law: bounded loads with equal caps."""
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
