"""Ancestor traversal of a commit graph (S2), and the skew-safe "last one before" helpers."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.session import scratch_dir

# rounds after which the visited pieces are merged into one written table
_CONSOLIDATE_EVERY = 16
# chains are contracted again while that takes away at least one edge in so many
_WORTH = 8


class _Tables:
    """Intermediate tables below the shared checkpoint folder: lineage ends at each, and what is lost is read again."""

    def __init__(self, spark):
        self.spark, self.path, self.count = spark, scratch_dir(spark, f"reach-{uuid.uuid4().hex}"), 0

    def written(self, df: DataFrame) -> DataFrame:
        return self.counted(df, F.lit(True))[0]

    def counted(self, df: DataFrame, what: Column) -> tuple[DataFrame, int]:
        """The written table, and how many of its rows meet ``what``, counted by the job that writes them."""
        self.count += 1
        path, seen = f"{self.path}/t{self.count}", Observation()
        df.observe(seen, F.count_if(what).alias("n")).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get["n"]


def _least(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias(value))


def _pointers(tables: _Tables, links: DataFrame, stats: dict) -> tuple[list[DataFrame], int]:
    """Pointer jumping over nodes with a single parent.

    Round k gives (node, to, dist, open, low): where 2**k steps lead, or fewer if a node that
    has not a single parent comes first (then ``open`` is false). ``low`` is the least node
    stepped on. There are as many rounds as the longest chain has binary digits. The second
    result is how many nodes are still open after the last round: those that lead into circles.
    """
    known = links.select(F.col("node").alias("_n"), F.lit(True).alias("_is"))
    now, moving = tables.counted(links.join(known, F.col("to") == F.col("_n"), "left")
                                 .select("node", "to", "dist", F.coalesce("_is", F.lit(False)).alias("open"), F.col("to").alias("low")), F.col("open"))
    rounds = [now]
    limit = now.count().bit_length() + 1
    while moving and len(rounds) <= limit:
        onward = now.select(F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("dist").alias("_d"),
                            F.col("open").alias("_o"), F.col("low").alias("_l"))
        moved = now.where("open").join(onward, F.col("to") == F.col("_n")).select(
            "node", F.col("_to").alias("to"), (F.col("dist") + F.col("_d")).alias("dist"), F.col("_o").alias("open"), F.least("low", "_l").alias("low"))
        now, moving = tables.counted(moved.union(now.where("not open")), F.col("open"))
        rounds.append(now)
        stats["rounds"] += 1
    return rounds, moving


def _single_parents(edges: DataFrame) -> DataFrame:
    """(node, to, dist) of the nodes with one edge out."""
    return (edges.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("to"), F.min("w").alias("dist"))
            .where("n = 1").select(F.col("a").alias("node"), "to", "dist"))


def _contracted(tables: _Tables, edges: DataFrame, starts: DataFrame, stats: dict) -> DataFrame:
    """Depths of the nodes reachable in the weighted graph ``edges`` (a, b, w) from ``starts`` (node, depth).

    Nodes with a single parent are taken out: every edge into such a chain goes on to the
    chain's end, with the chain's length. Parallel edges that result keep the shorter
    one, so a branch that was merged back becomes a single parent too, and the next
    contraction takes it out. What is left is searched breadth-first, and depths are
    handed down the chains again along the pointers of each round.
    """
    links = tables.written(_single_parents(edges))
    if links.count() * _WORTH <= edges.count():
        return _breadth_first(tables, edges, starts, stats)
    rounds, circling = _pointers(tables, links, stats)
    if circling:
        # a circle of single parents: its least node meets itself as the least one, and stays
        knots = rounds[-1].where("open and node = low").select("node")
        links = tables.written(links.join(knots, "node", "left_anti"))
        rounds, _ = _pointers(tables, links, stats)
    ends = rounds[-1].select("node", "to", "dist")
    at = ends.select(F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("dist").alias("_d"))
    kept = edges.join(links.select(F.col("node").alias("a")), "a", "left_anti")
    entering = tables.written(kept.join(at, F.col("b") == F.col("_n"), "left"))
    smaller = (entering.select("a", F.coalesce("_to", "b").alias("b"), (F.col("w") + F.coalesce("_d", F.lit(0))).alias("w"))
               .where("a <> b").groupBy("a", "b").agg(F.min("w").alias("w")))
    first = starts.join(at, F.col("node") == F.col("_n"), "left")
    from_ends = first.select(F.coalesce("_to", "node").alias("node"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"))
    depths = _contracted(tables, tables.written(smaller), tables.written(_least(from_ends, "node", "depth")), stats)

    # a chain node's depth: the least (depth where the chain is entered + steps from there to
    # its end) over entries above it, less its own steps to the end
    entries = (entering.where("_n is not null").join(depths.withColumnRenamed("node", "a"), "a")
               .select(F.col("b").alias("node"), (F.col("depth") + F.col("w") + F.col("_d")).alias("depth")))
    entries = entries.union(first.where("_n is not null").select("node", F.col("depth") + F.col("_d")))
    sums = tables.written(_least(entries, "node", "depth"))
    for jump in rounds[:-1]:
        handed = jump.where("open").join(sums, "node").select(F.col("to").alias("node"), "depth")
        sums = tables.written(_least(sums.union(handed), "node", "depth"))
        stats["rounds"] += 1
    inside = sums.join(ends, "node").select("node", (F.col("depth") - F.col("dist")).alias("depth"))
    return tables.written(depths.union(inside))


def _breadth_first(tables: _Tables, edges: DataFrame, starts: DataFrame, stats: dict) -> DataFrame:
    """Least depths by rounds over the frontier: the nodes whose depth the last round lessened.

    The edges are hash-partitioned on the child and checkpointed once, so a round shuffles
    the frontier. How it is joined is left to AQE, which knows the bytes of the written pieces.
    """
    n = int(tables.spark.conf.get("spark.sql.shuffle.partitions"))
    step = edges.repartition(n, "a").checkpoint()
    frontier = tables.written(_least(starts, "node", "depth"))
    pieces = [frontier]
    while True:
        seen = _least(reduce(lambda x, y: x.unionByName(y), pieces), "node", "depth").withColumnRenamed("depth", "_old")
        found = frontier.join(step, frontier["node"] == step["a"]).select(F.col("b").alias("node"), (F.col("depth") + F.col("w")).alias("depth"))
        frontier, new = tables.counted(_least(found, "node", "depth").join(seen, "node", "left")
                                       .where("_old is null or depth < _old").select("node", "depth"), F.lit(True))
        stats["rounds"] += 1
        if not new:
            break
        pieces.append(frontier)
        if len(pieces) >= _CONSOLIDATE_EVERY:
            pieces = [tables.written(_least(reduce(lambda x, y: x.unionByName(y), pieces), "node", "depth"))]
    return _least(reduce(lambda x, y: x.unionByName(y), pieces), "node", "depth")


def reachable(edges: DataFrame, roots: DataFrame, child: str = "child", parent: str = "parent",
              node: str = "node", stats: dict | None = None) -> DataFrame:
    """All nodes reachable from ``roots`` along child -> parent edges, each once.

    ``depth`` is the shortest distance from a root. Chains of single parents are
    ranked by pointer jumping, in as many rounds as their length has binary digits,
    again and again as merged branches turn into chains themselves; only the merge points
    that remain are searched breadth-first, one round a level. A history of mostly
    merges is searched breadth-first as it is.

    Every round is written to the shared checkpoint folder, so a lost executor costs at
    most that round. Edges with a null end and edges of a node to itself lead nowhere;
    circles are allowed. ``stats`` (a dict) gets the number of rounds.
    """
    spark = edges.sparkSession
    stats = {} if stats is None else stats
    stats["rounds"] = 0
    tables = _Tables(spark)
    step = tables.written(edges.select(F.col(child).alias("a"), F.col(parent).alias("b")).where("a <> b").distinct().withColumn("w", F.lit(1)))
    starts = roots.select(F.col(node).alias("node")).where("node is not null").distinct().withColumn("depth", F.lit(0))
    return _contracted(tables, step, tables.written(starts), stats)


def _in_blocks(df: DataFrame, group: str, order: str, block: int, cuts: int) -> DataFrame:
    """``df`` with ``_blk``: groups of more than ``block`` rows are cut at approximate quantiles of ``order``."""
    at = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    hot = (df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
           .select(F.col(group).alias("_g")))
    sampled = (df.join(hot, F.col(group).eqNullSafe(F.col("_g")), "left_semi")
               .groupBy(F.col(group).alias("_g")).agg(F.percentile_approx(order, at, F.lit(4 * cuts)).alias("_cuts")))
    d = df.join(sampled, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    below = F.size(F.filter("_cuts", lambda c: c < F.col(order)))
    return d.withColumn("_blk", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(below)).drop("_cuts")


def last_before(df: DataFrame, group: str, order: str, value: str, out: str,
                block: int = 1 << 16, cuts: int = 1024) -> DataFrame:
    """The last ``value`` that is not null on an earlier row of the same ``group``, by ``order``.

    Groups are cut into blocks as in ``previous_in_group``: a window inside each block, and
    for rows that have none there a second window over one row per block. ``order`` must be a
    number; rows of equal order in a group see each other in either order.
    """
    d = _in_blocks(df, group, order, block, cuts)
    inner = Window.partitionBy(group, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.last(value, ignorenulls=True).over(inner))
    blocks = d.groupBy(group, "_blk").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    earlier = Window.partitionBy(group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).where("_carried is not null")
    blocks = blocks.select(F.col(group).alias("_g"), F.col("_blk").alias("_b"), "_carried")
    d = d.join(blocks, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_blk") == F.col("_b")), "left")
    return d.withColumn(out, F.coalesce("_in", "_carried")).drop("_blk", "_in", "_carried", "_g", "_b")


def previous_in_group(df: DataFrame, group: str, order: str, out: str = "previous",
                      block: int = 1 << 16, cuts: int = 1024) -> DataFrame:
    """The ``order`` value of the preceding row of the same ``group`` (a ``lag``).

    A plain ``lag`` over ``partitionBy(group)`` puts a whole group in one task.
    Groups of more than ``block`` rows are cut at ``cuts`` approximate quantiles of their
    order values, so blocks hold about equally many rows however the values are
    spread (dense ids, timestamps, hashes). Rows are windowed inside a block; its
    first row takes the maximum of the nearest earlier block of the group, by a
    second window over one row per block. Smaller groups are one block. ``order``
    must be a number, distinct within a group; equal values share a block.
    """
    d = _in_blocks(df, group, order, block, cuts)
    inner = Window.partitionBy(group, "_blk").orderBy(order)
    d = d.withColumn("_lag", F.lag(order).over(inner))
    blocks = d.groupBy(group, "_blk").agg(F.max(order).alias("_bmax"))
    prev_block = Window.partitionBy(group).orderBy("_blk")
    blocks = blocks.withColumn("_prev_bmax", F.lag("_bmax").over(prev_block)).where("_prev_bmax is not null")
    blocks = blocks.select(F.col(group).alias("_g"), F.col("_blk").alias("_b"), "_prev_bmax")
    cond = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_blk") == F.col("_b"))
    d = d.join(blocks, cond, "left")
    return d.withColumn(out, F.coalesce(F.col("_lag"), F.col("_prev_bmax"))) \
            .drop("_blk", "_lag", "_prev_bmax", "_g", "_b")
