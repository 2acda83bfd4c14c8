"""Table scans."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ingest import grow_schema
from quarry.sources.files import matching_paths


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """Single-table scan (S6): a Parquet path or a catalog table name."""
    if "/" in source or ":" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def scan_pattern(spark: SparkSession, tables: Mapping[str, DataFrame | str],
                 pattern: str = "*") -> DataFrame:
    """Scan every table whose name matches ``pattern`` (S7; ``*`` = all, S8).

    Tables are unioned by column name, missing columns become NULL (K10), and
    ``_index`` tells which table a row came from.
    """
    names = sorted(n for n in tables if fnmatch.fnmatchcase(n, pattern))
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    dfs = []
    for n in names:
        src = tables[n]
        df = read_table(spark, src) if isinstance(src, str) else src
        dfs.append(df.withColumn("_index", F.lit(n)))
    return grow_schema(*dfs)


def find_tables(spark: SparkSession, pattern: str = "*", base: str | None = None,
                database: str | None = None) -> dict[str, str]:
    """The tables that exist and whose name matches ``pattern``, as name -> path or catalog name.

    With ``base``, tables are the Parquet folders and files right below that path, local or
    remote; a name is the last part of the path without ``.parquet``, and names
    that begin with ``_`` or ``.`` are no tables. Without it, they are the tables and views of the
    catalog (of ``database``, or the current one). One listing, whatever the tables' size.
    """
    if base is not None:
        paths = {p.rsplit("/", 1)[1].removesuffix(".parquet"): p for p in matching_paths(spark, f"{base.rstrip('/')}/*")}
        found = {n: p for n, p in paths.items() if not n.startswith(("_", "."))}
    else:
        tables = spark.catalog.listTables(database)
        found = {t.name: t.name if t.isTemporary else ".".join(f"`{x}`" for x in [*(t.namespace or []), t.name]) for t in tables}
    return {n: found[n] for n in sorted(found) if fnmatch.fnmatchcase(n, pattern)}


def scan_tables(spark: SparkSession, pattern: str = "*", base: str | None = None, database: str | None = None) -> DataFrame:
    """Scan all tables there are that match a name pattern (S7, S8): see ``find_tables`` and ``scan_pattern``."""
    return scan_pattern(spark, find_tables(spark, pattern, base, database), pattern)


def spread(df: DataFrame, keys: Sequence[str] = (), min_partitions: int | None = None) -> DataFrame:
    """Hash-partition an input that has fewer splits than the cluster has cores.

    A file written as one row group is read by one task, so CPU-heavy
    per-row work after the scan (tokenizing, regex) would use one core. A large
    input already has many splits and is returned unchanged, so this never
    adds a shuffle of a big table. Filters still run below the repartition.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *[F.col(k) for k in keys]) if keys else df.repartition(target)


def lookup(df: DataFrame, key_col: str, value) -> DataFrame:
    """Point lookup by key (S9). With files sorted by the key, Parquet min/max
    statistics skip every row group but the one holding it."""
    return df.where(F.col(key_col) == F.lit(value))


def write_by_key(df: DataFrame, path: str, key: str, files: int, row_group_bytes: int = 32 << 20,
                 keys_per_group: int = 1 << 20) -> None:
    """Write a table for point lookups (S9): each file holds a range of the key, sorted, with
    a Bloom filter of the key per row group.

    A lookup then skips the files and row groups whose range excludes the key; where ranges
    overlap, in tables that were appended to, the Bloom filter skips what lacks it. Ranges come
    from a sample of the keys, so a frequent key does not make a large range.
    """
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("append")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys_per_group))
     .option("parquet.block.size", str(row_group_bytes)).parquet(path))


def lookup_many(df: DataFrame, key_col: str, values: Sequence) -> DataFrame:
    """The rows of a list of keys (S9), each key tested against row-group ranges and Bloom filters.

    The test is a balanced tree of equalities: an ``IN`` of many values would reach the
    scan as one range from the least to the greatest. For keys in a table, join it instead.
    """
    tests = [F.col(key_col) == F.lit(v) for v in dict.fromkeys(values)] or [F.lit(False)]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return df.where(tests[0])


def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Every result row, no page limit (S10), written by the executors."""
    df.write.mode("overwrite").format(fmt).save(path)
