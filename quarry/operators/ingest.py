"""Loading and changing tables.

Tables are Parquet folders. A keyed table is a series of immutable snapshots
``<path>/snapshot-<n>``, of which only whole ones are read, so a reader never
sees a half-written version and a replayed write produces the same snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.files import matching_paths

# Column that ranks equal versions by arrival while tables are folded.
ARRIVAL = "quarry_arrival"


# --- K1-K3: table creation -------------------------------------------------

def create_table(spark: SparkSession, path: str, schema: T.StructType,
                 if_exists: str = "ignore") -> None:
    """Create an empty table with a declared schema.

    ``if_exists="ignore"`` leaves an existing table alone (K1/K3);
    ``"error"`` raises when it exists (K2).
    """
    mode = {"ignore": "ignore", "error": "errorifexists"}[if_exists]
    spark.createDataFrame([], schema).write.mode(mode).parquet(path)


# --- K10: schema growth ------------------------------------------------------

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _check_compatible(a: T.DataType, b: T.DataType, path: str) -> None:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        bf = {f.name: f.dataType for f in b.fields}
        for f in a.fields:
            if f.name in bf:
                _check_compatible(f.dataType, bf[f.name], f"{path}.{f.name}")
        return
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        _check_compatible(a.elementType, b.elementType, path + "[]")
        return
    if a == b or (isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL)):
        return
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return
    raise ValueError(f"column {path!r} has clashing types {a.simpleString()} "
                     f"and {b.simpleString()}")


def grow_schema(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns (nested ones too) missing on a side become NULL.

    Two columns of one name with clashing types raise instead of being coerced.
    """
    first = dfs[0]
    for other in dfs[1:]:
        _check_compatible(first.schema, other.schema, "")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# --- K4: keyed upsert --------------------------------------------------------

def _hashable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if "map<" not in df.schema[c].dataType.simpleString()]


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Keep the last row per key, "last" by the ``order`` columns (a version).

    Written as ``max_by`` in a group-by, so it is combined partially on the map
    side: a key with millions of versions sends one row per task to the shuffle. Of equal
    versions the row with the largest content hash wins, so reruns agree; to rank
    them by arrival, give an arrival column as the last of ``order`` (as ``upsert`` does).
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    version = F.struct(*[F.col(c) for c in order], F.xxhash64(*_hashable(df, payload)) if _hashable(df, payload) else F.lit(0))
    row = F.struct(*[F.col(c) for c in payload])
    return df.groupBy(*keys).agg(F.max_by(row, version).alias("_row")) \
             .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def latest_of(parts: Sequence[tuple[int, DataFrame]], key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """The newest version per key of several frames, each with its arrival: of equal versions the later arrival wins."""
    grown = grow_schema(*[df.withColumn(ARRIVAL, F.lit(at).cast("bigint")) for at, df in parts])
    return latest_per_key(grown, key, [*order, ARRIVAL]).drop(ARRIVAL)


def upsert(base: DataFrame | None, changes: DataFrame, key: Sequence[str] | str,
           order: Sequence[str]) -> DataFrame:
    """Insert or replace by key (K4): the newest version of each key wins; of equal
    versions the change, since it arrived later than the base row."""
    if base is None:
        return latest_per_key(changes, key, order).select(*changes.columns)
    cols = base.columns + [c for c in changes.columns if c not in base.columns]
    return latest_of([(0, base), (1, changes)], key, order).select(*cols)


# A folder ``<path>/<prefix><n>`` is version n of something. Spark puts ``_SUCCESS`` into a
# folder after all its files, so a folder with that file is whole, and one that a crash
# left behind has none and is never read. There is no other record of what is committed.
SNAPSHOT = "snapshot-"


def versions(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """The whole folders ``<path>/<prefix><n>``, by n."""
    found = [f.rsplit("/", 1)[0] for f in matching_paths(spark, f"{path.rstrip('/')}/{prefix}*/_SUCCESS")]
    return {int(f.rsplit("/", 1)[1][len(prefix):]): f for f in found}


def _write_version(df: DataFrame, path: str, prefix: str, version: int) -> None:
    """Write version ``version``, in place of what a crashed run left there."""
    spark, name = df.sparkSession, f"{prefix}{version:012d}"
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    if version not in versions(spark, path, prefix):
        raise RuntimeError(f"{path}/{name} has no _SUCCESS file, which marks whole folders here: "
                           "mapreduce.fileoutputcommitter.marksuccessfuljobs must be on")


def _before(known: dict[int, str], version: int | None) -> int | None:
    return max((v for v in known if version is None or v < version), default=None)


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    known = versions(spark, path, SNAPSHOT)
    return spark.read.parquet(known[max(known)]) if known else None


def upsert_table(spark: SparkSession, path: str, changes: DataFrame, key, order,
                 version: int) -> DataFrame:
    """Apply ``changes`` to the keyed table at ``path`` as snapshot ``version``.

    The base is the newest whole snapshot before ``version``, so a replayed batch gives the
    same table whether it had failed before, during or after its write.
    """
    known = versions(spark, path, SNAPSHOT)
    at = _before(known, version)
    base = None if at is None else spark.read.parquet(known[at])
    _write_version(upsert(base, changes, key, order), path, SNAPSHOT, version)
    return read_current(spark, path)


# --- K5: unkeyed append ------------------------------------------------------

def with_generated_id(df: DataFrame, content_key: bool = False, name: str = "_id") -> DataFrame:
    """Add a key to keyless rows (K5).

    ``uuid()`` gives a fresh key per row (a rerun appends again); with
    ``content_key=True`` the key is a SHA-256 of the row, so loading the same
    rows twice yields the same keys and a keyed write stays idempotent; equal rows of
    one load share a key, so a keyed write keeps one of them.
    """
    if content_key:
        return df.withColumn(name, F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256))
    return df.withColumn(name, F.expr("uuid()"))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


# --- K6: partial update ------------------------------------------------------

def partial_update(base: DataFrame, updates: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """Merge given fields into existing rows by key (K6).

    ``updates`` holds the key and one column per field; NULL means "not given".
    Several updates of one key are folded first (per field, the value with the
    highest ``seq`` wins), so the join sees at most one update row per key.
    Fields unknown to ``base`` become new columns. Returns ``(table, errors)``;
    updates of keys without a row are errors, not inserts.
    """
    fields = [c for c in updates.columns if c not in (key, seq)]
    order = F.col(seq)
    folded = updates.groupBy(key).agg(*[
        F.max(F.when(F.col(f).isNotNull(), F.struct(order.alias("s"), F.col(f).alias("v"))))
         .getField("v").alias(f) for f in fields])
    u = folded.select(F.col(key), *[F.col(f).alias(f"_u_{f}") for f in fields])
    joined = base.join(u, key, "left")
    out_cols: list[Column] = []
    for c in base.columns:
        out_cols.append(F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in fields else F.col(c))
    out_cols += [F.col(f"_u_{f}").alias(f) for f in fields if f not in base.columns]
    errors = folded.join(base.select(key), key, "left_anti") \
                   .withColumn("_error", F.lit("document_missing"))
    return joined.select(*out_cols), errors


# --- K7-K9: typed load with quarantine --------------------------------------

def typed_load(raw: DataFrame, schema: T.StructType, raw_columns: Sequence[str] | None = None) -> DataFrame:
    """Coerce string columns to a declared schema, tagging failures (K7/K9).

    Each declared column is ``try_cast``; a non-NULL input that gives NULL is
    recorded in ``_errors``. Columns not in ``schema`` pass through unchanged.
    The result has the typed columns, ``_errors`` and ``_raw`` (the input of all columns, or of
    ``raw_columns``, as text) for the quarantine.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    typed, bad = [], []
    for c in raw.columns:
        if c in declared:
            cast = F.col(c).try_cast(declared[c])
            typed.append(cast.alias(c))
            bad.append(F.when(F.col(c).isNotNull() & cast.isNull(), F.lit(c)))
        else:
            typed.append(F.col(c))
    errs = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<string>")
    return raw.select(*typed, errs.alias("_errors"),
                      F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in (raw_columns or raw.columns)])).alias("_raw"))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("_errors") == 0).drop("_errors", "_raw")


def quarantined(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("_errors") > 0)


def outcomes(tagged: DataFrame, schema: T.StructType) -> DataFrame:
    """Per-record outcome (K7): the tagged rows with ``status`` and, for a rejected one,
    ``reason``: each failed column, its text and the declared type it cannot be read as; an
    error that is not a column's (``field count``) is given as it is, with the record."""
    reasons = F.array(*[F.when(F.array_contains("_errors", f.name), F.concat(
        F.lit(f"{f.name}: "), F.coalesce(F.get_json_object("_raw", f"$['{f.name}']"), F.lit("null")), F.lit(f" is not {f.dataType.simpleString()}")))
        for f in schema.fields])
    names = [f.name for f in schema.fields]
    others = F.transform(F.filter("_errors", lambda e: ~e.isin(names)), lambda e: F.concat(e, F.lit(": "), F.col("_raw")))
    reasons = F.concat(reasons, others)
    bad = F.size("_errors") > 0
    return (tagged.withColumn("status", F.when(bad, F.lit("rejected")).otherwise(F.lit("accepted")))
            .withColumn("reason", F.when(bad, F.array_join(reasons, "; "))))


def load_summary(tagged: DataFrame) -> DataFrame:
    """Accepted and failed counts (K8) in one pass."""
    return tagged.agg(F.count_if(F.size("_errors") == 0).alias("accepted"),
                      F.count_if(F.size("_errors") > 0).alias("failed"))


def write_typed(tagged: DataFrame, path: str) -> None:
    """Write accepted and quarantined rows in one pass, split by a status folder."""
    status = F.when(F.size("_errors") == 0, F.lit("ok")).otherwise(F.lit("quarantine"))
    tagged.withColumn("_status", status).write.mode("overwrite").partitionBy("_status").parquet(path)


@dataclass
class TypedFrame:
    """A typed load: its tagged rows and the views of them."""
    tagged: DataFrame

    @property
    def rows(self) -> DataFrame:
        return accepted(self.tagged)

    @property
    def quarantine(self) -> DataFrame:
        return quarantined(self.tagged)

    @property
    def summary(self) -> DataFrame:
        return load_summary(self.tagged)


# --- K4 at scale: base snapshot + change log, merged on read -----------------

# Partition column of the change log; a user column of this name is not supported.
LOG_BATCH = "quarry_batch"


class ChangeLogTable:
    """A keyed table stored as a base snapshot plus per-batch change files.

    Writing a batch costs the batch, not the table: its rows, folded to the
    newest version per key, go to ``log/quarry_batch=<id>`` (overwritten on replay).
    Reading folds the newest whole base and the whole log batches after it with one
    partially aggregated ``max_by``; of equal versions the later batch wins. Only those folders
    are opened, and batches of different schemas are read apart and grown together.
    ``compact`` writes that fold as the next base.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] | str,
                 order: Sequence[str]):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.order = key, list(order)

    def append_changes(self, changes: DataFrame, batch_id: int) -> None:
        _write_version(latest_per_key(changes, self.key, self.order), f"{self.path}/log", f"{LOG_BATCH}=", batch_id)

    def _log(self, after: int | None, upto: int | None) -> list[DataFrame]:
        """The batches after a base, one frame per schema, with their batch as arrival."""
        by_schema: dict[str, list[str]] = {}
        for batch, folder in sorted(versions(self.spark, f"{self.path}/log", f"{LOG_BATCH}=").items()):
            if (after is None or batch > after) and (upto is None or batch <= upto):
                by_schema.setdefault(self.spark.read.parquet(folder).schema.json(), []).append(folder)
        reader = self.spark.read.option("basePath", f"{self.path}/log")
        return [reader.parquet(*folders).withColumn(ARRIVAL, F.col(LOG_BATCH).cast("bigint")).drop(LOG_BATCH)
                for folders in by_schema.values()]

    def current(self, upto: int | None = None) -> DataFrame:
        bases = versions(self.spark, self.path, SNAPSHOT)
        at = _before(bases, None if upto is None else upto + 1)
        parts = self._log(at, upto)
        if at is not None:
            base = self.spark.read.parquet(bases[at])
            if not parts:
                return base
            parts.insert(0, base.withColumn(ARRIVAL, F.lit(-1).cast("bigint")))
        if not parts:
            raise ValueError(f"table {self.path} has no data")
        return latest_per_key(grow_schema(*parts), self.key, [*self.order, ARRIVAL]).drop(ARRIVAL)

    def compact(self, upto: int) -> None:
        """Fold everything up to batch ``upto`` into a new base (no-op if done)."""
        if max(versions(self.spark, self.path, SNAPSHOT), default=-1) < upto:
            _write_version(self.current(upto), self.path, SNAPSHOT, upto)
