"""Delimited files with a header line and an optional type line."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ingest import TypedFrame, typed_load

# Names allowed in the type line and the column types they give.
TYPE_NAMES = {
    "STRING": T.StringType(),   # analysed text
    "CAT": T.StringType(),      # keyword
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
}
# How each type-line name is declared (text vs keyword form).
TYPE_KINDS = {"STRING": "text", "CAT": "keyword", "INT": "integer", "DOUBLE": "double"}


# Column of the text of records whose number of fields is not the header's.
MALFORMED = "quarry_malformed"
# Column of a record's place in its file while it is read: 0 is the header line.
RECORD = "quarry_record"
# A record of more text than this is an error: most likely a quote that is never closed.
RECORD_BYTES = 256 << 20


def _reader(spark: SparkSession, sep: str):
    return (spark.read.option("sep", sep).option("header", True)
            .option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("inferSchema", False))


def read_whole_files(spark: SparkSession, path: str, sep: str = ";", keep_malformed: bool = False) -> DataFrame:
    """Delimited source (S3/S5) by Spark's own reader: a file is one task.

    The plain form of ``read_delimited``, for files that are many and small.
    """
    plain = _reader(spark, sep).csv(path)
    if not keep_malformed:
        return plain
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*plain.columns, MALFORMED]])
    return (_reader(spark, sep).option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
            .schema(schema).csv(path))


class _Quotes:
    """Whether a line that begins outside or inside a quoted value ends inside one."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        whole = f'(?:"(?:[^"]|"")*+"[^{s}]*+|[^"{s}][^{s}]*+)?+'
        self.sep, self.value = sep, re.compile('(?:[^"]|"")*+')
        self.opens = re.compile(f'(?:{whole}{s})*+"(?:[^"]|"")*+')

    def after(self, line: str, inside: bool) -> bool:
        if inside:
            at = self.value.match(line).end()
            if at == len(line):
                return True
            at = line.find(self.sep, at + 1)
            if at < 0:
                return False
            line = line[at + len(self.sep):]
        return self.opens.fullmatch(line) is not None


def _states(sep: str, summary: bool):
    """Ordered lines with what is known of each if its split began outside (0) or inside (1) a quoted value.

    Lines without a quote leave the state as it is, so only the others are looked at one
    by one. With ``summary``, one row per split: the state at its end and the records begun in it.
    """
    quotes = _Quotes(sep)

    def run(batches):
        at, state, begun, line = None, [False, True], [0, 0], 0

        def total():
            return pa.RecordBatch.from_pydict({"file": [at[0]], "block": [at[1]], "end_0": [state[0]], "end_1": [state[1]],
                                               "begun_0": [begun[0]], "begun_1": [begun[1]]})
        for batch in batches:
            files, blocks, texts = (batch.column(c) for c in ("file", "block", "value"))
            where = list(zip(files.to_pylist(), blocks.to_pylist()))
            edges = [0, *[i for i in range(1, len(where)) if where[i] != where[i - 1]], len(where)]
            quoted = pc.match_substring(texts, '"').to_numpy(zero_copy_only=False)
            blank = pc.is_in(texts, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if where[lo] != at:
                    if summary and at is not None:
                        yield total()
                    at, state, begun, line = where[lo], [False, True], [0, 0], 0
                marks = np.flatnonzero(quoted[lo:hi])
                lines = texts.slice(lo, hi - lo).take(pa.array(marks)).to_pylist()
                out = {"file": files.slice(lo, hi - lo), "block": blocks.slice(lo, hi - lo), "line": pa.array(np.arange(line, line + hi - lo))}
                for h in (0, 1):
                    before, now, done = np.zeros(hi - lo, bool), state[h], 0
                    after = before.copy()
                    for i, text in zip(marks.tolist(), lines):
                        before[done: i + 1] = after[done:i + 1] = now
                        after[i] = now = quotes.after(text, now)
                        done = i + 1
                    before[done:] = after[done:] = now
                    starts = ~before & ~blank[lo:hi]
                    count = np.cumsum(starts)
                    out |= {f"before_{h}": pa.array(before), f"after_{h}": pa.array(after), f"record_{h}": pa.array(begun[h] + count - 1)}
                    state[h], begun[h] = now, begun[h] + int(count[-1])
                line += hi - lo
                if not summary:
                    yield pa.RecordBatch.from_pydict(out | {"value": texts.slice(lo, hi - lo)})
        if summary and at is not None:
            yield total()
    return run


def _records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, RECORD, text) of every record; blank lines are none.

    A file is read in splits like any text file. Whether a split begins inside a quoted
    value is the composition of what the splits before it do to either state, from one small row per
    split. Records on one line, nearly all, stay where they were read; only the
    lines of the others are shuffled, by record.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))
    splits = lines.mapInArrow(_states(sep, True), "file string, block long, end_0 boolean, end_1 boolean, begun_0 long, begun_1 long")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.col("end_0").cast("int") * (~F.col("end_1")).cast("int")).over(earlier), F.lit(0))
    splits = splits.withColumn("swaps", swaps)
    fixed = F.last(F.when(F.col("end_0") == F.col("end_1"), F.struct(F.col("end_0").cast("int").alias("v"), F.col("swaps").alias("s"))), ignorenulls=True).over(earlier)
    splits = splits.withColumn("fixed", fixed).withColumn(
        "inside", (F.coalesce(F.col("fixed.v"), F.lit(0)) + F.col("swaps") - F.coalesce(F.col("fixed.s"), F.lit(0))) % 2 == 1)
    begun = F.when(F.col("inside"), F.col("begun_1")).otherwise(F.col("begun_0"))
    splits = splits.select("file", "block", "inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("earlier"))

    known = lines.mapInArrow(_states(sep, False), "file string, block long, line long, before_0 boolean, after_0 boolean, record_0 long, "
                                                  "before_1 boolean, after_1 boolean, record_1 long, value string").join(splits, ["file", "block"])

    def choose(name):
        return F.when(F.col("inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    known = known.select("file", "block", "line", "value", choose("before").alias("before"), choose("after").alias("after"),
                         (choose("record") + F.col("earlier")).alias(RECORD))
    whole = known.where("not before and not after").where(~F.col("value").isin("", "\r")).select("file", RECORD, "value")
    parts = known.where("before or after")
    sizes = parts.groupBy("file", RECORD).agg(F.sum(F.octet_length("value") + 1).alias("size"))
    checked = F.when(F.col("size") <= RECORD_BYTES, F.col("value")).otherwise(F.raise_error(F.concat(
        F.lit("record "), F.col(RECORD).cast("string"), F.lit(" of "), F.col("file"), F.lit(" is too long: is a quote never closed?"))))
    joined = (parts.join(sizes, ["file", RECORD]).groupBy("file", RECORD)
              .agg(F.array_sort(F.collect_list(F.struct("block", "line", checked.alias("value")))).alias("lines"))
              .select("file", RECORD, F.array_join("lines.value", "\n").alias("value")))
    return whole.union(joined).select("file", RECORD, F.regexp_replace("value", "\r$", "").alias("text"))


def read_delimited(spark: SparkSession, path: str, sep: str = ";", keep_malformed: bool = False, record: bool = False) -> DataFrame:
    """Delimited source (S3/S5): header names the columns, every value a string.

    No schema inference: that would scan the data twice and still give
    strings here. CRLF line ends are accepted; values may be quoted, with quotes doubled and
    line breaks inside. A large file is read by many tasks: see ``_records``. With
    ``keep_malformed`` a record with too few or too many fields has its whole text in column
    ``MALFORMED``; with ``record`` its place in its file is in column ``RECORD`` (the first data line is 1).

    The columns are those of the first file; every file begins with a header line, which may
    differ in nothing but line ends. A quoted value that is never closed is an error once
    it is longer than ``RECORD_BYTES``. The order of rows is that of no file in particular.
    """
    columns = _reader(spark, sep).csv(path).columns
    parsed = F.from_csv("text", _ddl([*columns, MALFORMED]),
                        {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED})
    rows = _records(spark, path, sep).where(F.col(RECORD) > 0).select(F.col(RECORD), parsed.alias("r"))
    kept = [*columns, *([MALFORMED] if keep_malformed else [])]
    return rows.select(*[F.col("r").getField(c).alias(c) for c in kept], *([RECORD] if record else []))


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)


def schema_from_types(columns: list[str], type_names: list[str]) -> T.StructType:
    """Declared schema from a type line (S4). An unknown name is an error."""
    fields = []
    for c, t in zip(columns, type_names):
        if t not in TYPE_NAMES:
            raise ValueError(f"unknown type {t!r} for column {c!r}")
        fields.append(T.StructField(c, TYPE_NAMES[t], True))
    return T.StructType(fields)


def find_type_row(spark: SparkSession, path: str, sep: str = ";") -> list[str] | None:
    """The type line: the first data line of the first file; None in a file without data."""
    files = sorted(_reader(spark, sep).csv(path).inputFiles())
    first = _reader(spark, sep).csv(files[0]).head(1) if files else []
    return list(first[0]) if first else None


def load_typed_delimited(spark: SparkSession, path: str, sep: str = ";",
                         type_row: bool = True) -> TypedFrame | DataFrame:
    """Typed load of a delimited file with a type line (S4 + K7-K9).

    The first data line of each file is its type line, whatever other lines say. All files
    must declare the same types: a first data line that differs from the first
    file's goes to the quarantine as ``type line``. Records with a wrong number of fields go there
    whole, as ``field count``. A file without any data line gives no rows and untyped columns.

    ``type_row=False`` keeps the type line as a data row and every column a
    string (the behaviour of a plain bulk load of the reader). The whole text of records with a
    wrong number of fields is in a further column ``MALFORMED``, null for all others.
    """
    if not type_row:
        return read_delimited(spark, path, sep, keep_malformed=True)
    raw = read_delimited(spark, path, sep, keep_malformed=True, record=True)
    columns = [c for c in raw.columns if c not in (MALFORMED, RECORD)]
    names = find_type_row(spark, path, sep)
    schema = schema_from_types(columns, names or ["STRING"] * len(columns))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, names or [])], F.lit(True))
    first = F.col(RECORD) == 1
    tagged = typed_load(raw.where(~(first & same)), schema, columns)
    errors = (F.when(first, F.array(F.lit("type line"))).when(F.col(MALFORMED).isNotNull(), F.array(F.lit("field count")))
              .otherwise(F.col("_errors")))
    return TypedFrame(tagged.withColumn("_errors", errors).withColumn("_raw", F.coalesce(MALFORMED, "_raw")).drop(MALFORMED, RECORD))


def write_typed_delimited(df: DataFrame, path: str, type_names: dict[str, str],
                          sep: str = ";") -> None:
    """Write a table as delimited files, each with header and type line."""
    cols = df.columns
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])

    def with_type_line(batches):
        yield pa.RecordBatch.from_pydict({c: [type_names[c]] for c in cols})
        yield from batches
    (as_text.mapInArrow(with_type_line, as_text.schema).write.mode("overwrite").option("sep", sep)
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))
