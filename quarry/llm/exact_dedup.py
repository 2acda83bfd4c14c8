"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, maybe_in, stored, table

# Parts that rows with one key and one text are dealt to before one of them is picked.
_SALTS = 64
# A lone space needs no replacing, so only longer runs and other blanks are matched.
_RUNS = f"[{BLANK}]{{2,}}|[\\x09-\\x0D]"


def normalised(text: Column) -> Column:
    """The text with each run of blanks replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def exact_dedup(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                prefix_chars: int = 128, digest: str | None = None) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size`` and ``kept``, and, if a name for it is
    given, the full hash of every row's normalised text as column ``digest``.

    Rows are equal when their normalised texts are. Lengths that occur once, then
    (length, prefix hash) pairs that occur once, settle their rows; only the rest have
    their full SHA-256 taken. The first two steps shuffle lengths and hashes. The pairs that are left are a
    bitmap that the scan tests rows against, so settled rows never move, and the full
    hash is taken where a row is read: texts are shuffled only as columns of the result's duplicates.
    Counts combine map-side, so a group of a third of all rows sends one
    partial row per task; the join of the duplicates is one that AQE splits when skewed.

    Defined cases: a null text is empty; of equal rows the smallest key stays, null keys
    last, and of rows that also share the key exactly one (they are dealt to ``_SALTS`` parts
    before one is picked); an empty table gives no rows; input columns named like a
    result column are replaced. Names starting ``__`` are reserved and raise a ``ValueError``.
    """
    taken = [c for c in docs.columns if c.startswith("__")]
    if taken:
        raise ValueError(f"reserved column names: {taken}")
    norm, raw = normalised(F.col(text)), F.xxhash64(F.col(text))
    base = docs.drop("keep_id", "group_size", "kept", *([digest] if digest else []))
    shapes = stored(spark, base.select(F.length(norm).alias("__len"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("__prefix"), raw.alias("__raw"))
                    .groupBy("__len", "__prefix", "__raw").agg(F.count("*").alias("n")), "length-and-prefix")
    lengths = shapes.groupBy("__len").agg(F.sum("n").alias("all")).where("all > 1").select("__len")
    pairs = (shapes.join(lengths, "__len", "left_semi").groupBy("__len", "__prefix").agg(F.sum("n").alias("all"))
             .where("all > 1").select("__len", "__prefix"))
    heads = stored(spark, shapes.join(pairs, ["__len", "__prefix"], "left_semi").select(F.col("__raw").alias("raw")), "open-texts")
    open_ = maybe_in(spark, heads, "raw")(raw)
    left = base.withColumn("__open", open_)
    again = left.where("__open").withColumn("__full", F.sha2(norm, 256)).drop("__open")

    by_key = again.groupBy("__full", F.col(key).alias("__key")).agg(F.count("*").alias("__same"))
    first = F.min(F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("key"), F.col("__same").alias("same")))
    groups = stored(spark, by_key.groupBy("__full").agg(first.alias("__first"), F.sum("__same").alias("__n")), "equal-texts")
    decided = again.join(groups, "__full")
    is_first = F.col(key).eqNullSafe(F.col("__first.key"))
    repeats = F.col("__first.same") > 1

    # rows that share text and key: one of each part, then one of these
    same = decided.where(repeats & is_first).withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS))).repartition("__full", "__part")
    one = F.row_number().over(Window.partitionBy("__full", "__part").orderBy("__part"))
    same = same.withColumn("__one", one == 1)
    pick = F.row_number().over(Window.partitionBy("__full", F.when(F.col("__one"), F.lit(-1)).otherwise(F.col("__part"))).orderBy("__part"))
    same = same.withColumn("kept", F.col("__one") & (pick == 1))

    def result(rows, keep, size, full):
        named = [full.alias(digest)] if digest else []
        return rows.select(*base.columns, keep.alias("keep_id"), size.cast("long").alias("group_size"), "kept", *named)
    size, full = F.col("__n"), F.col("__full")
    return (result(left.where("not __open").withColumn("kept", F.lit(True)), F.col(key), F.lit(1), F.sha2(norm, 256))
            .union(result(decided.where(~(repeats & is_first)).withColumn("kept", is_first), F.col("__first.key"), size, full))
            .union(result(same, F.col("__first.key"), size, full)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(spark, docs, digest="text_sha256").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of equal texts stays."""
    return exact_dedup(spark, docs).where("kept").select(*docs.columns)


ORACLE = """
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""
