"""Projections and scalar helpers for hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_present(*cols: Column | str) -> Column:
    """First non-null value."""
    return F.coalesce(*[_c(c) for c in cols])


# Date layouts tried, in order, when parsing date strings.
DATE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Parse a date string with the first layout that fits (J4); NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(_c(c), F.lit(f)) for f in formats])


def from_epoch_seconds(c: Column | str) -> Column:
    """Epoch seconds to timestamp (J5), interpreted in the session zone (UTC)."""
    return F.timestamp_seconds(_c(c))


def format_day(c: Column | str) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def first_line(c: Column | str) -> Column:
    """Text before the first newline."""
    return F.substring_index(_c(c), "\n", 1)


def prefix(c: Column | str, n: int) -> Column:
    """First ``n`` characters."""
    return F.left(_c(c), F.lit(n))


def pluck(arr: Column | str, name: str) -> Column:
    """Array of structs to the array of one member."""
    return F.transform(_c(arr), lambda el: el.getField(name))


def keys_of(m: Column | str) -> Column:
    """Map to its keys."""
    return F.map_keys(_c(m))


def record(**members: Column | str) -> Column:
    """Nested record."""
    return F.struct(*[_c(v).alias(k) for k, v in members.items()])


# The two output line formats.
HIT_LINE = "/%s/%s/%s (%s): %s"
BUCKET_LINE = "%15s: %3d commits changing %6d lines"


def hit_meta(df: DataFrame, index: str, id_col: str) -> DataFrame:
    """Metadata columns of a hit (J2): ``_index``, ``_type`` and ``_id``."""
    return df.withColumn("_index", F.lit(index)).withColumn("_type", F.lit("_doc")) \
             .withColumn("_id", F.col(id_col).cast("string"))


def hit_line(index: Column | str, type_: Column | str, id_: Column | str,
             created: Column | str, description: Column | str) -> Column:
    """``/index/type/id (yyyy-MM-dd): first line``."""
    return F.format_string(HIT_LINE, _c(index), _c(type_), _c(id_),
                           format_day(created), first_line(description))


def bucket_line(key: Column | str, doc_count: Column | str, total: Column | str) -> Column:
    """``%15s: %3d commits changing %6d lines``."""
    return F.format_string(BUCKET_LINE, _c(key),
                           _c(doc_count), _c(total))


def subject(description: Column | str, width: int = 80) -> Column:
    """Computed entity column (U1): first line, at most ``width`` characters."""
    return prefix(first_line(description), width)
