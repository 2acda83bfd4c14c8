"""Commit records (S1, S11, U3): schemas and the reader of exported records.

The walk of a repository on disk is a single-machine step and is not built;
the reader starts from commit records exported as JSON lines, one per commit,
in the raw form a git library gives (epoch seconds, parent objects, per-file
stats map).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.analysis import analyze_array, file_path_analyzer, text_tokens
from quarry.operators.stemming import english_analyzer
from quarry.functions.project import from_epoch_seconds, keys_of, pluck, record, subject
from quarry.operators.ingest import create_table
from quarry.sources.tables import scan_tables

PERSON = T.StructType([T.StructField("name", T.StringType()), T.StructField("email", T.StringType())])
STATS = T.StructType([T.StructField(n, T.LongType()) for n in ("insertions", "deletions", "lines", "files")])

#: raw exported record, as read
RAW_COMMIT = T.StructType([
    T.StructField("hexsha", T.StringType()),
    T.StructField("committed_date", T.LongType()),
    T.StructField("committer", PERSON),
    T.StructField("authored_date", T.LongType()),
    T.StructField("author", PERSON),
    T.StructField("message", T.StringType()),
    T.StructField("parents", T.ArrayType(T.StructType([T.StructField("hexsha", T.StringType())]))),
    T.StructField("stats", T.StructType([
        T.StructField("files", T.MapType(T.StringType(), STATS)),
        T.StructField("total", STATS)])),
])

#: the commit table
COMMIT = T.StructType([
    T.StructField("_id", T.StringType(), False),
    T.StructField("repository", T.StringType()),
    T.StructField("committed_date", T.TimestampType()),
    T.StructField("committer", PERSON),
    T.StructField("authored_date", T.TimestampType()),
    T.StructField("author", PERSON),
    T.StructField("description", T.StringType()),
    T.StructField("parent_shas", T.ArrayType(T.StringType())),
    T.StructField("files", T.ArrayType(T.StringType())),
    T.StructField("stats", STATS),
])

FILE_DIFF = T.StructType([T.StructField("filename", T.StringType()),
                          T.StructField("patch", T.StringType())])

#: the entity-class form of a commit (author as text, files as nested diffs)
COMMIT_V2 = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("committed_date", T.TimestampType()),
    T.StructField("author", T.StringType()),
    T.StructField("files", T.ArrayType(FILE_DIFF)),
])


def commits_from_raw(raw: DataFrame, repository: str) -> DataFrame:
    """One nested commit row per raw record."""
    return raw.select(
        F.col("hexsha").alias("_id"),
        F.lit(repository).alias("repository"),
        from_epoch_seconds("committed_date").alias("committed_date"),
        record(name="committer.name", email="committer.email").alias("committer"),
        from_epoch_seconds("authored_date").alias("authored_date"),
        record(name="author.name", email="author.email").alias("author"),
        F.col("message").alias("description"),
        pluck("parents", "hexsha").alias("parent_shas"),
        keys_of("stats.files").alias("files"),
        F.col("stats.total").alias("stats"),
    )


def read_commits(spark: SparkSession, path: str, repository: str) -> DataFrame:
    """Read exported commit records (JSON lines) with a fixed schema."""
    return commits_from_raw(spark.read.schema(RAW_COMMIT).json(path), repository)


def with_analysed_fields(commits: DataFrame) -> DataFrame:
    """Token forms of the analysed commit columns."""
    return (commits
            .withColumn("description_tokens", english_analyzer("description"))
            .withColumn("files_tokens", analyze_array("files", file_path_analyzer, distinct=True))
            .withColumn("author_name_tokens", text_tokens("author.name"))
            .withColumn("committer_name_tokens", text_tokens("committer.name")))


def with_computed_columns(df: DataFrame) -> DataFrame:
    """Entity-class rows (S11/U1): the declared columns plus ``subject``."""
    return df.withColumn("subject", subject("description"))


@dataclass
class EntityTable:
    """An entity class over the tables of a name pattern (S11): its declared columns and its computed ones.

    Rows have ``_id``, ``_index`` (the table a row is from), the declared columns, null where a
    table lacks one, and the computed columns, which are expressions over the declared ones.
    """

    pattern: str
    schema: T.StructType
    computed: dict[str, Callable[[], Column]] = field(default_factory=lambda: {"subject": lambda: subject("description")})
    id_column: str = "_id"

    def init(self, spark: SparkSession, path: str) -> None:
        """Create one table of the class, if it is not there."""
        create_table(spark, path, T.StructType([T.StructField(self.id_column, T.StringType()), *self.schema.fields]))

    def search(self, spark: SparkSession, base: str | None = None, database: str | None = None, where: Column | None = None) -> DataFrame:
        """The rows of all tables that match the pattern, below a path or in the catalog; ``where`` sees the tables' own columns."""
        rows = scan_tables(spark, self.pattern, base, database)
        rows = rows if where is None else rows.where(where)
        declared = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        own = rows.select(F.col(self.id_column).cast("string").alias("_id"), "_index", *declared)
        return own.select("*", *[made().alias(name) for name, made in self.computed.items()])


def commit_edges(commits: DataFrame) -> DataFrame:
    """Commit graph edges child -> parent (one row per parent)."""
    return commits.select(F.col("_id").alias("child"), F.explode("parent_shas").alias("parent"))
