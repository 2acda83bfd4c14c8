"""Text analysis as Column expressions (tokenizers and token filters).

Every analyzer is a plain ``Column -> Column`` function returning
``array<string>``, so it stays inside whole-stage codegen and composes with
``make_analyzer``; so does the English stemmer (``quarry.functions.stem``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Analyzer = Callable[[Column], Column]

# Token boundaries of the default text analyzer are runs of
# characters that are neither letters nor digits (Unicode classes).
WORD_SPLIT = r"[^\p{L}\p{N}]+"
# Fixed value: the pattern-capture filter of the file-name analyzer keeps the
# part of a token before its first dot.
EXTENSION_CAPTURE = r"^([^\.]+)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _non_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != F.lit(""))


def lowercase(tokens: Column) -> Column:
    """Lowercase token filter (T4), on an array of tokens."""
    return F.transform(tokens, lambda t: F.lower(t))


def text_tokens(c: Column | str) -> Column:
    """Default text analyzer (T1): lowercase, split on non letter/digit runs."""
    return _non_empty(F.split(F.lower(_c(c)), WORD_SPLIT))


def path_tokens(c: Column | str, delimiter: str = "/", lower: bool = True) -> Column:
    """Path hierarchy tokenizer (T3, with T4): ``a/b/c`` -> ``a``, ``a/b``, ``a/b/c``.

    A leading delimiter stays on the tokens (``/abs/x`` -> ``/abs``, ``/abs/x``);
    the empty prefix it would create is dropped.
    """
    src = F.lower(_c(c)) if lower else _c(c)
    parts = F.split(src, "\\" + delimiter if delimiter in ".^$|?*+()[]{}\\" else delimiter)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, F.lit(1), i), delimiter),
    )
    return F.when(src.isNull(), F.lit(None)).otherwise(_non_empty(prefixes))


def pattern_capture(tokens: Column, pattern: str = EXTENSION_CAPTURE,
                    preserve_original: bool = True) -> Column:
    """Pattern capture token filter (T5): adds group 1 of ``pattern`` per token.

    Empty captures (no match) are dropped; duplicates are removed.
    """
    def expand(t: Column) -> Column:
        cap = F.regexp_extract(t, pattern, 1)
        return F.array(t, cap) if preserve_original else F.array(cap)

    return F.array_distinct(_non_empty(F.flatten(F.transform(tokens, expand))))


def make_analyzer(tokenizer: Analyzer, *filters: Callable[[Column], Column]) -> Analyzer:
    """Analyzer = tokenizer followed by token filters."""
    def analyze(c: Column | str) -> Column:
        out = tokenizer(_c(c))
        for f in filters:
            out = f(out)
        return out
    return analyze


#: path tokenizer + lowercase, as declared for commit file names
file_path_analyzer: Analyzer = make_analyzer(lambda c: path_tokens(c, lower=False), lowercase)
#: path tokenizer + lowercase + capture of the part before the extension
file_name_analyzer: Analyzer = make_analyzer(
    lambda c: path_tokens(c, lower=False), lowercase, pattern_capture)


def analyze_array(arr: Column | str, analyzer: Analyzer, distinct: bool = False) -> Column:
    """Analyze every element of an array column and concatenate the tokens."""
    out = F.flatten(F.transform(_c(arr), lambda x: analyzer(x)))
    return F.array_distinct(out) if distinct else out


def with_token_field(df: DataFrame, column: str, analyzer: Analyzer = text_tokens,
                     suffix: str = "_tokens") -> DataFrame:
    """Multi-field (T9): keep the raw column (keyword form), add its token form."""
    return df.withColumn(column.replace(".", "_") + suffix, analyzer(F.col(column)))


def token_rows(df: DataFrame, id_col: str, tokens: Column, token_col: str = "token",
               pos_col: str | None = "position") -> DataFrame:
    """One row per (document, token) (T7): the analyzer output as a table."""
    if pos_col:
        return df.select(F.col(id_col), F.posexplode(tokens).alias(pos_col, token_col)) \
                 .withColumn(pos_col, F.col(pos_col).cast("bigint"))
    return df.select(F.col(id_col), F.explode(tokens).alias(token_col))


def url_path(url: Column | str, keep_host: bool = True) -> Column:
    """File-path stand-in from a URL: host + path (or path only), cut at ``?`` and ``#``."""
    if keep_host:
        return F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^?#]*)", 1)
    return F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*)", 1)


def analyze_literal(spark, text: str, analyzer: Analyzer = text_tokens) -> list[str]:
    """Tokens of one query string, computed by the same Spark expression as the data.

    An inline row with a constant expression is folded while the plan is made, so no job runs.
    """
    row = spark.sql("VALUES (1)").select(analyzer(F.lit(text)).alias("t")).first()
    return list(row["t"] or [])


def _strings_in(c: Column, kind, path: str, exclude: set) -> Column | None:
    """All strings of a value joined by a space, whatever its nesting; None when it has none."""
    from pyspark.sql import types as T
    if path in exclude:
        return None
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.StructType):
        parts = [_strings_in(c.getField(f.name), f.dataType, f"{path}.{f.name}", exclude) for f in kind.fields]
        parts = [p for p in parts if p is not None]
        return F.concat_ws(" ", *parts) if parts else None
    if isinstance(kind, T.MapType):
        return _strings_in(F.map_values(c), T.ArrayType(kind.valueType), path, exclude - {path})
    if isinstance(kind, T.ArrayType):
        if _strings_in(F.lit(None), kind.elementType, path, exclude) is None:
            return None
        return F.concat_ws(" ", F.transform(c, lambda x: _strings_in(x, kind.elementType, path, exclude)))
    return None


def all_text(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """All strings of a row joined by a space: the input of any-field search.

    Strings inside structs, arrays, arrays of structs and map values count; ``exclude``
    names dotted paths.
    """
    parts = [_strings_in(F.col(f"`{f.name}`"), f.dataType, f.name, set(exclude)) for f in df.schema.fields]
    return F.concat_ws(" ", *[p for p in parts if p is not None])
