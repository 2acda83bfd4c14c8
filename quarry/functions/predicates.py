"""Search predicates as Spark ``Column`` expressions.

They are ordinary boolean Columns: Catalyst pushes the scalar ones (``term`` on
a keyword, ``range_``, ``terms``) into the Parquet scan, and the text ones stay
in the same codegen stage as the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.analysis import Analyzer, all_text, text_tokens


def _c(c: Column | str) -> Column:
    return F.col(field(c)) if isinstance(c, str) else c


def field(path: str) -> str:
    """Field path resolver (P14): ``a__b__keyword`` / ``a.b.keyword`` -> ``a.b``.

    ``__`` stands for a dot and a trailing ``keyword`` names the raw (keyword)
    form, which is the column itself.
    """
    p = path.replace("__", ".")
    if p.endswith(".keyword"):
        p = p[: -len(".keyword")]
    return p


def _literal_tokens(text: str | Sequence[str], analyzer: Analyzer) -> Column:
    if hasattr(analyzer, "query_tokens"):
        parts = [text] if isinstance(text, str) else text
        return F.array(*[F.lit(t) for p in parts for t in analyzer.query_tokens(p)]).cast("array<string>")
    if isinstance(text, str):
        return analyzer(F.lit(text))
    return F.array_distinct(F.flatten(F.array(*[analyzer(F.lit(t)) for t in text])))


def match(c: Column | str, text: str, analyzer: Analyzer = text_tokens,
          operator: str = "or", tokens: Column | None = None) -> Column:
    """Analysed full-text test (P1): the column's analyzer runs on the query text too.

    ``operator="or"`` (default) is true when any query token occurs, ``"and"``
    when all do. Pass ``tokens`` when a token column already exists (T9/T11).

    For the default analyzer every token is a substring of ``lower(text)``, so a
    cheap ``contains`` test runs first and the regex split only runs on rows
    that can match. The query tokens are a constant expression, folded once by
    Catalyst. An analyzer that Catalyst cannot fold has ``query_tokens(text)``, and may
    have ``common_part(token)``: a substring of every word that gives this token, and
    ``restricted(column, tokens)``: what it gives of the words that may give one of these tokens.
    """
    q = _literal_tokens(text, analyzer)
    if tokens is not None:
        doc_tokens = tokens
    elif hasattr(analyzer, "restricted") and isinstance(text, str):
        doc_tokens = analyzer.restricted(_c(c), analyzer.query_tokens(text))
    else:
        doc_tokens = analyzer(_c(c))
    if operator == "and":
        test = (F.size(q) > 0) & (F.size(F.array_except(q, doc_tokens)) == 0)
    else:
        test = F.arrays_overlap(doc_tokens, q)
    words = []
    if tokens is None and analyzer is text_tokens and isinstance(text, str) and text.isascii():
        words = _python_words(text)
    elif tokens is None and hasattr(analyzer, "common_part") and isinstance(text, str):
        words = [analyzer.common_part(t) for t in analyzer.query_tokens(text)]
    if words:
        low = F.lower(_c(c))
        pre = [low.contains(w) for w in words]
        gate = reduce(lambda a, b: a & b, pre) if operator == "and" else reduce(lambda a, b: a | b, pre)
        return gate & test
    return test


def _python_words(text: str) -> list[str]:
    """Substrings that every matching document must contain (a pre-filter only).

    Used solely to skip rows cheaply; the exact test is the Spark expression.
    Only called for ASCII query text, where Python and the JVM agree on case
    and on the letter/digit classes, so each piece is a query token and hence a
    substring of the lower-cased document text.
    """
    return [p for p in re.split(r"[^a-z0-9]+", text.lower()) if p]


def term(c: Column | str, value, array: bool = False) -> Column:
    """Exact, not analysed (P2/P3): equality on a scalar, membership on a token array."""
    col = _c(c)
    return F.array_contains(col, F.lit(value)) if array else col == F.lit(value)


def terms(c: Column | str, values: Iterable, array: bool = False) -> Column:
    """Any of a list (P4): ``isin`` on scalars, ``arrays_overlap`` on arrays."""
    vals = list(values)
    col = _c(c)
    if array:
        return F.arrays_overlap(col, F.array(*[F.lit(v) for v in vals]))
    return col.isin(vals)


def range_(c: Column | str, gt=None, gte=None, lt=None, lte=None) -> Column:
    """Range test (P5). Bounds are literals (dates, timestamps, numbers, strings)."""
    col = _c(c)
    conds = []
    if gt is not None:
        conds.append(col > F.lit(gt))
    if gte is not None:
        conds.append(col >= F.lit(gte))
    if lt is not None:
        conds.append(col < F.lit(lt))
    if lte is not None:
        conds.append(col <= F.lit(lte))
    if not conds:
        return col.isNotNull()
    return reduce(lambda a, b: a & b, conds)


def not_(pred: Column) -> Column:
    """``must_not`` (P9): rows where the predicate is false *or unknown* are kept."""
    return ~F.coalesce(pred, F.lit(False))


def all_of(preds: Sequence[Column]) -> Column:
    """``must`` / AND."""
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(preds: Sequence[Column]) -> Column:
    """``should`` / OR."""
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def at_least(preds: Sequence[Column], n: int) -> Column:
    """At least ``n`` of the clauses are true (P8); unknown counts as false."""
    hits = reduce(lambda a, b: a + b,
                  [F.coalesce(p, F.lit(False)).cast("int") for p in preds], F.lit(0))
    return hits >= F.lit(n)


def bool_query(must: Sequence[Column] = (), must_not: Sequence[Column] = (),
               should: Sequence[Column] = (), filter: Sequence[Column] = (),
               minimum_should_match: int | None = None) -> Column:
    """Combined boolean query (P11) as one predicate.

    ``should`` clauses are required (at least one) only when there is no
    ``must``/``filter`` clause, unless ``minimum_should_match`` says otherwise.
    ``filter`` and ``must`` select the same rows; they differ only in scoring,
    which ``quarry.operators.search`` handles.
    """
    # Positive clauses stay bare so Catalyst can push them into the scan; an
    # unknown (NULL) clause already rejects the row in a WHERE.
    parts: list[Column] = list(must) + list(filter)
    parts += [not_(p) for p in must_not]
    msm = minimum_should_match
    if msm is None:
        msm = 1 if should and not (must or filter) else 0
    if should and msm > 0:
        parts.append(at_least(list(should), msm))
    return all_of(parts)


def any_field(df: DataFrame, text: str, analyzer: Analyzer = text_tokens,
              exclude: Sequence[str] = ()) -> Column:
    """Search every string column of the row (P12); query words are OR-ed."""
    return match(all_text(df, exclude), text, analyzer)


def nested(arr: Column | str, cond: Callable[[Column], Column]) -> Column:
    """Predicate on an array of structs (P15): all conditions hold on one element."""
    return F.exists(_c(arr), lambda el: F.coalesce(cond(el), F.lit(False)))


def child_matches(children: DataFrame, parent_key: str,
                  cond: Callable[[DataFrame], Column]) -> DataFrame:
    """P15 on a flat child table: distinct parent keys with at least one matching child.

    Same meaning as ``nested`` over ``collect_list(struct(...))`` per parent, but
    it never builds the array, so a parent with a huge number of children is
    just a partially aggregated key.
    """
    return children.where(F.coalesce(cond(children), F.lit(False))) \
                   .select(parent_key).distinct()
