"""Search: hits pages, BM25 ranking, totals."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.analysis import Analyzer, analyze_literal, text_tokens
from quarry.functions.predicates import bool_query, match

# BM25 parameters of the server's default similarity.
BM25_K1 = 1.2
BM25_B = 0.75
DEFAULT_PAGE_SIZE = 10


def page(df: DataFrame, k: int = DEFAULT_PAGE_SIZE, order: Sequence[Column] | None = None,
         id_col: str = "_id") -> DataFrame:
    """One page of hits, best first (L2/L3): planned as a per-task top-k plus merge."""
    keys = list(order) if order else []
    keys.append(F.col(id_col).asc())
    return df.orderBy(*keys).limit(k)


def hits_total(df: DataFrame, pred: Column | None = None, name: str = "total") -> DataFrame:
    """Exact number of hits of a query, as a one-row DataFrame."""
    src = df.where(pred) if pred is not None else df
    return src.agg(F.count(F.lit(1)).alias(name))


def bm25_score(docs: DataFrame, text_col: str, query: str, analyzer: Analyzer = text_tokens,
               k1: float = BM25_K1, b: float = BM25_B, tokens_col: str | None = None
               ) -> tuple[DataFrame, Column]:
    """Score the documents of ``docs`` for ``query`` with BM25.

    Returns ``(matches, score)``: the documents that contain at least one query
    token (each with a ``_tokens`` column) and the score expression to select on
    them. Corpus statistics (document count, mean length, per-token document
    frequency) are computed over the whole ``docs`` input in one aggregation
    pass and enter the score as a single scalar subquery: no join, no
    collect. Per term: ``idf * tf / (tf + k1 * (1 - b + b * dl / avgdl))`` with
    ``idf = ln(1 + (N - n + 0.5) / (n + 0.5))`` (Robertson & Zaragoza 2009; the
    constant ``k1 + 1`` factor is left out, which does not change the order).
    """
    spark = docs.sparkSession
    q_terms = analyze_literal(spark, query, analyzer)
    tok_expr = F.col(tokens_col) if tokens_col else analyzer(F.col(text_col))
    tokd = docs.withColumn("_tokens", tok_expr)
    stat_cols = [F.count("_tokens").alias("n_docs"),
                 F.avg(F.size("_tokens")).alias("avgdl")]
    stat_cols += [F.count_if(F.array_contains("_tokens", F.lit(t))).alias(f"df{i}")
                  for i, t in enumerate(q_terms)]
    stats = tokd.select(*stat_cols)
    s = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    if not q_terms:
        return tokd.where(F.lit(False)), F.lit(0.0)
    dl = F.size("_tokens")
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / s["avgdl"])
    parts = []
    for i, t in enumerate(q_terms):
        tf = F.size(F.filter("_tokens", _equals(t)))
        n = s[f"df{i}"]
        idf = F.log(F.lit(1.0) + (s["n_docs"] - n + F.lit(0.5)) / (n + F.lit(0.5)))
        parts.append(idf * tf / (tf + norm))
    score = parts[0]
    for p in parts[1:]:
        score = score + p
    gate = match(F.col(text_col), query, analyzer, tokens=None) if tokens_col is None \
        else F.arrays_overlap(F.col(tokens_col), F.array(*[F.lit(t) for t in q_terms]))
    return tokd.where(gate), score


def _equals(value: str):
    return lambda x: x == F.lit(value)


def search(docs: DataFrame, query: str, text_col: str, id_col: str, k: int = DEFAULT_PAGE_SIZE,
           filter: Column | None = None, analyzer: Analyzer = text_tokens,
           select: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Best ``k`` documents for a full-text query (L2), ranked by BM25.

    ``filter`` restricts the hits without taking part in scoring (P10): the
    corpus statistics still cover all of ``docs``.
    """
    matches, score = bm25_score(docs, text_col, query, analyzer)
    if filter is not None:
        matches = matches.where(filter)
    sc = F.round(score, digits) if digits is not None else score
    out = matches.select(F.col(id_col), *[F.col(c) for c in select], sc.alias("_score"))
    return out.orderBy(F.col("_score").desc(), F.col(id_col).asc()).limit(k)


class Clause(NamedTuple):
    """One scoring clause: a full-text query on a column; optional clauses only add score."""

    column: str
    text: str
    analyzer: Analyzer = text_tokens
    required: bool = True


def ranked_page(docs: DataFrame, clauses: Sequence[Clause], id_col: str, k: int = DEFAULT_PAGE_SIZE,
                must_not: Sequence[Column] = (), filter: Sequence[Column] = (),
                select: Sequence[Column | str] = (), digits: int | None = None) -> DataFrame:
    """Best ``k`` documents of a compound query: the BM25 scores of all clauses add up.

    Every required clause must match; without one, at least one optional clause must.
    ``must_not`` and ``filter`` choose rows without scoring. The statistics of all clauses
    come from one aggregation over all of ``docs``, read as one scalar subquery. A query
    word that is repeated counts as often as it is given; a null column scores 0.
    """
    spark = docs.sparkSession
    tokd, terms, stat_cols = docs, [], []
    for i, c in enumerate(clauses):
        tokd = tokd.withColumn(f"_tokens{i}", c.analyzer(F.col(c.column)))
        known = getattr(c.analyzer, "query_tokens", None)
        terms.append(known(c.text) if known else analyze_literal(spark, c.text, c.analyzer))
        stat_cols += [F.count(f"_tokens{i}").alias(f"n{i}"), F.avg(F.size(f"_tokens{i}")).alias(f"len{i}")]
        stat_cols += [F.count_if(F.array_contains(f"_tokens{i}", F.lit(t))).alias(f"df{i}_{j}") for j, t in enumerate(terms[i])]
    stats = tokd.select(*stat_cols)
    s = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    score = F.lit(0.0)
    for i, words in enumerate(terms):
        norm = F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.size(f"_tokens{i}") / s[f"len{i}"])
        for j, t in enumerate(words):
            tf, n = F.size(F.filter(f"_tokens{i}", _equals(t))), s[f"df{i}_{j}"]
            idf = F.log(F.lit(1.0) + (s[f"n{i}"] - n + F.lit(0.5)) / (n + F.lit(0.5)))
            score = score + F.when(F.col(f"_tokens{i}").isNotNull(), idf * tf / (tf + norm)).otherwise(0.0)
    tests = [match(c.column, c.text, c.analyzer) for c in clauses]
    hits = tokd.where(bool_query(must=[t for c, t in zip(clauses, tests) if c.required], must_not=must_not,
                                 should=[t for c, t in zip(clauses, tests) if not c.required], filter=filter,
                                 minimum_should_match=None if any(c.required for c in clauses) else 1))
    out = hits.select(F.col(id_col), *select, (F.round(score, digits) if digits is not None else score).alias("_score"))
    return out.orderBy(F.col("_score").desc(), F.col(id_col).asc()).limit(k)
