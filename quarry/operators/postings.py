"""Token tables: token listing, documents per token, postings index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.analysis import Analyzer, text_tokens
from quarry.operators.search import BM25_B, BM25_K1

# Steps that the range of a posting's weight, 0 to 1, is cut into.
IMPACT_STEPS = 128
# Hits whose ids are sent to all tasks, so that the documents stay where they are.
BROADCAST_IDS = 1_000_000


def postings(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = text_tokens,
             field_name: str | None = None) -> DataFrame:
    """Postings table ``(field, token, doc_id, tf, doc_len)`` of one analysed column.

    All tokens of a document come from one input row, hence from one task, so
    the partial aggregation before the shuffle already collapses each
    (token, document) pair: the shuffle moves one row per posting, and a very
    common token is spread over as many rows as documents that contain it. Documents
    that are already dealt by ``id_col`` (``repartition(n, id_col)``) are not shuffled again.
    """
    toks = docs.select(F.col(id_col), analyzer(F.col(text_col)).alias("_t")) \
               .withColumn("doc_len", F.size("_t").cast("bigint"))
    out = toks.select(id_col, "doc_len", F.explode("_t").alias("token")) \
              .groupBy("token", id_col).agg(F.count(F.lit(1)).alias("tf"),
                                            F.first("doc_len").alias("doc_len"))
    return out.withColumn("field", F.lit(field_name or text_col))


def write_postings(post: DataFrame, path: str, partitions: int | None = None, salt_buckets: int | None = None,
                   id_col: str = "doc_id") -> None:
    """Write a postings table clustered by token.

    Without ``partitions`` each task writes the postings it holds as a segment of its own: no
    shuffle, and a common token is in as many files as segments hold it. Else rows are hash-partitioned on ``(token, salt)`` where the salt comes from the
    document id, so one very common token is written by up to
    ``salt_buckets`` tasks (all ``partitions``, if not given) instead of one; inside a file rows are sorted by
    token, which lets Parquet min/max statistics skip row groups on a lookup.
    """
    if partitions:
        post = post.repartition(partitions, F.col("token"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(salt_buckets or partitions)))
    post.sortWithinPartitions("token", id_col).write.mode("overwrite").parquet(path)


def token_doc_counts(docs: DataFrame, text_col: str, analyzer: Analyzer = text_tokens) -> DataFrame:
    """Documents per token (T10): each document counts once per token."""
    return docs.select(F.explode(F.array_distinct(analyzer(F.col(text_col)))).alias("token")) \
               .groupBy("token").agg(F.count(F.lit(1)).alias("doc_count"))


def doc_lengths(docs: DataFrame, id_col: str, text_col: str,
                analyzer: Analyzer = text_tokens) -> DataFrame:
    """``(id, doc_len)`` per document with a non-NULL field (empty ones included)."""
    return docs.select(F.col(id_col), F.size(analyzer(F.col(text_col))).cast("bigint").alias("doc_len")) \
               .where(F.col("doc_len") >= 0)


def match_postings(post: DataFrame, tokens: list[str], id_col: str = "doc_id") -> DataFrame:
    """Ids of documents holding any of ``tokens``, read from a postings table.

    ``token IN (...)`` reaches the Parquet scan as a pushed filter; with files
    sorted by token (``write_postings``) most row groups are skipped.
    """
    return post.where(F.col("token").isin(tokens)).select(id_col).distinct()


def docs_with_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """The documents whose id is in ``ids``. Up to ``broadcast_ids`` ids are broadcast, so no text is shuffled; more are joined by shuffle."""
    return docs.join(F.broadcast(ids) if ids.count() <= broadcast_ids else ids, id_col, "left_semi")


def bm25_postings(post: DataFrame, lengths: DataFrame, tokens: list[str], id_col: str = "doc_id",
                  k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 ``(id, _score)`` for the documents holding a query token, from the index.

    Reads only the postings of the query tokens. Document frequencies are one
    row per query token (a bound known from the query), so they are broadcast;
    document count and mean length come from the length table as one scalar
    subquery. Same formula as ``quarry.operators.search.bm25_score``.
    """
    hits = post.where(F.col("token").isin(tokens))
    times = F.create_map(*[F.lit(x) for t in dict.fromkeys(tokens) for x in (t, float(tokens.count(t)))])
    dfreq = hits.groupBy("token").agg(F.count(F.lit(1)).alias("_df"))
    stats = lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_len").alias("avgdl"))
    s = stats.select(F.struct("n_docs", "avgdl").alias("s")).scalar()
    idf = F.log(F.lit(1.0) + (s["n_docs"] - F.col("_df") + F.lit(0.5)) / (F.col("_df") + F.lit(0.5)))
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("doc_len") / s["avgdl"])
    part = times[F.col("token")] * idf * F.col("tf") / (F.col("tf") + norm)
    return hits.join(F.broadcast(dfreq), "token").groupBy(id_col).agg(F.sum(part).alias("_score"))


def write_impacts(post: DataFrame, lengths: DataFrame, path: str, partitions: int | None = None, id_col: str = "doc_id",
                  k1: float = BM25_K1, b: float = BM25_B, page_rows: int = 1000) -> None:
    """Write the index of ``top_page``: postings with their weight, blocks of equal weight, and corpus totals.

    ``impact`` is the part of a posting's BM25 score that does not depend on the query, between
    0 and 1. ``postings`` is dealt like ``write_postings`` (without ``partitions`` not at all), each file sorted by token and falling impact, in
    Parquet pages of ``page_rows`` rows, so a scan with a bound on a token's impact reads the
    first pages of the token only. ``blocks`` has, per token and step of impact, how many
    postings there are and the least and greatest impact: at most ``IMPACT_STEPS`` rows a token.
    """
    lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_len").alias("avgdl")).write.mode("overwrite").parquet(f"{path}/totals")
    s = post.sparkSession.read.parquet(f"{path}/totals").select(F.struct("n_docs", "avgdl").alias("s")).scalar()
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("doc_len") / s["avgdl"])
    weighed = post.select("token", id_col, (F.col("tf") / (F.col("tf") + norm)).alias("impact"))
    if partitions:
        weighed = weighed.repartition(partitions, F.col("token"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(partitions)))
    (weighed.sortWithinPartitions("token", F.col("impact").desc(), id_col)
     .write.mode("overwrite").option("parquet.page.row.count.limit", str(page_rows)).parquet(f"{path}/postings"))
    stored = post.sparkSession.read.parquet(f"{path}/postings")
    (stored.groupBy("token", F.floor(F.col("impact") * IMPACT_STEPS).cast("int").alias("step"))
     .agg(F.count(F.lit(1)).alias("n"), F.min("impact").alias("least"), F.max("impact").alias("most"))
     .sortWithinPartitions("token", F.col("step").desc())
     .write.mode("overwrite").parquet(f"{path}/blocks"))


class TopPage:
    """Best documents for query tokens from an index of ``write_impacts``, without scoring all hits.

    The blocks of the query's tokens (a bounded number of rows) tell for each k a score that
    at least k documents reach: that of the k-th best posting of one token. A document
    that reaches it has in each of its postings an impact that, with the greatest impacts
    of the other tokens added, reaches it too. So only postings above a bound per
    token are read, by a filter that the scan pushes down; all postings of the documents that count pass it.
    """

    def __init__(self, spark: SparkSession, path: str, tokens: list[str], id_col: str = "doc_id"):
        self.spark, self.path, self.id_col = spark, path, id_col
        self.times = {t: tokens.count(t) for t in dict.fromkeys(tokens)}
        found = spark.read.parquet(f"{path}/blocks").where(F.col("token").isin(list(self.times))).collect()
        totals = spark.read.parquet(f"{path}/totals").select(F.col("n_docs").cast("double")).first()
        self.blocks = {t: sorted(((r["step"], r["n"], r["least"], r["most"]) for r in found if r["token"] == t), reverse=True) for t in self.times}
        self.weight = {}
        for t, blocks in self.blocks.items():
            df = sum(n for _, n, _, _ in blocks)
            idf = F.log(F.lit(1.0) + (F.lit(totals[0]) - df + F.lit(0.5)) / F.lit(df + 0.5))
            self.weight[t] = self.times[t] * spark.sql("VALUES (1)").select(idf).first()[0] if df else 0.0
        self.hits = sum(n for blocks in self.blocks.values() for _, n, _, _ in blocks)

    def score_reached_by(self, k: int) -> float:
        """A score that at least ``k`` documents reach; 0 if there may be fewer."""
        best = 0.0
        for t, blocks in self.blocks.items():
            count = 0
            for _, n, least, _ in blocks:
                count += n
                if count >= k:
                    best = max(best, self.weight[t] * least)
                    break
        return best

    def postings_for(self, score: float) -> DataFrame:
        """The postings that a document with at least this score can have."""
        top = {t: self.weight[t] * (blocks[0][3] if blocks else 0.0) for t, blocks in self.blocks.items()}
        tests = [(F.col("token") == t) & (F.col("impact") >= F.lit(max(0.0, (score - sum(top.values()) + top[t]) / self.weight[t])))
                 for t in self.blocks if self.weight[t] > 0]
        post = self.spark.read.parquet(f"{self.path}/postings")
        return post.where(reduce(lambda a, b: a | b, tests, F.lit(False)))

    def scored(self, k: int, slack: float) -> tuple[DataFrame, float]:
        """(id, ``_score``) of all documents that reach the score of ``score_reached_by(k)``, less ``slack``."""
        least = self.score_reached_by(k) - slack
        part = F.create_map(*[F.lit(x) for t in self.times for x in (t, self.weight[t])])[F.col("token")] * F.col("impact")
        scores = self.postings_for(least).groupBy(self.id_col).agg(F.sum(part).alias("_score"))
        return scores.where(F.col("_score") >= least), least


def top_page(spark: SparkSession, path: str, tokens: list[str], k: int = 10, digits: int | None = None, id_col: str = "doc_id",
             docs: DataFrame | None = None, keep: Column | None = None) -> DataFrame:
    """The best ``k`` of the documents that hold any of ``tokens``: (id, ``_score``, and the columns of ``docs`` if given).

    ``keep`` restricts the hits by columns of ``docs`` without taking part in the scores. Since
    it may drop the best ones, documents further down are asked for, eight times as many each
    time, until ``k`` are left or no posting is. Ties are ordered by id; scores are rounded
    to ``digits`` before they are ranked, and so is the bound.
    """
    index, wanted = TopPage(spark, path, tokens, id_col), k
    slack = 10.0 ** -digits if digits is not None else 1e-12
    order = [F.col("_score").desc(), F.col(id_col).asc()]
    while True:
        scores, least = index.scored(wanted, slack)
        if digits is not None:
            scores = scores.withColumn("_score", F.round("_score", digits))
        hits = scores if docs is None else docs.join(scores, id_col)
        if keep is not None:
            hits = hits.where(keep)
        best = hits.select(id_col, "_score").orderBy(*order).limit(k)  # of docs, only the columns of the test are read
        if docs is None and (keep is None or least <= 0 or best.count() == k):
            return best
        if docs is not None:
            rows = best.collect()
            if keep is None or least <= 0 or len(rows) == k:
                break
        wanted *= 8
    # Only now the other columns, of at most k ids. A repeated id may have rows that the test drops.
    few = spark.createDataFrame(list({r[id_col]: r for r in rows}.values()), best.schema)
    hits = docs.where(F.col(id_col).isin([r[id_col] for r in rows])).join(F.broadcast(few), id_col)
    return (hits if keep is None else hits.where(keep)).orderBy(*order).limit(k)
