"""Source divergence audit: how far the term shares of one language's sources lie apart, by a frequent-pattern tree."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import stored, table

#: A language keeps the terms that occur in at least this many of its documents.
KEPT_DOCS = 30
#: Added to every count, and the whole that shares are parts of.
SMOOTHING = 5
WHOLE = 1_000_000_000
#: Ranks of the ``term`` part (a top-k report).
TOP_TERMS = 50
#: Counted (group, term) entries, or correction cells, that a task holds before it emits them.
HELD_ENTRIES = 300_000
HELD_CELLS = 2_000_000
#: A language's source table is copied this many times for the join with its counts.
SALTS = 16

# Bytes that end a term become blanks, A-Z lower case; bytes from 0x80 on are part of non-ASCII letters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count_terms(batches):
    """Counts of (lang, source, term) and of the documents they occur in, summed over a part of the task."""
    found: dict[tuple, dict] = {}
    held = 0

    def emit():
        for (lang, source), terms in found.items():
            names = list(terms)
            for lo in range(0, len(names), 50_000):
                some = names[lo: lo + 50_000]
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang] * len(some), "source": [source] * len(some), "term": [t.decode() for t in some],
                    "n": [terms[t][0] for t in some], "docs": [terms[t][1] for t in some]}, schema=_COUNTS)

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            terms = found.setdefault((lang, source), {})
            before = len(terms)
            for term, n in Counter(text.translate(_FOLD).split()).items():
                entry = terms.get(term)
                if entry is None:
                    terms[term] = [n, 1]
                else:
                    entry[0] += n
                    entry[1] += 1
            held += len(terms) - before
            if held > HELD_ENTRIES:
                yield from emit()
                found, held = {}, 0
    yield from emit()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (count + SMOOTHING) / (total + SMOOTHING * terms)), exact; null without terms and counts."""
    above = F.lit(WHOLE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(19,0)")
    below = (total + SMOOTHING * terms).cast("decimal(19,0)")
    return F.when(below > 0, 1 + F.call_function("div", above, below)).cast("long")


class PatternTree:
    """A frequent-pattern tree over rows that arrive in order, of which only the open path is held.

    A row is a path of (source, share, share of a count of zero) in source order, with a
    multiplicity. Rows in lexicographic order share the open path's beginning with the row
    before; the rest of that path can get no more rows, so its nodes close: a node's
    multiplicity is final, each of its ancestors gets one correction times that
    multiplicity, and its parent inherits the multiplicity.

    The correction of a pair of sources for a term that both have is what |p - q| differs
    by from the sum that the two single terms account for: |p - q| - |p - q0| - |p0 - q| + |p0 - q0|.
    """

    def __init__(self):
        self.source, self.share, self.zero = (np.zeros(16, np.int64) for _ in range(3))
        self.rows: list[int] = []
        self.sums: dict[int, np.ndarray] = {}
        self.cells = 0
        self.combinations = 0

    def _close(self, depth: int) -> None:
        while len(self.rows) > depth:
            times, d = self.rows.pop(), len(self.rows)
            if not d:
                break
            self.rows[-1] += times
            p, p0, q, q0 = self.share[d], self.zero[d], self.share[:d], self.zero[:d]
            fix = np.abs(p - q) - np.abs(p - q0) - np.abs(p0 - q) + np.abs(p0 - q0)
            at = int(self.source[d])
            sums = self.sums.get(at)
            if sums is None:  # sources before this one only
                sums = self.sums[at] = np.zeros(at, np.int64)
                self.cells += at
            sums[self.source[:d]] += times * fix
            self.combinations += d

    def insert(self, source: np.ndarray, share: np.ndarray, zero: np.ndarray, times: int) -> None:
        n, m = len(source), min(len(self.rows), len(source))
        differ = np.flatnonzero((self.source[:m] != source[:m]) | (self.share[:m] != share[:m]))
        same = int(differ[0]) if len(differ) else m
        self._close(same)
        if n > len(self.source):
            self.source, self.share, self.zero = (np.concatenate([x, np.zeros(2 * n - len(x), np.int64)])
                                                  for x in (self.source, self.share, self.zero))
        self.source[same:n], self.share[same:n], self.zero[same:n] = source[same:], share[same:], zero[same:]
        self.rows += [0] * (n - same)
        self.rows[-1] += times

    def corrections(self) -> pd.DataFrame:
        """All corrections so far as (a, b, value) with a < b; the sums start anew, the open path stays."""
        parts = [(s, np.flatnonzero(v), v) for s, v in self.sums.items()]
        out = pd.DataFrame({"a": np.concatenate([np.zeros(0, np.int64)] + [at for _, at, _ in parts]),
                            "b": np.concatenate([np.zeros(0, np.int64)] + [np.full(len(at), s) for s, at, _ in parts]),
                            "value": np.concatenate([np.zeros(0, np.int64)] + [v[at] for _, at, v in parts])})
        self.sums, self.cells = {}, 0
        return out


def _tree_corrections(batches):
    """Pair corrections of the rows of one sorted partition, summed per language."""
    tree, lang = PatternTree(), None
    for pdf in batches:
        for at, source, own, zero, times in zip(pdf["lang"], pdf["s"], pdf["p"], pdf["z"], pdf["times"]):
            if at != lang:
                if lang is not None:
                    tree._close(0)
                    yield tree.corrections().assign(lang=lang)
                tree, lang = PatternTree(), at
            tree.insert(source, own, zero, times)
            if tree.cells > HELD_CELLS:
                yield tree.corrections().assign(lang=lang)
    if lang is not None:
        tree._close(0)
        yield tree.corrections().assign(lang=lang)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                kept_docs: int = KEPT_DOCS) -> DataFrame:
    """(lang, term, source, n, total): counts above 0 of the kept terms, and their sum over the language.

    Tasks count their own documents; what they emit is shuffled once, by language and term.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to) for c, to in ((lang, "lang"), (source, "source"))],
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    counted = (rows.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
               .repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    terms = (counted.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("entries"), F.sum("docs").alias("docs"),
                                                 F.sum("n").alias("total")).where(F.col("docs") >= kept_docs))
    return terms.select("lang", "term", "total", F.inline("entries"))


def source_divergence(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                      kept_docs: int = KEPT_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Divergence of each (language, source) from the language's other sources, and its most typical terms.

    The sum of |p - q| over all V kept terms for two sources has three parts, all exact:

    - V * |p0 - q0|, as if no term occurred in either;
    - for every count above 0 of one source against the other's share of a zero count: taken
      once per distinct (source, count);
    - the pair corrections of ``PatternTree`` for terms that both have. Equal term rows are
      merged by a group-by first. Rows are range partitioned by language and path, so a
      task's tree holds neighbouring paths; a path that two tasks share is corrected in
      both, for the rows of each.

    A task holds an open path and sums of pairs of sources, never the tree. The only groups of
    unlimited length, a language's terms, are never one group of a task.

    Defined cases: null text, language and source count as ''; a group without terms has counts
    of 0; a language without kept terms gives values of 0 and no ``term`` rows; repeated rows
    are documents of their own; a single source has no ``pair`` rows; an empty table gives no
    rows; other columns, whatever their names, are not used.
    """
    counts = stored(spark, term_counts(docs, text, lang, source, kept_docs), "term-counts")
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to) for c, to in ((lang, "lang"), (source, "source"))]).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    langs = counts.select("lang", "term", "total").distinct().groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all_words"))
    groups = (groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["words", "terms", "all_words"])
              .withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("z", share(F.lit(0).cast("long"), F.col("words"), F.col("terms"))))
    groups = stored(spark, groups, "sources")

    entries = stored(spark, counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "s", "z", share(F.col("n"), F.col("words"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("all_words"), F.col("terms")).alias("q")), "term-shares")

    # two sources have a term: the tree
    paths = (entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("s", "p", "z"))).alias("path"))
             .groupBy("lang", "path").agg(F.count("*").alias("times")))
    rows = (paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
            .select("lang", "times", *[F.col(f"path.{c}").alias(c) for c in ("s", "p", "z")]))
    both = rows.mapInPandas(_tree_corrections, "a long, b long, value long, lang string").select("lang", "a", "b", "value")

    # one source has a term, held against every other source of the language
    single = (entries.groupBy("lang", "s", "p", "z").agg(F.count("*").alias("times"))
              .withColumn("salt", F.pmod(F.xxhash64("s", "p"), F.lit(SALTS))))
    others = groups.select("lang", F.col("s").alias("t"), F.col("z").alias("y"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    one = single.join(others, ["lang", "salt"]).where("s <> t").select(
        "lang", F.least("s", "t").cast("long").alias("a"), F.greatest("s", "t").cast("long").alias("b"),
        (F.col("times") * (F.abs(F.col("p") - F.col("y")) - F.abs(F.col("z") - F.col("y")))).alias("value"))

    # no source has it: the result's own pairs
    mine = groups.select("lang", "terms", F.col("s").alias("a"), F.col("z").alias("az"))
    pairs = mine.join(groups.select("lang", F.col("s").alias("b"), F.col("z").alias("bz")), "lang").where("a < b")
    none = pairs.select("lang", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"),
                        F.coalesce(F.col("terms") * F.abs(F.col("az") - F.col("bz")), F.lit(0)).alias("value"))

    total = stored(spark, both.union(one).union(none).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "source-pairs")
    names = groups.select("lang", F.col("s").cast("long").alias("s"), "source")
    directed = total.select("lang", F.col("a").alias("s"), F.col("b").alias("t"), "value").union(total.select("lang", "b", "a", "value"))
    pair = (directed.join(names, ["lang", "s"]).join(names.select("lang", F.col("s").alias("t"), F.col("source").alias("item")), ["lang", "t"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    term = (entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))
    return pair.union(term)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark, table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT row_id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row_id) AS docs FROM w GROUP BY lang, source, term),
kept AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY lang, term HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.total
      FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT lang, source, sum(n) AS words FROM k GROUP BY lang, source),
p AS (SELECT k.lang, k.source, k.term, k.n, 1 + (1000000000::HUGEINT * (k.n + 5)) // (s.words + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 5)) // (v.total + 5 * v.v) AS q
      FROM k JOIN s USING (lang, source) JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
          FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
          LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 50
"""
