"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, table
from quarry.llm.exact_dedup import normalised

WEIGHTS = (3, 1, 2)
#: Relative weight over training time 0..1 as (time, factor) knots, joined linearly; one
#: schedule for each weight of the cycle: rising, even, and falling to a plateau.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 1.5), (0.5, 0.75), (1.0, 0.75)))
DEMAND = 1.5
REPEATS = 2


def word_count(text: Column) -> Column:
    """Number of blank-separated words."""
    t = F.trim(normalised(text))
    return F.when(t == "", F.lit(0)).otherwise(
        F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def source_targets(cells: DataFrame, weights=WEIGHTS, demand: float = DEMAND,
                   repeats: int = REPEATS) -> DataFrame:
    """Per source: ``source_size``, ``place`` (0.. by code point, null last), ``target``.

    ``cells`` has ``__s`` (the source as key), ``source`` and ``words``. The level of the
    water filling is found in closed form: in order of cap / weight the sources that stop
    at their cap come first, and the running level is greatest at the last of them. The
    windows without partition run over one row per source.
    """
    per = cells.groupBy("__s", "source").agg(F.sum("words").alias("source_size"))
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    per = per.withColumn("place", rank)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumns({"w": F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")),
                           "cap": (F.col("source_size") * repeats).cast("double")})
    per = per.withColumn("stop", F.col("cap") / F.col("w"))
    before = Window.orderBy("stop", "place").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.col("source_size")).over(everything) * F.lit(float(demand))
    free = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("running", free / left)
    per = per.withColumn("level", F.max("running").over(everything))
    return per.select("__s", "source_size", "place",
                      F.when(F.col("stop") <= F.col("level"), F.col("cap"))
                      .otherwise(F.col("w") * F.col("level")).alias("target"))


def _pieces(knots) -> list[tuple[float, float, float, float]]:
    """(integral before, start time, weight, slope) of each linear piece, for a total integral of 1."""
    area = sum((b[1] + a[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:]))
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((done, t0, w0 / area, (w1 - w0) / area / (t1 - t0)))
        done += (w1 + w0) / 2 * (t1 - t0) / area
    return out


def training_time(share, schedule, schedules=SCHEDULES, sql: bool = False):
    """When a source whose weight follows a schedule has been asked for ``share`` of its words.

    The inverse of the integral of the piecewise linear weight: a quadratic in each piece.
    With ``sql`` the same expression as SQL text, else a Column.
    """
    text = "CASE"
    for i, knots in enumerate(schedules):
        for done, t0, w, m in reversed(_pieces(knots)):
            a = f"({share} - CAST({done!r} AS DOUBLE))"
            text += (f" WHEN {schedule} = {i} AND {share} >= CAST({done!r} AS DOUBLE) THEN CAST({t0!r} AS DOUBLE) + 2 * {a}"
                     f" / (CAST({w!r} AS DOUBLE) + sqrt(CAST({w * w!r} AS DOUBLE) + CAST({2 * m!r} AS DOUBLE) * {a}))")
    text += " END"
    return text if sql else F.expr(text)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, schedules=SCHEDULES, demand: float = DEMAND, repeats: int = REPEATS) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``taken`` and ``position``.

    A source's documents, in order of the MD5 of their key, are read up to ``repeats``
    times until ``target`` words are taken; the last document may be taken in part.
    Cumulative demand of a source at time t is its target times the integral of its
    schedule, so the word offset at which a copy starts, inverted through that integral,
    is the copy's training time: ``position`` holds the first copy's (null: not taken)
    and ``positions`` those of all copies.

    A hot source is split into 4096 cells by the first digits of the MD5: cells are summed
    with map-side combine, one window adds up at most 4096 cell sums of a source, and the
    document windows run inside cells.

    Defined cases: null text has size 0; size-0 rows take nothing; a null source is a
    source of its own, last; null keys sort as the empty key; ties in the key are ordered
    by size and text hash; an empty table gives no rows; result columns replace input
    columns of the same name. Names starting ``__`` are reserved.
    """
    made = ["size", "source_size", "target", "taken", "position", "positions"]
    clean = docs.drop(*[c for c in made if c not in (key, text, source)])
    d = clean.withColumns({
        "size": word_count(F.col(text)),
        "__m": F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
        "__t": F.xxhash64(text),
        "__s": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))})
    d = d.withColumn("__cell", F.substring("__m", 1, 3))
    cells = d.groupBy("__s", F.col(source).alias("source"), "__cell").agg(F.sum("size").alias("words"))
    targets = source_targets(cells, weights, demand, repeats)
    ahead = Window.partitionBy("__s").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.select("__s", "__cell", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("__cell_at"))
              .join(targets, "__s"))
    inside = (Window.partitionBy("__s", "__cell").orderBy("__m", key, "size", "__t")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__in_cell", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(starts, ["__s", "__cell"])
    d = d.withColumns({"__at": F.col("__cell_at") + F.col("__in_cell"),
                       "__end": F.round("target").cast("long"),
                       "__plan": F.col("place") % len(schedules)})
    part = [F.greatest(F.lit(0), F.least(F.col("size"), F.col("__end") - F.col("__at") - F.lit(e) * F.col("source_size")))
            for e in range(repeats)]
    takes = part[0]
    for p in part[1:]:
        takes = takes + p
    d = d.withColumn("taken", takes.cast("long"))
    for e in range(repeats):
        share = F.when(part[e] > 0, (F.col("__at") + F.lit(e) * F.col("source_size")) / F.col("target"))
        d = d.withColumn(f"__share{e}", share)
        d = d.withColumn(f"__time{e}", F.round(training_time(f"__share{e}", "__plan", schedules), 9))
    d = d.withColumns({"position": F.col("__time0"),
                       "positions": F.array_compact(F.array(*[F.col(f"__time{e}") for e in range(repeats)]))})
    return d.select(*[c for c in clean.columns if c not in made or c in (key, text, source)],
                    *[c for c in made if c not in clean.columns])


def in_training_order(mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per copy that the mix takes, range-sorted by training time.

    A copy that is taken in part keeps its first words, joined by single spaces.
    """
    rows = mixed.where("taken > 0").select("*", F.posexplode("positions").alias("__copy", "__time"))
    words = F.least(F.col("size"), F.col("taken") - F.col("__copy") * F.col("size"))
    cut = F.array_join(F.slice(F.split(F.trim(normalised(F.col(text))), " "), F.lit(1), words.cast("int")), " ")
    rows = rows.withColumn(text, F.when(words < F.col("size"), cut).otherwise(F.col(text)))
    return rows.orderBy("__time", key, "__copy")


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position")
            .orderBy("position", "doc_id"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in training order, as often as the mix takes them."""
    out = in_training_order(mix(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*docs.columns)


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS s, source,
                  len(regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+')) AS size,
                  md5(CAST(doc_id AS VARCHAR)) AS m FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, list_value({', '.join(f'{float(x)!r}::DOUBLE' for x in WEIGHTS)})[place % {len(WEIGHTS)} + 1] AS w,
             ({REPEATS} * source_size)::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / w AS stop,
             ((sum(source_size) OVER ())::DOUBLE * {DEMAND}::DOUBLE - coalesce(sum(cap) OVER b, 0)) /
             (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS running
      FROM w WINDOW b AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, place,
             CASE WHEN stop <= max(running) OVER () THEN cap ELSE w * max(running) OVER () END AS target FROM r),
a AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.place % {len(SCHEDULES)} AS plan,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.m, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead,
             round(t.target)::BIGINT AS stop_at
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, (greatest(0, least(size, stop_at - ahead)) + greatest(0, least(size, stop_at - ahead - source_size)))::BIGINT AS taken,
             CASE WHEN least(size, stop_at - ahead) > 0 THEN ahead / target END AS share FROM a)
SELECT doc_id, size, source_size, target, taken, round({training_time('share', 'plan', sql=True)}, 9) AS position FROM k
"""
