"""MinHash document fingerprints, likeness of fingerprints, and banded near-duplicate search."""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.llm.common import stored, table
from quarry.llm.ngram_join import CELL_ROWS, _as_pairs, _check, _edges, _node, _texts, connected_components, representatives
from quarry.llm.shingles import SIMILARITY_PERCENT, mix64, shingle_sets

PERMUTATIONS = 64
SEED = 20240607
#: 16 bands of 4: a pair of similarity 0.75 shares a band with probability 0.997.
BANDS = 16
#: Rows of one run of consecutive keys in ``with_next``, and the most runs (beyond, runs grow).
RUN_ROWS = 2000
MOST_RUNS = 200_000
_SAMPLED = 100_000


def permutations(count: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``count`` universal hash functions x -> (a x + b) mod 2**64 >> 32, with odd a."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
    return a, b


def minima(sets: list[np.ndarray], count: int = PERMUTATIONS, seed: int = SEED) -> np.ndarray:
    """MinHash signatures (sets x count, uint32) of shingle sets; an empty set's is all ones."""
    a, b = permutations(count, seed)
    out = np.full((len(sets), count), 0xFFFFFFFF, np.uint32)
    for i, s in enumerate(sets):
        for lo in range(0, len(s), 8192):
            with np.errstate(over="ignore"):
                h = (s[lo: lo + 8192, None] * a + b) >> np.uint64(32)
            out[i] = np.minimum(out[i], h.min(axis=0).astype(np.uint32))
    return out


def signatures(texts: list, count: int = PERMUTATIONS, seed: int = SEED) -> np.ndarray:
    """The signatures of the texts' sets of word shingles."""
    return minima(shingle_sets(texts), count, seed)


def band_values(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit hash per band of consecutive minima (rows x bands, int64)."""
    rows, count = signature.shape
    width = count // bands
    out = np.zeros((rows, bands), np.uint64)
    for x in np.moveaxis(signature[:, : bands * width].reshape(rows, bands, width).astype(np.uint64), 2, 0):
        out = mix64(out + x + np.uint64(1))
    return out.view(np.int64)


def as_text(signature: np.ndarray) -> str:
    """The low 16 bits of each minimum, as hexadecimal digits (4 for each permutation)."""
    return (signature & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    """The 16-bit minima of a fingerprint."""
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2")


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """The share of equal 16-bit minima, those of the fingerprint: an estimate of the shingle sets' Jaccard similarity."""
    return float(np.mean((x ^ y) & 0xFFFF == 0))


def with_next(docs: DataFrame, key: str, text: str, run_rows: int = RUN_ROWS) -> DataFrame:
    """Every row's ``key``, ``text`` and ``next_text``: the text of the next key (last: the first's).

    A global ``lead`` would sort everything in one task. Keys are cut into runs of about
    ``run_rows`` at approximate quantiles of all keys; ``lead`` works inside runs, and the
    last row of a run takes the first row of the next run, found by an aggregate of one key
    per run (at most ``MOST_RUNS`` rows, the only broadcast). Rows with equal keys are ordered by text; null keys come
    first. Keys are numbers, or strings (in UTF-8 order, cut at quantiles of a sample by hash of about ``_SAMPLED`` keys).
    """
    spark = docs.sparkSession
    d = docs.select(F.col(key).alias("__k"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    n, lo, hi = d.agg(F.count("*"), F.min("__k"), F.max("__k")).first()
    runs = min(MOST_RUNS, max(1, n // run_rows))
    strings = isinstance(docs.schema[key].dataType, StringType)
    if lo is None or runs == 1:
        cuts = []
    elif strings:
        some = d.select("__k").where(F.pmod(F.xxhash64("__k"), F.lit(max(1, n // _SAMPLED))) == 0).dropna().orderBy("__k").limit(4 * _SAMPLED)
        found = [r[0] for r in some.collect()]
        cuts = sorted({found[i * len(found) // runs] for i in range(1, runs)}) if found else []
    else:
        cuts = sorted(set(d.approxQuantile("__k", [i / runs for i in range(1, runs)], 0.2 / runs)))
    bounds = spark.sparkContext.broadcast(np.array(cuts, object if strings else float))

    @F.pandas_udf("int")
    def run_of(k: pd.Series) -> pd.Series:
        known = k.to_numpy(dtype=object if strings else float, na_value=None if strings else -np.inf)
        if strings:
            return pd.Series([0 if x is None else bisect_right(bounds.value, x) for x in known]).astype("int32")
        return pd.Series(np.searchsorted(bounds.value, known, "right").astype("int32"))

    d = d.withColumn("__run", run_of(F.col("__k") if strings else F.col("__k").cast("double")))
    order = [F.col("__k").asc_nulls_first(), F.col("__t")]
    inside = Window.partitionBy("__run").orderBy(*order)
    rows = d.withColumn("__n", F.lead("__t").over(inside))
    # one key per run; a run's head text is the least text of that key
    heads = d.select("__run", "__k").groupBy("__run").agg(
        F.max(F.col("__k").isNull()).alias("__null"), F.min("__k").alias("__head"))
    heads = heads.withColumn("__head", F.when(~F.col("__null"), F.col("__head"))).select("__run", "__head")
    back = F.coalesce(F.lag("__run").over(Window.orderBy("__run")), F.max("__run").over(Window.partitionBy()))
    heads = heads.withColumn("__before", back)
    head_texts = (d.select("__k", "__t").join(F.broadcast(heads), F.col("__k").eqNullSafe(F.col("__head")))
                  .groupBy("__before").agg(F.min("__t").alias("__first")))
    return (rows.join(head_texts, F.col("__n").isNull() & (F.col("__run") == F.col("__before")), "left")
            .select(F.col("__k").alias(key), F.col("__t").alias(text), F.coalesce("__n", "__first").alias("next_text")))


def _prints(batches):
    for pdf in batches:
        own, edited, following = pdf["text"].tolist(), pdf["edited"].tolist(), pdf["next_text"].tolist()
        texts = list(dict.fromkeys(own + edited + following))
        sig = signatures(texts)
        at = {t: i for i, t in enumerate(texts)}
        yield pd.DataFrame({
            "doc_id": pdf["doc_id"], "n_chars": pdf["n_chars"], "edited_sha256": pdf["edited_sha256"],
            "fingerprint": [as_text(sig[at[t]]) for t in own], "edited_fingerprint": [as_text(sig[at[t]]) for t in edited],
            "near_edited": [likeness(sig[at[t]], sig[at[u]]) for t, u in zip(own, edited)],
            "near_next": [likeness(sig[at[t]], sig[at[u]]) for t, u in zip(own, following)]})


def _banded(bands: int):
    """Per document its set's size and digest and the hashes of its signature's bands."""
    def run(batches):
        for pdf in batches:
            values = [t if isinstance(t, str) else "" for t in pdf["text"]]
            for lo in range(0, len(values), 512):
                sets = shingle_sets(values[lo: lo + 512])
                part = pdf.iloc[lo: lo + 512]
                yield pd.DataFrame({
                    "id": part["id"].to_numpy(), "row": part["row"].to_numpy(), "row2": part["row2"].to_numpy(), "n": [len(s) for s in sets],
                    "cls": [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets],
                    "bands": list(band_values(minima(sets), bands))})
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                    bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate groups: signature bands joined in Spark, Jaccard verified on whole sets.

    Returns (documents, links): per row ``key`` and ``component_id`` (the least key reachable
    by links), and the verified links between classes. A class is the documents with one
    shingle set, so copies meet once. Classes that share a band are candidates:

    1. each class of a band is checked against the band's least class, one candidate per
       member however many there are;
    2. members of a band that round 1 left in different components are checked against each
       other, except that the band's largest component is not compared with itself.

    So every candidate pair that could still join two components is checked, and no band
    gives all its pairs. Links need a similarity of 0.75 or more; banding offers a pair with
    the probability stated at ``BANDS``.

    Defined cases: null, empty and blank texts are linked with nothing (their component is
    their own key); null keys take part and get a null component unless linked with a keyed
    row; repeated rows share a class; an empty table gives no rows; extra columns are not
    carried.
    """
    base = _texts(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    rows = stored(spark, base.mapInPandas(_banded(bands), f"id {kind}, row long, row2 long, n long, cls long, bands array<long>"), "minhash-bands")
    reps = representatives(rows)
    banded = rows.where("n > 0").groupBy("cls", "n").agg(F.min("bands").alias("bands"))
    members = banded.withColumn("n", F.col("n").cast("int")).select(_node("cls", "n").alias("node"), F.posexplode("bands").alias("band", "value"))
    shared = members.groupBy("band", "value").agg(F.min("node").alias("centre"), F.count("*").alias("size")).where("size > 1")
    members = stored(spark, members.join(shared.drop("size"), ["band", "value"]), "band-members")

    def sized(x: str, y: str) -> str:
        return f"100 * least({x}.n, {y}.n) >= {SIMILARITY_PERCENT} * greatest({x}.n, {y}.n)"

    stars = members.where("node <> centre").where(sized("node", "centre"))
    checked = stored(spark, _as_pairs(stars, F.col("node"), F.col("centre")), "candidates")
    links = stored(spark, _check(spark, checked, reps, base), "links")

    # round 2: bands with classes of several components
    placed = (members.drop("centre").join(connected_components(spark, _edges(links)), "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    sizes = placed.groupBy("band", "value", "component").agg(F.count("*").alias("size"))
    mains = (sizes.groupBy("band", "value").agg(F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all"))
             .where("parts > 1").select("band", "value", F.col("top.component").alias("main"), F.ceil(F.col("all") / CELL_ROWS).cast("int").alias("cells")))
    mixed = stored(spark, placed.join(mains, ["band", "value"]).withColumn("in_main", F.col("component") == F.col("main")).drop("main"), "mixed-bands")
    # a member meets its band cell by cell, so a long band is not one key
    x = mixed.where("not in_main").select("band", "value", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("part"),
                                          F.col("node").alias("x"), F.col("component").alias("x_component"))
    y = mixed.select("band", "value", F.pmod(F.xxhash64("node"), "cells").cast("int").alias("part"),
                     F.col("node").alias("y"), F.col("component").alias("y_component"), "in_main")
    near = (x.join(y, ["band", "value", "part"]).where("x_component <> y_component and (in_main or x < y)").where(sized("x", "y")))
    rest = stored(spark, _as_pairs(near, F.col("x"), F.col("y")).join(checked, checked.columns, "left_anti"), "candidates")
    links = stored(spark, links.union(_check(spark, rest, reps, base)), "links")

    keyed = rows.select("id", "n", F.struct("cls", F.col("n").cast("int").alias("n")).alias("node"))
    grouped = (keyed.where("n > 0").groupBy("node").agg(F.min("id").alias("least_id"))
               .join(connected_components(spark, _edges(links)), "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    out = (keyed.join(grouped.join(least, "component").select("node", "component_id"), "node", "left")
           .select(F.col("id").alias(key), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))
    return out, links


def op6_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Defined cases: a null text is empty; texts without words share one fingerprint and are
    alike to one another by 1; equal keys are ordered by text; a single document is its own
    next; an empty table gives no rows.
    """
    docs = with_next(table(spark, sf_dir, "documents"), "doc_id", "text")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = docs.select("doc_id", "text", "next_text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    return rows.mapInPandas(_prints, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")
