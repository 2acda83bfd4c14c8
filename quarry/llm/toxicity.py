"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.boosting import BoostedTrees, Isotonic, sigmoid
from quarry.llm.common import held_out, labelled_sample, stored, table

#: Bounds of the fit: learnable rows per label value, and lexicon entries per tier.
SAMPLE_PER_LABEL = 3000
LEXICON_ENTRIES = 400
FOLDS = 3

# Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deiner ihr euch euer "
                          "tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros".split())
# Characters that stand for letters in disguised words.
DISGUISES = str.maketrans("013457@$!", "oieastasi")
NEAR_WORDS = 5
PREFIXES = (4, 5, 6, 7, 8)

_EDGE = re.compile(r"^[^\w@$!*]+|[^\w@$*]+$")
_DISGUISED = re.compile(r"(?=.*[a-z])[a-z]*[0-9@$!*][a-z0-9@$!*]*[a-z0-9]", re.I)


def bare(word: str) -> str:
    """A word in lower case without punctuation at its edges."""
    return _EDGE.sub("", word).rstrip("!") if not word.isalpha() else word


def marks(word: str):
    """What a lexicon may hold of a word: the word itself, and its beginnings (ending in ``-``)."""
    yield word
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n] + "-"


def split_words(texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased words, the place of every word among them, each text's first word (n + 1)."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(pa.array([t if isinstance(t, str) else "" for t in texts], pa.large_string())))
    words = pc.dictionary_encode(split.flatten())
    return (words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            split.offsets.to_numpy().astype(np.int64))


def slices(texts: list, limit: int = 1 << 22):
    """(start, end) runs of texts of about ``limit`` characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if isinstance(t, str) else 0
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


FEATURES = ("strong", "medium", "weak", "strong_count", "medium_count", "weak_count", "near_second_person",
            "disguised_hits", "disguised", "capitals", "shouted", "exclamations", "punctuation", "digits", "second_person", "log_words")


def features(texts: list, lexicon: dict[str, int]) -> np.ndarray:
    """Dense features of each text; ``lexicon`` maps words and beginnings to tiers 1 (strong) to 3."""
    out = np.zeros((len(texts), len(FEATURES)))
    for lo, hi in slices(texts):
        part = texts[lo:hi]
        vocabulary, code, at = split_words(part)
        tier = np.zeros(len(vocabulary) + 1, np.int64)
        flags = np.zeros((len(vocabulary) + 1, 3), bool)
        for i, raw in enumerate(vocabulary):
            w = bare(raw)
            best = min((lexicon[m] for m in marks(w) if m in lexicon), default=0)
            if not w.isalpha() and _DISGUISED.fullmatch(w):
                flags[i, 1] = True
                plain = w.translate(DISGUISES)
                if not best and (plain in lexicon or plain.replace("*", "") in lexicon):
                    best, flags[i, 2] = 1, True
            tier[i] = best
            flags[i, 0] = w in SECOND_PERSON
        t, f = tier[code], flags[code]
        sums = np.zeros((7, len(code) + 1))
        near = np.zeros(len(code), bool)
        you = np.flatnonzero(f[:, 0])
        for step in range(-NEAR_WORDS, NEAR_WORDS + 1):
            place = you + step
            near[place[(place >= 0) & (place < len(code))]] = True
        for k, v in enumerate((t == 1, t == 2, t == 3, (t > 0) & near, f[:, 2], f[:, 1], f[:, 0])):
            np.cumsum(v, out=sums[k, 1:])
        totals = sums[:, at[1:]] - sums[:, at[:-1]]
        n = np.maximum(at[1:] - at[:-1], 1)
        for i, text in enumerate(part):
            b = np.frombuffer((text if isinstance(text, str) else "").encode("utf-8", "surrogatepass"), np.uint8)
            size, row = max(len(b), 1), out[lo + i]
            upper = (b >= 65) & (b <= 90)
            row[9] = np.count_nonzero(upper) / size
            row[10] = np.count_nonzero(upper[1:] & upper[:-1]) / size
            row[11] = np.count_nonzero(b == 33) / n[i]
            row[12] = np.count_nonzero(((b > 32) & (b < 48)) | ((b > 57) & (b < 65)) | ((b > 90) & (b < 97)) | ((b > 122) & (b < 127))) / size
            row[13] = np.count_nonzero((b > 47) & (b < 58)) / size
        block = out[lo:hi]
        block[:, 0:3] = (totals[0:3] / n).T
        block[:, 3:6] = np.log1p(totals[0:3]).T
        block[:, 6] = np.log1p(totals[3])
        block[:, 7] = np.log1p(totals[4])
        block[:, 8] = totals[5] / n
        block[:, 14] = totals[6] / n
        block[:, 15] = np.log1p(n)
    return out


def _mark_counts(batches):
    """Documents holding each mark, by cross-fitting part and label, summed within the task."""
    counts: dict[tuple[int, int], Counter] = {}
    sizes: Counter = Counter()
    for pdf in batches:
        texts = pdf["text"].tolist()
        for lo, hi in slices(texts):
            vocabulary, code, at = split_words(texts[lo:hi])
            known = [tuple(marks(bare(w))) for w in vocabulary]
            for i in range(hi - lo):
                k = (int(pdf["part"].iloc[lo + i]) % FOLDS, int(pdf["label"].iloc[lo + i]))
                sizes[k] += 1
                held: set[str] = set()
                for c in np.unique(code[at[i]: at[i + 1]]).tolist():
                    held.update(known[c])
                counts.setdefault(k, Counter()).update(held)
    for (part, label), c in counts.items():
        yield pd.DataFrame({"mark": [""] + list(c), "part": part, "label": label, "n": [sizes[part, label]] + list(c.values())})


def choose_lexicon(rows: pd.DataFrame, sizes: dict[int, int]) -> dict[str, int]:
    """Tiers of the marks that speak for label 1: by smoothed log odds, at most
    ``LEXICON_ENTRIES`` each, those in most label-1 documents first."""
    pos, neg = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    out: dict[str, int] = {}
    odds = np.log((rows["pos"] + 0.5) / (pos + 1)) - np.log((rows["neg"] + 0.5) / (neg + 1))
    share = rows["pos"] / pos
    least = max(3, math.ceil(0.002 * pos))
    for tier, low in ((1, 4.0), (2, 2.5), (3, 1.5)):
        ok = (odds >= low) & (rows["pos"] >= least) & ~rows["mark"].isin(out)
        best = rows[ok].assign(share=share[ok]).sort_values(["share", "mark"], ascending=[False, True]).head(LEXICON_ENTRIES)
        out.update(dict.fromkeys(best["mark"], tier))
    return out


class ToxicityModel:
    """Lexicon, trees and calibration; scores batches of texts."""

    def __init__(self, lexicon, trees, calibration, base):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    def score(self, texts: list) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.base)
        if not texts:
            return np.zeros(0)
        return np.clip(self.calibration(self.trees.raw(features(texts, self.lexicon))), 0, 1)


def fit_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                 label: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> ToxicityModel:
    """Fit on a bounded sample of learnable rows, weighted back to the labels' true shares.

    The lexicon is learned from document counts of words and word beginnings. It is
    cross-fitted: a part's training features come from a lexicon learned without it, so the
    trees see it as reliable as it is on new text. Calibration is fitted on out-of-fold
    scores. The driver gets lexicon candidates and feature rows of the sample, no texts.
    """
    found, totals = labelled_sample(docs, labels.select(key, F.col(label).cast("int").alias(label)).where(f"{label} in (0, 1)"),
                                    label, per_label, key, text)
    found = stored(spark, found, "toxicity-sample")
    counted = (found.mapInPandas(_mark_counts, "mark string, part int, label int, n long")
               .groupBy("mark").pivot("part", list(range(FOLDS)))
               .agg(F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("pos"), F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("neg"))
               .na.fill(0))
    pos = sum((F.col(f"{p}_pos") for p in range(FOLDS)), F.lit(0))
    neg = sum((F.col(f"{p}_neg") for p in range(FOLDS)), F.lit(0))
    marks_ = counted.where((F.col("mark") == "") | ((pos >= 3) & (neg <= pos))).toPandas()
    sizes = {p: {1: 0, 0: 0} for p in range(FOLDS)}
    head = marks_[marks_["mark"] == ""]
    for p in range(FOLDS):
        if len(head):
            sizes[p] = {1: int(head[f"{p}_pos"].iloc[0]), 0: int(head[f"{p}_neg"].iloc[0])}
    marks_ = marks_[marks_["mark"] != ""].reset_index(drop=True)
    n_pos, n_neg = (sum(s[k] for s in sizes.values()) for k in (1, 0))
    base = totals.get(1, 0) / max(sum(totals.values()), 1)
    if n_pos < FOLDS or n_neg < FOLDS:
        return ToxicityModel({}, None, None, base)

    def lexicon(parts):
        rows = pd.DataFrame({"mark": marks_["mark"], "pos": sum(marks_[f"{p}_pos"] for p in parts), "neg": sum(marks_[f"{p}_neg"] for p in parts)})
        return choose_lexicon(rows, {k: sum(sizes[p][k] for p in parts) for k in (0, 1)})

    without = [lexicon([q for q in range(FOLDS) if q != p]) for p in range(FOLDS)]
    shared = spark.sparkContext.broadcast(without)

    def dense(batches):
        for pdf in batches:
            part = (pdf["part"] % FOLDS).to_numpy()
            x = np.zeros((len(pdf), len(FEATURES)))
            for p in range(FOLDS):
                at = np.flatnonzero(part == p)
                if len(at):
                    x[at] = features(pdf["text"].iloc[at].tolist(), shared.value[p])
            yield pd.DataFrame({"label": pdf["label"], "part": part, "x": list(x)})

    rows = found.mapInPandas(dense, "label int, part int, x array<double>").toPandas()
    x, y, part = np.array(rows["x"].tolist()), rows["label"].to_numpy(float), rows["part"].to_numpy()
    order = np.lexsort((*x.T[::-1], y, part))
    x, y, part = x[order], y[order], part[order]
    w = np.where(y == 1, totals[1] / max(y.sum(), 1), totals[0] / max((1 - y).sum(), 1))
    raw = np.zeros(len(y))
    for p in range(FOLDS):
        at = part == p
        raw[at] = BoostedTrees().fit(x[~at], y[~at], w[~at]).raw(x[at]) if at.any() and (~at).any() else 0
    calibration = Isotonic().fit(sigmoid(raw), y, w)
    trees = BoostedTrees().fit(x, y, w)
    return ToxicityModel(lexicon(range(FOLDS)), trees, Calibrated(calibration), base)


class Calibrated:
    """Calibration that still ranks inside its flat blocks: a thousandth follows the raw score."""

    def __init__(self, isotonic: Isotonic):
        self.isotonic = isotonic

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        p = sigmoid(raw)
        return 0.999 * self.isotonic(p) + 0.001 * p


def score_documents(spark: SparkSession, docs: DataFrame, model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` (replacing such a column)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.tolist()))

    return docs.drop("score").withColumn("score", score(F.col(text)))


def op8_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document.

    Defined cases: null and empty texts are scored like any other, from zero features; rows
    with a null key or label are scored but not learned from; with too few labelled rows the
    score is the share of label 1; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(spark, docs, table(spark, sf_dir, "labels"))
    scored = score_documents(spark, docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
