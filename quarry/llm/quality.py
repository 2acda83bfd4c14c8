"""Quality: a generalised additive model with pairwise interactions, read from lookup tables."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.boosting import bin_edges, sigmoid, split_gain, to_bins
from quarry.llm.common import held_out, labelled_sample, table
from quarry.llm.toxicity import score_documents, slices, split_words

#: Bound of the fit: learnable rows per label value.
SAMPLE_PER_LABEL = 4000
BINS = 32
PAIR_BINS = 8
ROUNDS = 200
PAIRS = 6
PAIR_ROUNDS = 60
RATE = 0.1
RIDGE = 3.0

FEATURES = ("log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "short_words", "symbols", "pipes",
            "punctuation", "digits", "capitals", "non_ascii", "line_ends", "repeated_lines", "words_per_line", "sentence_ends", "long_words")


def features(texts: list) -> np.ndarray:
    """Dense features of each text that need no language."""
    out = np.zeros((len(texts), len(FEATURES)))
    for lo, hi in slices(texts):
        part = texts[lo:hi]
        vocabulary, code, at = split_words(part)
        size = np.array([len(w) for w in vocabulary] or [0], float)[code] if len(code) else np.zeros(0)
        sums = np.zeros((4, len(code) + 1))
        for k, v in enumerate((size, size ** 2, size <= 3, size >= 12)):
            np.cumsum(v, out=sums[k, 1:])
        total = sums[:, at[1:]] - sums[:, at[:-1]]
        words = np.maximum(at[1:] - at[:-1], 1)
        for i, t in enumerate(part):
            text = t if isinstance(t, str) else ""
            row, n = out[lo + i], words[i]
            found, counts = np.unique(code[at[i]: at[i + 1]], return_counts=True)
            b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            by = np.bincount(b, minlength=256)
            chars = max(len(b), 1)
            lines = text.split("\n")
            mean = total[0, i] / n
            row[:] = (np.log1p(at[i + 1] - at[i]), mean, np.sqrt(max(total[1, i] / n - mean ** 2, 0)), len(found) / n,
                      (counts.max() if len(counts) else 0) / n, total[2, i] / n, by[[35, 36, 37, 38, 42, 64, 94, 126]].sum() / chars,
                      by[124] / n, by[[33, 34, 39, 40, 41, 44, 45, 46, 47, 58, 59, 63, 95]].sum() / chars, by[48:58].sum() / chars,
                      by[65:91].sum() / chars, by[128:].sum() / chars, by[10] / n, 1 - len(set(lines)) / len(lines), n / len(lines),
                      by[[33, 46, 63]].sum() / n, total[3, i] / n)
    return out


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of a tree with at most four leaves over one feature's ordered bins."""
    out = np.zeros(len(g))
    gain, at = split_gain(g, h, RIDGE)
    halves = [(0, at), (at, len(g))] if gain > 0 else [(0, len(g))]
    for lo, hi in halves:
        gain, cut = split_gain(g[lo:hi], h[lo:hi], RIDGE)
        for a, b in ([(lo, lo + cut), (lo + cut, hi)] if gain > 0 else [(lo, hi)]):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree that cuts one feature, then each side by the other."""
    best, values = 0.0, np.zeros(g.shape)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, a.shape[0]):
            gain, v = 0.0, np.zeros(a.shape)
            for rows in (slice(0, at), slice(at, None)):
                ga, ha = a[rows].sum(axis=0), b[rows].sum(axis=0)
                _, cut = split_gain(ga, ha, RIDGE)
                for cols in (slice(0, cut), slice(cut, None)):
                    gs, hs = ga[cols].sum(), ha[cols].sum()
                    v[rows, cols] = gs / (hs + RIDGE)
                    gain += gs ** 2 / (hs + RIDGE)
            if gain > best:
                best, values = gain, (v.T if flip else v)
    return best, values


class AdditiveModel:
    """Lookup tables of single features and of feature pairs, learned by cyclic boosting.

    Each round visits every feature in turn and adds a small shallow tree over its bins to
    its table. Pairs are then ranked by how much of the residual a two-way tree explains,
    and the best are boosted in the same way. A score is a sum of table entries.
    """

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> AdditiveModel:
        w = w / w.mean()
        self.edges, self.coarse = bin_edges(x, BINS), bin_edges(x, PAIR_BINS)
        b, c = to_bins(x, self.edges), to_bins(x, self.coarse)
        base = np.clip((w * y).sum() / w.sum(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(base / (1 - base)))
        self.tables = [np.zeros(BINS + 1) for _ in range(x.shape[1])]
        raw = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for f, t in enumerate(self.tables):
                p = sigmoid(raw)
                step = RATE * shallow_tree(np.bincount(b[:, f], w * (y - p), BINS + 1), np.bincount(b[:, f], w * p * (1 - p), BINS + 1))
                t += step
                raw += step[b[:, f]]
        width = PAIR_BINS + 1

        def grids(i, j):
            p, at = sigmoid(raw), c[:, i] * width + c[:, j]
            return (np.bincount(at, w * (y - p), width * width).reshape(width, width),
                    np.bincount(at, w * p * (1 - p), width * width).reshape(width, width), at)

        ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda ij: (-pair_tree(*grids(*ij)[:2])[0], ij))
        self.pairs = ranked[:PAIRS]
        self.grids = [np.zeros((width, width)) for _ in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (i, j), t in zip(self.pairs, self.grids):
                g, h, at = grids(i, j)
                step = RATE * pair_tree(g, h)[1]
                t += step
                raw += step.ravel()[at]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, c = to_bins(x, self.edges), to_bins(x, self.coarse)
        out = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            out += t[b[:, f]]
        for (i, j), t in zip(self.pairs, self.grids):
            out += t[c[:, i], c[:, j]]
        return out


class QualityModel:
    def __init__(self, additive: AdditiveModel | None, base: float):
        self.additive, self.base = additive, base

    def score(self, texts: list) -> np.ndarray:
        if self.additive is None or not texts:
            return np.full(len(texts), self.base)
        return sigmoid(self.additive.raw(features(texts)))


def fit_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                label: str = "quality", per_label: int = SAMPLE_PER_LABEL) -> QualityModel:
    """Fit on a bounded sample of learnable rows, weighted back to the labels' true shares.

    The driver gets the samples' feature rows, no texts.
    """
    found, totals = labelled_sample(docs, labels.select(key, F.col(label).cast("int").alias(label)).where(f"{label} in (0, 1)"),
                                    label, per_label, key, text)

    def dense(batches):
        for pdf in batches:
            yield pd.DataFrame({"label": pdf["label"], "x": list(features(pdf["text"].tolist()))})

    rows = found.mapInPandas(dense, "label int, x array<double>").toPandas()
    base = totals.get(1, 0) / max(sum(totals.values()), 1)
    y = rows["label"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return QualityModel(None, base)
    x = np.array(rows["x"].tolist())
    order = np.lexsort((*x.T[::-1], y))
    x, y = x[order], y[order]
    w = np.where(y == 1, totals[1] / y.sum(), totals[0] / (1 - y).sum())
    return QualityModel(AdditiveModel().fit(x, y, w), base)


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document.

    Defined cases: null and empty texts are scored from the features of an empty text; rows
    with a null key or label are scored but not learned from; without both labels the score
    is the share of label 1; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(spark, docs, table(spark, sf_dir, "labels"))
    scored = score_documents(spark, docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
