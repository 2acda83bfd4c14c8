"""Language ID: blended-spectrum presence kernels, Nystroem landmarks, kernel ridge regression."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import held_out, labelled_sample, table

#: Orders of the byte n-grams of lower-cased text whose presence makes up the spectrum.
ORDERS = (2, 3, 4)
#: n-grams are hashed to this many bits; a document is the set of bits it touches.
SPECTRUM_BITS = 16
#: Bounds of the fit: learnable documents per language, and landmarks per language.
SAMPLE_PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 32
#: The same over all languages: with many of them, each gets fewer.
SAMPLE_ROWS = 8192
LANDMARKS = 1024
RIDGE = 1e-3
#: n-grams are common in a language if this share of its landmarks have them. A text is in a learned
#: language if so many times more of its n-grams are common in one than chance makes so. Measured: clean
#: texts of 20 letters and more have shares from 0.35 on, unlearned scripts and letter salad up to 0.17; chance 0.1.
COMMON_SHARE = 1 / 16
KNOWN_TIMES = 2
#: So many common n-grams are taken for granted in any text: a few letters prove nothing.
DOUBT = 4
UNKNOWN = "und"
_BATCH = 64
_CHUNK = 1 << 20
#: Bytes of each row's bits that are unpacked at a time.
_SLICE_BYTES = 256

# Odd multipliers of the n-gram hash; any odd numbers would do.
_MIX = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def mark_spectrum(text: str, row: np.ndarray) -> None:
    """Set the bits of ``row`` that the text's n-grams touch; long texts in overlapping chunks."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    for lo in range(0, len(data), _CHUNK):
        b = data[lo: lo + _CHUNK + max(ORDERS) - 1].astype(np.uint32)
        gram = b
        for order in range(2, max(ORDERS) + 1):
            if len(b) < order:
                break
            gram = (gram[:-1] << np.uint32(8)) | b[order - 1:]
            if order in ORDERS:
                row[(gram * np.uint32(_MIX[order])) >> np.uint32(32 - SPECTRUM_BITS)] = True


def spectra(texts: list) -> np.ndarray:
    """Presence matrix (texts x 2**SPECTRUM_BITS) of a batch."""
    out = np.zeros((len(texts), 1 << SPECTRUM_BITS), bool)
    for i, t in enumerate(texts):
        if isinstance(t, str):
            mark_spectrum(t, out[i])
    return out


def _slices(packed: np.ndarray):
    """The presence matrix of packed rows, a slice of the spectrum at a time: (columns, matrix)."""
    for lo in range(0, packed.shape[1], _SLICE_BYTES):
        part = packed[:, lo: lo + _SLICE_BYTES]
        yield slice(8 * lo, 8 * (lo + part.shape[1])), np.unpackbits(part, axis=1).astype(np.float32)


class LanguageModel:
    """One-versus-rest kernel ridge regression on a Nystroem approximation.

    k(x, z) = |x and z| / sqrt(|x| |z|) over presence sets. With landmarks Z and the
    whitened features K(x, Z) K(Z, Z)^-1/2, each language has a ridge regression to +1 / -1.
    Scoring is X Z' A for a batch X; Z' A does not depend on X and is multiplied out once, so
    a batch costs one product of its presence matrix with (spectrum x languages).

    ``packed`` holds the sample's presence bits, eight to a byte. They are never unpacked
    whole: kernel and table are sums over slices of the spectrum.
    """

    def __init__(self, packed: np.ndarray, languages: list, landmarks: np.ndarray, weights: np.ndarray):
        self.languages = sorted(set(languages))
        norms = np.sqrt(np.maximum(np.bitwise_count(packed).sum(axis=1, dtype=np.float64), 1))
        k = np.zeros((len(packed), len(landmarks)))
        for _, x in _slices(packed):
            k += x @ x[landmarks].T
        k /= norms[:, None] * norms[landmarks]
        values, vectors = np.linalg.eigh(k[landmarks])
        white = vectors / np.sqrt(np.maximum(values, 1e-6))
        phi = np.hstack([k @ white, np.ones((len(packed), 1))])
        y = np.where(np.array(languages)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        w = weights[:, None] / weights.mean()
        left = phi.T @ (w * phi) + RIDGE * len(packed) * np.diag([1.0] * (phi.shape[1] - 1) + [0.0])
        beta = np.linalg.solve(left + 1e-9 * np.eye(len(left)), phi.T @ (w * y))
        self.bias = beta[-1].astype(np.float32)
        dual = ((white @ beta[:-1]) / norms[landmarks][:, None]).astype(np.float32)
        self.table = np.zeros((8 * packed.shape[1], len(self.languages)), np.float32)
        for columns, z in _slices(packed[landmarks]):
            self.table[columns] = z.T @ dual
        # which n-grams are common in each language, and how many of any text's n-grams chance makes so
        kinds = np.array(languages)[landmarks]
        common = []
        for x in self.languages:
            bits = packed[landmarks[kinds == x]]
            times = np.concatenate([part.sum(axis=0) for _, part in _slices(bits)])
            common.append(times >= max(COMMON_SHARE * len(bits), 1))
        self.common = np.stack(common, axis=1).astype(np.float32)
        self.known = KNOWN_TIMES * float(self.common.mean(axis=0).max())

    def judge(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins (texts x languages), and of each text's n-grams the share that is common in the best language."""
        x = x.astype(np.float32)
        grams = np.maximum(x.sum(axis=1, dtype=np.float32), 1)
        familiar = ((x @ self.common).max(axis=1) + DOUBT) / (grams + DOUBT)
        return (x @ self.table) / np.sqrt(grams)[:, None] + self.bias, familiar


def fit_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                 per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel | None:
    """Fit on a bounded sample of learnable rows; None when there is no such row.

    The driver gets the samples' presence bits (8 KiB each), never their texts: of at most
    ``SAMPLE_ROWS`` rows, whatever the number of languages.
    """
    labels = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"))
    sample, totals = labelled_sample(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), labels, "lang",
                                     per_language, most_rows=SAMPLE_ROWS)

    def bits(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), _BATCH):
                part = pdf.iloc[lo: lo + _BATCH]
                packed = np.packbits(spectra(part["text"].tolist()), axis=1)
                yield pd.DataFrame({"label": part["label"], "bits": [r.tobytes() for r in packed]})

    found = [(r["label"], bytes(r["bits"])) for r in sample.where("text is not null").mapInPandas(bits, "label string, bits binary").collect()]
    if not found:
        return None
    found.sort()
    languages = [x for x, _ in found]
    packed = np.frombuffer(b"".join(b for _, b in found), np.uint8).reshape(len(found), -1)
    del found
    counts = pd.Series(languages).value_counts()
    each = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS // len(counts)))
    landmarks = np.concatenate([np.flatnonzero(np.array(languages) == x)[
        np.unique(np.linspace(0, counts[x] - 1, min(each, counts[x])).astype(int))] for x in sorted(counts.index)])
    weights = np.array([1 / counts[x] for x in languages])
    return LanguageModel(packed, languages, landmarks, weights)


def predict_language(spark: SparkSession, docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score`` and ``familiar`` (replacing such columns)."""
    docs = docs.drop("lang_pred", "score", "familiar")
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double, familiar: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        values = texts.tolist()
        names, scores, familiar = np.full(len(values), UNKNOWN, object), np.zeros(len(values)), np.zeros(len(values))
        known = [i for i, t in enumerate(values) if has_letter(t)] if m is not None else []
        for lo in range(0, len(known), _BATCH):
            at = known[lo: lo + _BATCH]
            margin, familiar[at] = m.judge(spectra([values[i] for i in at]))
            margin = margin.astype(np.float64)
            best = margin.argmax(axis=1)
            e = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
            names[at] = [m.languages[b] for b in best]
            scores[at] = 1 / e.sum(axis=1)
        return pd.DataFrame({"lang_pred": names, "score": scores, "familiar": familiar})

    out = docs.withColumn("__p", predict(F.col(text)))
    return out.select(*docs.columns, *[F.col(f"__p.{c}").alias(c) for c in ("lang_pred", "score", "familiar")])


def identify_language(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                      lang: str = "lang") -> DataFrame:
    """Fit on the rows of ``docs`` that may be learned from, then predict every whole text.

    ``score`` is a softmax over the languages' margins, ``familiar`` the share of the text's
    n-grams that is common in one language. Defined cases: a null text, or one without a letter, is
    ``und`` with both 0, and so is every text when there is nothing to learn from; rows with a null key or language are
    predicted but not learned from; an empty table gives no rows; columns named like a
    result column are replaced.
    """
    return predict_language(spark, docs, fit_language(docs, key, text, lang), text)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify_language(spark, docs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def documents_in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are in one of the learned languages stay.

    Rejected are texts without a letter (null ones too) and texts of whose n-grams no more are
    common in any language's landmarks than the model's ``known``: other scripts and letter salad. Where
    there is nothing to learn from, every text with a letter stays.
    """
    model = fit_language(docs)
    if model is None:
        letters = F.pandas_udf(lambda texts: texts.map(has_letter).astype(bool), "boolean")
        return docs.where(letters(F.col("text")))
    return predict_language(spark, docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("familiar") >= F.lit(model.known))).select(*docs.columns)
