"""Quality classifier: regularised quadratic discriminant over document statistics.

Every whole text becomes a short vector of transformed statistics. Class means and covariances
come from moments that Spark sums over all labelled rows; each covariance is shrunk towards the
pooled one and towards its diagonal. The score of a text is the logistic of the difference of
the two Gaussian log-densities, computed from Cholesky factors that are kept with the model.

Defined cases: a null text counts as empty and gets the score its (all zero) statistics have; a
null id is scored and never used for learning; of several labels of one id the largest counts;
repeated rows are scored each; without labelled rows of both classes every score is the share
of label 1 (0.5 without any label). Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm.common import bounded_batches, crc_bucket, materialize

_CLASSES = np.zeros(256, dtype=np.int64)
_CLASSES[ord("a") : ord("z") + 1] = 1
_CLASSES[ord("A") : ord("Z") + 1] = 2
_CLASSES[ord("0") : ord("9") + 1] = 3
for _c in b" \t\r\x0b\x0c":
    _CLASSES[_c] = 4
_CLASSES[ord("\n")] = 5
for _c in b".,;:?'\"-()":
    _CLASSES[_c] = 6
_CLASSES[128:] = 7
_N_CLASSES = 8  # 0: other ASCII marks and control characters

STATISTICS = (
    "log_words",
    "word_length",
    "distinct_words",
    "top_word",
    "same_neighbour",
    "upper",
    "digits",
    "marks",
    "plain_punctuation",
    "lines",
    "repeated_lines",
    "marked_words",
    "compression",
    "byte_entropy",
    "half_difference",
)


def _share(part: float, whole: float) -> float:
    """Log-odds of a share, with half a case added to both sides."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text."""
    if not text or not (words := text.split()):
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(raw, dtype=np.uint8)
    counts = np.bincount(codes, minlength=256)
    kinds = np.bincount(_CLASSES, weights=counts, minlength=_N_CLASSES)
    n, n_bytes = len(words), len(raw)
    found = Counter(words)
    letters = kinds[1] + kinds[2] + kinds[7]
    half = n_bytes // 2
    left = np.bincount(_CLASSES[codes[:half]], minlength=_N_CLASSES) / max(half, 1)
    right = np.bincount(_CLASSES[codes[half:]], minlength=_N_CLASSES) / (n_bytes - half)
    lines = [x for x in text.split("\n") if x]
    shares = counts[counts > 0] / n_bytes
    same = sum(map(str.__eq__, words, words[1:]))
    marked = sum(not (w[-1].isalnum() or w[-1] in ".,;:?") for w in words)
    return [
        float(np.log1p(n)),
        float(np.log(len(text) / n)),
        float(np.log(len(found)) / np.log(n + 1)),
        _share(max(found.values()), n),
        _share(same, n),
        _share(kinds[2], letters),
        _share(kinds[3], n_bytes),
        _share(kinds[0], n_bytes),
        _share(kinds[6], n_bytes),
        _share(len(lines), n + 1),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(marked, n),
        float(np.log(len(zlib.compress(raw, 1)) / (n_bytes + 20))),
        float(-(shares * np.log(shares)).sum()),
        float(np.abs(left - right).sum()),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(x) for x in texts], dtype=object)


@dataclass(frozen=True)
class QuadraticModel:
    """Two Gaussians with Cholesky factors; ``constant`` is set if one class was missing."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    scale: float = 1.0
    constant: float | None = None

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        dens = []
        for mean, inverse, offset in zip(self.means, self.factors, self.offsets, strict=True):
            y = (x - mean) @ inverse.T  # inverse of the Cholesky factor: |y|^2 is Mahalanobis
            dens.append(offset - 0.5 * (y * y).sum(axis=1))
        return dens[1] - dens[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x) * self.scale, -60, 60)))


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task and class: count, sums and products, as (label, place, value) rows."""
    d = len(STATISTICS) + 1
    total = np.zeros((2, d, d))
    for b in batches:
        x = np.column_stack([np.ones(len(b)), np.array(b["x"].tolist()).reshape(len(b), d - 1)])
        for k in (0, 1):
            y = x[(b["label"] == k).to_numpy()]
            total[k] += y.T @ y
    for k in (0, 1):
        if total[k, 0, 0]:
            yield pd.DataFrame({"label": k, "place": np.arange(d * d), "v": total[k].ravel()})


def fit(
    features: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    to_pooled: float = 0.4,
    to_diagonal: float = 0.05,
    temper: float = 0.5,
) -> QuadraticModel:
    """Learn from ``features`` (doc_id, x) joined with ``labels`` where ``learn`` holds.

    What reaches the driver is one matrix of the statistics' size per class. ``temper`` below 1
    flattens the log-odds, as statistics are less independent than Gaussians assume.
    """
    d = len(STATISTICS) + 1
    known = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .where(learn)
    )
    parts = features.join(known, "doc_id").select("label", "x")
    rows = (
        parts.mapInPandas(_moments, "label int, place int, v double")
        .groupBy("label", "place")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    total = np.zeros((2, d * d))
    for r in rows:
        total[r["label"], r["place"]] = r["v"]
    total = total.reshape(2, d, d)
    n = total[:, 0, 0]
    if not n.all():
        share = float(n[1] / n.sum()) if n.sum() else 0.5
        return QuadraticModel(np.zeros((2, d - 1)), np.zeros((2, 1, 1)), np.zeros(2), 1.0, share)
    means = total[:, 0, 1:] / n[:, None]
    covs = total[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (covs * n[:, None, None]).sum(axis=0) / n.sum()
    factors, offsets = [], []
    for k in (0, 1):
        c = (1 - to_pooled) * covs[k] + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + 1e-6 * np.eye(d - 1)
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        offsets.append(np.log(n[k] / n.sum()) - np.log(np.diag(low)).sum())
    return QuadraticModel(means, np.array(factors), np.array(offsets), temper)


def scorer(model: QuadraticModel):
    """A vectorised column function from statistics to a score."""

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist()).reshape(len(x), len(STATISTICS))))

    return score


def document_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and statistics of every row, written once: far narrower than the texts."""
    bounded_batches(docs.sparkSession)
    return materialize(docs.select("doc_id", statistics_of(F.col(text)).alias("x")), "quality")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    threshold: float = 0.3,
    folds: int = 5,
    held_fold: int = 0,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    features = document_features(docs)
    fold = crc_bucket("doc_id", folds)
    model = fit(features, labels, label, fold != held_fold)
    score = scorer(model)
    return features.select(
        "doc_id", (fold == held_fold).alias("held_out"), score("x").alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    threshold: float = 0.3,
    folds: int = 5,
    held_fold: int = 0,
) -> DataFrame:
    """The documents that score at least ``threshold``, all their columns, without a shuffle of
    texts: the model is fitted from narrow rows and the texts are read again to be filtered."""
    model = fit(document_features(docs), labels, label, crc_bucket("doc_id", folds) != held_fold)
    return docs.where(scorer(model)(statistics_of(F.col("text"))) >= threshold)
