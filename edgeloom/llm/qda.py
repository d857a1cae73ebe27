"""Quality classifier: regularised quadratic discriminant over transformed text statistics.

Class moments are summed over all labelled rows in the tasks that hold them, so the driver sees two
small matrices. Covariances are shrunk towards the pooled one and the identity; their Cholesky
factors are kept, and a score is the logistic of the difference of the log densities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.textstats import COUNTS, text_counts
from edgeloom.plans import stage

FEATURES = ("words", "mean_word", "symbols", "marks", "digits", "upper", "wide", "line_words", "dup_lines",
            "repeats", "distinct", "top_word")


def features(counts: np.ndarray) -> np.ndarray:
    """Transformed statistics, a row per document; ``counts`` has the columns of ``COUNTS``."""
    c = {name: counts[:, i].astype(float) for i, name in enumerate(COUNTS)}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    letters, lines = np.maximum(c["n_upper"] + c["n_lower"], 1), np.maximum(c["n_lines"], 1)
    root = lambda part, whole: np.sqrt(part / whole)
    return np.column_stack([
        np.log1p(c["n_words"]), np.log1p(chars / words), root(c["n_symbols"], chars), root(c["n_marks"], chars),
        root(c["n_digits"], chars), root(c["n_upper"], letters), root(c["n_wide"], chars),
        np.log1p(words / lines), root(c["n_dup_lines"], lines), root(c["n_repeat_words"], words),
        root(c["n_distinct_words"], words) + 1 / np.sqrt(words), root(c["n_top_word"], words),
    ])


@dataclass
class Qda:
    """A fitted model; ``factors`` are the inverses of the Cholesky factors, ``logdets`` half log determinants."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    log_prior: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [-0.5 * (((x - m) @ f.T) ** 2).sum(1) - d
                   for m, f, d in zip(self.means, self.factors, self.logdets)]
        # beyond 500 the logistic is 0 or 1 to the last bit
        margin = np.clip(density[1] - density[0] + self.log_prior, -500, 500)
        return 1 / (1 + np.exp(-margin))


def fit_moments(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrink: float = 0.2,
                ridge: float = 0.02) -> Qda:
    """A model from counts, sums and second moments of the classes 0 and 1.

    With one class only, each score is that class; with none, 0.5.
    """
    if (n == 0).any():
        constant = 0.5 if (n == 0).all() else float(n[1] > 0)
        return Qda(sums, squares, n, 0.0, constant)
    means = sums / n[:, None]
    scatter = squares - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / n.sum()
    scale = np.maximum(np.diag(pooled), 1e-6)
    factors, logdets = [], []
    for k in (0, 1):
        # a small class leans more on the pooled covariance
        weight = shrink + (1 - shrink) * len(scale) / (len(scale) + n[k])
        cov = (1 - weight) * scatter[k] / n[k] + weight * pooled
        cov = (1 - ridge) * cov + ridge * np.diag(scale)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        logdets.append(np.log(np.diag(lower)).sum())
    return Qda(means, np.array(factors), np.array(logdets), float(np.log(n[1] / n[0])))


def class_moments(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums and second moments of ``counts(quality, *COUNTS)`` by class, summed in Spark."""
    d = len(FEATURES)

    def partial(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            quality = batch.column(0).to_numpy(zero_copy_only=False)
            x = features(np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(COUNTS))]))
            for k in (0, 1):
                rows = x[quality == k]
                total[k] += np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows).ravel()])
        k, at = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(at), pa.array(total.ravel())], ["k", "at", "value"])

    sums = counts.select(F.col("quality").cast("bigint"), *COUNTS).mapInArrow(
        partial, "k bigint, at bigint, value double").groupBy("k", "at").agg(F.sum("value").alias("value"))
    total = np.zeros((2, 1 + d + d * d))
    for row in sums.collect():  # 2 * (1 + d + d * d) numbers
        total[row.k, row.at] = row.value
    return total[:, 0], total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d)


def quality_scores(docs: DataFrame, labels: DataFrame, train: str = "true") -> DataFrame:
    """``(doc_id, score)``, a row for each row of ``docs(doc_id, text)``.

    ``train`` is a condition on ``doc_id``; only labels of 0 or 1 of rows that meet it are used.
    Null and empty texts are scored as texts without words. Without labels of both classes the score
    is constant (see ``fit_moments``).
    """
    counts = stage(text_counts(docs), "counts")
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(train).select("doc_id", "quality")
    model = fit_moments(*class_moments(counts.join(known, "doc_id")))

    def score(batches):
        for batch in batches:
            x = features(np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(COUNTS))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    id_type = counts.schema["doc_id"].dataType.simpleString()
    return counts.mapInArrow(score, f"doc_id {id_type}, score double")
