"""Quality classifier: regularised quadratic discriminant analysis over transformed text statistics.

Each class gets its own mean and covariance. A class covariance is shrunk towards the pooled one and then
towards its own diagonal, so that it stays invertible with few rows. The score of a document is the posterior
probability of label 1, from the difference of the two Gaussian log densities: squared Mahalanobis distances by
solving with Cholesky factors that are computed once and sent along with the scoring function.

Training is one aggregate: row counts, sums and sums of products per class, over every labelled row in use.

Defined results: null and empty texts have zero counts and get a score like any other; a document with several
label rows counts with each; null labels are left out; if a class has no rows, every score is the smoothed share
of label 1; a null doc_id is never held out. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import query, table, written
from .doc_features import COUNTS, counts

#: Pseudo-counts pull the shares of short texts towards what is usual, as a share of few words says little.
PRIOR_CHARS, PRIOR_WORDS, PRIOR_LINES = 60.0, 15.0, 4.0
POOLED, DIAGONAL = 0.1, 0.05
PREDICT_FROM = 0.7


def statistics(c: Column | None = None) -> list[Column]:
    """Transformed statistics, from the counts of a text: logarithms of sizes, square roots of shares."""
    n = {k: (c[k] if c is not None else F.col(k)).cast("double") for k in COUNTS}

    def share(part: Column, whole: Column, usual: float, weight: float) -> Column:
        return F.sqrt((part + usual * weight) / (whole + weight))

    return [
        F.log1p(n["n_words"]),
        share(n["n_symbols"], n["word_chars"], 0.0005, PRIOR_CHARS),
        share(n["n_dup_lines"], n["n_lines"], 0.002, PRIOR_LINES),
        share(n["n_repeat_words"], n["n_words"], 0.002, PRIOR_WORDS),
        share(n["n_echo"], n["n_words"], 0.01, PRIOR_WORDS),
        share(n["n_distinct"], n["n_words"], 0.7, PRIOR_WORDS),
        share(n["n_upper"], n["word_chars"], 0.03, PRIOR_CHARS),
        share(n["n_digits"], n["word_chars"], 0.002, PRIOR_CHARS),
        share(n["n_stops"], n["n_words"], 0.1, PRIOR_WORDS),
        F.log((n["word_chars"] + 5 * PRIOR_WORDS) / (n["n_words"] + PRIOR_WORDS)),
        F.log((n["n_words"] + 20 * PRIOR_LINES) / (n["n_lines"] + PRIOR_LINES)),
    ]


class Discriminant:
    """Two Gaussian densities with cached Cholesky factors."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float, diagonal: float):
        n = {k: moments[k][0] if k in moments else 0.0 for k in (0, 1)}
        self.share = (n[1] + 1) / (n[0] + n[1] + 2)
        self.classes = None
        if min(n.values()) == 0:
            return
        mean = {k: s / w for k, (w, s, _) in moments.items()}
        own = {k: q / w - np.outer(mean[k], mean[k]) for k, (w, _, q) in moments.items()}
        both = sum(n[k] * own[k] for k in own) / sum(n.values())
        self.classes = {}
        for k in (0, 1):
            cov = (1 - pooled) * own[k] + pooled * both
            cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            self.classes[k] = mean[k], factor, 2 * np.log(np.diag(factor)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), np.log(self.share / (1 - self.share)))
        if self.classes is not None:
            for k, sign in ((1, -0.5), (0, 0.5)):
                mean, factor, log_det = self.classes[k]
                odds += sign * ((np.linalg.solve(factor, (x - mean).T) ** 2).sum(0) + log_det)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def class_moments(rows: DataFrame, features: str, label: str, size: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Number of rows, sums, and sums of products per class: two rows come back, whatever the input."""
    x = [F.col(features)[i] for i in range(size)]
    sums = [F.sum(a).alias(f"s{i}") for i, a in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(size) for j in range(i + 1)]
    out = {}
    for r in rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count("*").alias("n"), *sums, *products).collect():
        q = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        out[int(r[label])] = float(r["n"]), np.array([r[f"s{i}"] for i in range(size)]), q
    return out


def score_quality(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality",
    learn_from: Column | None = None, pooled: float = POOLED, diagonal: float = DIAGONAL,
) -> DataFrame:
    """``id``, ``score`` and ``predicted`` of every document. Only labelled rows for which
    ``learn_from`` (an expression over ``id``) holds are learned from; the id is used for nothing else."""
    measured = docs.select(F.col(f"`{id}`").alias("id"), counts(F.col(f"`{text}`")).alias("c"))
    measured = written(measured.select("id", F.array(*statistics(F.col("c"))).alias("x")), "quality-statistics")
    known = labels.select(F.col(id).alias("label_id"), F.col(label).cast("int").alias("label"))
    if learn_from is not None:
        known = known.where(learn_from)
    size = len(statistics())
    labelled = measured.join(known, F.col("id") == F.col("label_id")).select("x", "label")
    model = Discriminant(class_moments(labelled, "x", "label", size), pooled, diagonal)

    def run(frames: Iterator[pd.DataFrame]):
        for frame in frames:
            yield frame.drop(columns="x").assign(score=model.score(np.stack(frame["x"].to_numpy())) if len(frame) else [])

    scored = measured.mapInPandas(run, T.StructType([measured.schema["id"], T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", F.when(F.col("score") >= PREDICT_FROM, 1).otherwise(0))


def fold(id: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % folds


@query()
def op4_quality_classifier(spark, sf_dir):
    """Score and prediction of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = score_quality(docs, labels, learn_from=fold(F.col("label_id"), 4) != 2)
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold(F.col("id"), 4) == 2).alias("held_out"),
        "score",
        "predicted",
    )
