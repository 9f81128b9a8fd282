"""Bounded labelled samples and small linear models fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import fold, written


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int
) -> DataFrame:
    """At most ``limit`` rows (label, text) outside the held-out fold, in
    the order of a hash of the id. Labels other than 0 and 1, null ids and
    contradicting labels of one id are left out; an id with several texts
    has its smallest one. The ids wanted are at most ``limit``, so they go to
    the texts."""
    wanted = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top")).where("label = top")
        .where(fold(F.col("doc_id"), folds) != held)
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).drop("top")
    )
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return written(found.select("label", "text"), f"sample-{label}")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; y is 0 or 1."""
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ weights)
        gradient = x.T @ (p - y) + ridge * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss,
    by Newton steps on its active rows; y is 0 or 1, the last weight is the
    bias."""
    x, sign = np.c_[x, np.ones(len(x))], 2.0 * y - 1
    weights = np.zeros(x.shape[1])
    keep = np.r_[np.ones(x.shape[1] - 1), 1e-6]
    for _ in range(steps):
        active = sign * (x @ weights) < 1
        a = x[active]
        after = np.linalg.solve(np.diag(keep) + 2 * cost * a.T @ a, 2 * cost * a.T @ sign[active])
        if np.abs(after - weights).max() < 1e-9:
            break
        weights = after
    return weights
