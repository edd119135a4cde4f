"""Labelled samples of bounded size, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.llm.common import held_out, stored


def learnable(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """``id`` and ``label`` (0 or 1, the least one of an id) of all documents that may be learnt from."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))
    )
    return known.groupBy("id").agg(F.min("label").cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, doc_id: str = "doc_id") -> DataFrame:
    """Training documents with their label (0 or 1): about ``per_class`` rows of each class at most, for any input.

    Rows whose id is held out take no part, nor do rows without id or label; an id with several labels has the least
    one.  The choice goes by a hash of the id, so it is the same in every run.  Only ids and labels are sent
    to all executors, and they are as many as ``per_class`` says, so the texts are not shuffled.
    """
    known = stored(learnable(labels, label, doc_id), "training-labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("id", F.lit("training")), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for value in (0, 1):
        chosen = chosen | ((F.col("label") == value) & (place < per_class / max(per_class, counts.get(value, 0))))
    sample = stored(known.where(chosen), "training-sample")
    kept = docs.drop("label")
    return kept.join(F.broadcast(sample), kept[doc_id] == sample["id"]).drop("id")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 50) -> np.ndarray:
    """Coefficients that minimise the weighted logistic loss with a quadratic penalty, by Newton's method."""
    beta = np.zeros(x.shape[1])
    scale = penalty * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + scale @ beta
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + scale
        step = np.linalg.solve(curvature, gradient)
        size = np.abs(step).max()
        beta -= step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return beta
