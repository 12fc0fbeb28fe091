"""Bounded samples of labelled documents, and a small logistic model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold kept from training."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_labels(
    labels: DataFrame, label: str, folds: int, fold: int, limit: int, id_col: str = "doc_id"
) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold, marked for broadcast.

    Which ones is settled by a hash of the id. A first cut by the hash leaves hardly more
    than ``limit`` rows to the sort; the result is 16 bytes a row.
    """
    usable = labels.where(
        F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(id_col), folds, fold)
    ).select(F.col(id_col), F.col(label).cast("int").alias("label"))
    count = usable.count()
    order = F.xxhash64(id_col)
    if count > limit:
        share = min(1.0, 1.2 * limit / count)
        usable = usable.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = usable.groupBy(id_col).agg(F.max("label").alias("label"))
    return F.broadcast(picked.orderBy(order, id_col).limit(limit))


class Logistic:
    """Logistic regression on standardised features, fitted by Newton steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    @classmethod
    def fit(
        cls, rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0, steps: int = 30
    ) -> Logistic:
        mean = rows.mean(0) if len(rows) else np.zeros(rows.shape[1])
        scale = rows.std(0) if len(rows) else np.ones(rows.shape[1])
        scale = np.where(scale > 1e-9, scale, 1.0)
        x = np.hstack([np.ones((len(rows), 1)), (rows - mean) / scale])
        weights = np.zeros(x.shape[1])
        ridge = np.full(x.shape[1], penalty)
        ridge[0] = 1e-3
        for _ in range(steps):
            p = sigmoid(x @ weights)
            gradient = x.T @ (p - labels) + ridge * weights
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            step = np.linalg.solve(hessian, gradient)
            weights = weights - step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, weights)

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[0] + ((rows - self.mean) / self.scale) @ self.weights[1:]

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
