"""Small models that are fitted on bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a classifier is fitted on, drawn by hash of the id.
SAMPLE = 20_000


def labelled_sample(labels: DataFrame, target: str, id_col: str = "doc_id", most: int = SAMPLE) -> DataFrame:
    """(id, target) of at most ``most`` labelled ids; an id with several labels has their largest."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(target).isin(0, 1)).groupBy(id_col).agg(F.max(target).alias(target))
    return rows.orderBy(F.xxhash64(id_col), id_col).limit(most)


class Logistic:
    """Logistic regression on standardised features with a small ridge, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> None:
        self.mean, self.scale = (x.mean(0), np.maximum(x.std(0), 1e-9)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        z = np.hstack([np.ones((len(x), 1)), np.clip((x - self.mean) / self.scale, -8, 8)])
        penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
        self.w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            grad = z.T @ (p - y) + penalty @ self.w
            step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(self.w)), grad)
            self.w -= np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        if not len(x):
            self.w[:] = 0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.w[1:] + self.w[0]

    def proba(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))
