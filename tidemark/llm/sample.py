"""Bounded training samples and small numpy pieces shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold

TRAIN_DOCS = 6000
TRAIN_CHARS = 20_000
HELD_OUT_FOLD = 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
                    train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> DataFrame:
    """(key, text, label) of at most `train_docs` labelled documents outside the held-out fold.

    The first ids in the order of a hash of the id, so the sample is even over the table and the
    same on every run; documents over `train_chars` characters are left to scoring. Rows with a
    null id, label or text are not used; of several labels of a document the largest counts.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(key) != HELD_OUT_FOLD))
    picked = usable.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    picked = picked.orderBy(F.xxhash64("key"), "key").limit(train_docs)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.char_length("text") <= train_chars)
    # At most train_docs ids are sent.
    return rows.join(F.broadcast(picked), "key").dropDuplicates(["key"])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Adam steps on a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.t), self.v[k] / (1 - 0.999 ** self.t)
            self.params[k] -= self.rate * m / (np.sqrt(v) + 1e-8)


def fit_line(x: np.ndarray, y: np.ndarray, decay: float = 1e-2) -> tuple[float, float]:
    """Offset and slope of a logistic curve through (x, y), by Newton's method."""
    design, w = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(30):
        p = sigmoid(design @ w)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + decay * np.eye(2)
        w -= np.linalg.solve(hessian, design.T @ (p - y) + decay * w)
    return float(w[0]), float(w[1])
