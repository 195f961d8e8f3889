"""Positive-unlabelled learning with the non-negative risk estimator, in numpy.

With class prior p, the risk of a scorer g is  p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)),
R+ and R- being mean losses for the labels 1 and 0. The second part estimates the risk on negatives;
on a batch where it falls below zero the model has begun to overfit, and the step goes up that part
instead of down the sum (Kiryo et al., 2017). The loss is logistic, so g's sigmoid estimates the
probability of label 1.

Models are fitted on the driver from bounded samples: at most ``POSITIVES`` and ``UNLABELLED`` rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITIVES, UNLABELLED = 8_000, 16_000


def sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


class NonNegativePU:
    """A scorer with one hidden layer (``hidden`` = 0: linear), trained by Adam on nnPU risk."""

    def __init__(self, hidden: int = 0, epochs: int = 40, batch: int = 1500, rate: float = 0.01, decay: float = 1e-4, seed: int = 42):
        self.hidden, self.epochs, self.batch = hidden, epochs, batch
        self.rate, self.decay, self.seed = rate, decay, seed

    def _forward(self, x):
        if not self.hidden:
            return x, x @ self.w[0] + self.w[1]
        h = np.tanh(x @ self.w[0] + self.w[1])
        return h, h @ self.w[2] + self.w[3]

    def _backward(self, x, h, slope):
        if not self.hidden:
            return [h.T @ slope, slope.sum()]
        inner = np.outer(slope, self.w[2]) * (1 - h * h)
        return [x.T @ inner, inner.sum(0), h.T @ slope, slope.sum()]

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> NonNegativePU:
        both = np.concatenate([positive, unlabelled])
        kind = both.dtype
        self.mean, self.scale = both.mean(0).astype(kind), (both.std(0) + 1e-6).astype(kind)
        xp, xu = self._scaled(positive), self._scaled(unlabelled)
        rng, d = np.random.default_rng(self.seed), xp.shape[1]
        if self.hidden:
            self.w = [rng.normal(0, d**-0.5, (d, self.hidden)), np.zeros(self.hidden), rng.normal(0, self.hidden**-0.5, self.hidden), np.zeros(())]
        else:
            self.w = [np.zeros(d), np.zeros(())]
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in self.w]
        steps, t = max(1, len(xu) // self.batch), 0
        for epoch in range(self.epochs):
            rate = self.rate * (1 - epoch / self.epochs)
            order_p, order_u = rng.permutation(len(xp)), rng.permutation(len(xu))
            for k in range(steps):
                p, u = xp[order_p[k::steps]] if len(xp) >= steps else xp, xu[order_u[k::steps]]
                hp, gp = self._forward(p)
                hu, gu = self._forward(u)
                negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
                up = self._backward(p, hp, prior * (sigmoid(gp) - 1) / len(p))
                down_u = self._backward(u, hu, sigmoid(gu) / len(u))
                down_p = self._backward(p, hp, prior * sigmoid(gp) / len(p))
                if negative >= 0:
                    slopes = [a + b - c for a, b, c in zip(up, down_u, down_p)]
                else:
                    slopes = [c - b for b, c in zip(down_u, down_p)]
                t += 1
                for i, slope in enumerate(slopes):
                    slope = slope + self.decay * self.w[i]
                    m = moments[i]
                    m[0] = 0.9 * m[0] + 0.1 * slope
                    m[1] = 0.999 * m[1] + 0.001 * slope**2
                    self.w[i] = self.w[i] - rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8)
        return self

    def _scaled(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self._forward(self._scaled(x))[1])


class Constant:
    """The scorer where there is nothing to learn from."""

    def __init__(self, value: float):
        self.value = value

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text falls into ``part``; a missing key is never held out."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == part, F.lit(False))


def class_prior(labels: DataFrame, label: str) -> float:
    """Estimated share of label 1: that among the labelled rows, kept off 0 and 1."""
    n, ones = labels.where(F.col(label).isNotNull()).agg(F.count(F.lit(1)), F.sum((F.col(label) == 1).cast("int"))).first()
    return float(np.clip(((ones or 0) + 1) / (n + 2), 0.01, 0.99))


def drawn_rows(documents: DataFrame, labels: DataFrame, label: str, key: str, text: str, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """(key, text, positive, unlabelled): bounded samples of trusted and of any rows, by key hash.

    Both are samples of keys without repeats, so a row can be in both. Rows with a missing key
    aren't drawn.
    """
    trusted = labels.where(F.col(label) == 1).select(key).distinct().where(F.col(key).isNotNull())
    p = trusted.orderBy(F.xxhash64(key, F.lit(1)), key).limit(positives).withColumn("positive", F.lit(1))
    ids = documents.select(key).where(F.col(key).isNotNull()).distinct()
    u = ids.orderBy(F.xxhash64(key, F.lit(2)), key).limit(unlabelled).withColumn("unlabelled", F.lit(1))
    chosen = p.join(u, key, "full")
    return documents.select(key, text).join(F.broadcast(chosen), key)  # at most positives + unlabelled rows
