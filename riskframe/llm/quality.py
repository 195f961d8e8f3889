"""Quality classifier: positive-unlabelled learning on the shape of whole texts.

Trusted documents are the positives, documents of the same corpus the unlabelled text, and the share
of trusted among all labelled rows the estimated class prior. The features describe letters, marks,
repetition and lines; the scorer is a small network trained on non-negative unbiased risk.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import pu

SENTENCE, SYMBOLS = ".,;:'\"()-", "#$%&*|<>=+~^_\\{}[]@/!"


def shape_of(text: str | None) -> list[float]:
    """Features of one whole text; a missing text is empty."""
    text = text or ""
    n = len(text)
    words = text.split()
    k = len(words)
    if not k:
        return [0.0] * 19
    raw = text.encode("utf-8", "surrogatepass")
    chars = Counter(text)
    upper = sum(v for c, v in chars.items() if c.isupper())
    digits = sum(v for c, v in chars.items() if c.isdigit())
    letters = sum(v for c, v in chars.items() if c.isalpha())
    marks = sum(chars.get(c, 0) for c in SENTENCE)
    symbols = sum(chars.get(c, 0) for c in SYMBOLS)
    counts = Counter(words)
    top = [v for _, v in counts.most_common(3)]
    lines = [x for x in text.split("\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, k)
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(k),
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        upper / max(letters, 1),
        letters / n,
        digits / n,
        marks / n,
        symbols / n,
        symbols / k,
        chars.get("|", 0) / k,
        len(counts) / k,
        top[0] / k,
        sum(top) / k,
        sum(map(str.__eq__, words, words[1:])) / k,
        pairs / k,
        np.log(len(raw) / len(zlib.compress(raw, 1))),
        np.log1p(len(lines)),
        1 - len(set(lines)) / max(len(lines), 1),
    ]


def shapes(text):
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, shape_of(t))) for t in texts])

    return run(text)


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text"):
    """A scorer from the labels given (leave held-out rows out beforehand)."""
    prior = pu.class_prior(labels, label)
    rows = pu.drawn_rows(documents, labels, label, key, text)
    shaped = rows.select(key, "positive", "unlabelled", shapes(F.col(text)).alias("x"))
    once = shaped.groupBy(key).agg(*(F.min(c).alias(c) for c in ("x", "positive", "unlabelled"))).orderBy(key).collect()
    positive = np.array([r["x"] for r in once if r["positive"]])
    unlabelled = np.array([r["x"] for r in once if r["unlabelled"]])
    if not len(positive) or not len(unlabelled):
        return pu.Constant(prior)
    return pu.NonNegativePU(hidden=24, epochs=60).fit(positive, unlabelled, prior)


def scored(documents: DataFrame, model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows with ``out``, the estimated probability of good quality."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.predict(np.array([shape_of(t) for t in texts]).reshape(len(texts), -1)))

    return documents.withColumn(out, run(F.col(text)))


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", parts: int = 3, part: int = 1) -> DataFrame:
    """(key, held_out, score, predicted) per document, learnt from rows that aren't held out.

    Defined results: missing and empty texts are scored like any (all features zero), repeated rows
    get equal scores, a missing key isn't held out, missing labels say nothing, labels that
    contradict each other count as trusted. Without positives every score is the prior.
    """
    out = pu.held_out(F.col(key), parts, part)
    model = fit(documents.where(~out), labels.where(~out), label, key, text)
    return (
        scored(documents.select(key, text), model, text)
        .withColumn("held_out", out)
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .select(key, "held_out", "score", "predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", parts: int = 3, part: int = 1) -> DataFrame:
    """Documents whose score is at least 0.5; all columns as they came."""
    out = pu.held_out(F.col(key), parts, part)
    model = fit(documents.where(~out), labels.where(~out), label, key, text)
    score = "_score"
    while score in documents.columns:
        score = "_" + score
    return scored(documents, model, text, score).where(F.col(score) >= 0.5).select(documents.columns)
