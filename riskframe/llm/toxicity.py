"""Toxicity: positive-unlabelled learning on the words of whole texts.

Confirmed toxic documents are the positives. The words and word beginnings (languages with endings put
many forms on one stem) of the bounded samples are counted in Spark; those whose share among positives
and among unlabelled text differs clearly (``least_z``) become the features: whether a text holds them. A linear scorer is trained on class-prior-corrected,
non-negative risk; the prior is the share of toxic among labelled rows.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import pu
from riskframe.session import materialise

_LETTERS = re.compile(r"[^\W\d_]+")
#: Bound of the vocabulary, and the lengths of word beginnings.
VOCABULARY, STEMS = 800, (4, 5, 6)


def words_of(text: str | None) -> set[str]:
    """Distinct words; a longer word counts by its first 40 letters."""
    return {w[:40] for w in _LETTERS.findall(text.lower())} if text else set()


def features_of(words: set[str]) -> set[str]:
    """The words, and their beginnings marked by a hyphen."""
    out = set(words)
    for n in STEMS:
        out.update([w[:n] + "-" for w in words if len(w) > n])
    return out


def word_sets(text):
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(features_of(words_of(t))) for t in texts])

    return run(text)


class WordScorer:
    def __init__(self, words: list[str], model):
        self.index, self.model = {w: i for i, w in enumerate(words)}, model
        self.stems = {n: {w[:-1] for w in words if w[-1] == "-" and len(w) == n + 1} for n in STEMS}

    def matrix(self, rows) -> np.ndarray:
        """One row per (features found, number of distinct words)."""
        x = np.zeros((len(rows), len(self.index) + 1), np.float32)
        for i, (found, n) in enumerate(rows):
            x[i, [self.index[w] for w in found]] = 1
            x[i, -1] = np.log1p(n)
        return x

    def found(self, words: set[str]) -> list[str]:
        out = list(self.index.keys() & words)
        for n, stems in self.stems.items():
            if stems:
                out += [w + "-" for w in {w[:n] for w in words if len(w) > n} & stems]
        return out

    def predict(self, texts) -> np.ndarray:
        sets = [words_of(t) for t in texts]
        return self.model.predict(self.matrix([(self.found(w), len(w)) for w in sets]))


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", least_z: float = 5.0) -> WordScorer:
    """A scorer from the labels given (leave held-out rows out beforehand)."""
    prior = pu.class_prior(labels, label)
    rows = pu.drawn_rows(documents, labels, label, key, text)
    sets = rows.select(key, "positive", "unlabelled", word_sets(F.col(text)).alias("w"))
    sets = materialise(sets.groupBy(key).agg(*(F.min(c).alias(c) for c in ("w", "positive", "unlabelled"))), "word-sets")
    n_p, n_u = sets.agg(F.count("positive"), F.count("unlabelled")).first()
    if not n_p or not n_u:
        return WordScorer([], pu.Constant(prior))
    share_p, share_u = F.col("p") / n_p, F.col("u") / n_u
    both = (F.col("p") + F.col("u") + 1) / (n_p + n_u)
    z = (share_p - share_u) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    words = (
        sets.select("positive", "unlabelled", F.explode("w").alias("w"))
        .groupBy("w").agg(F.count("positive").alias("p"), F.count("unlabelled").alias("u"))
        .where(F.col("p") + F.col("u") >= 8).withColumn("z", z).where(F.abs("z") >= least_z)
        .orderBy(F.abs("z").desc(), "w").limit(VOCABULARY)
    )
    vocabulary = _distinct({r["w"]: r["p"] + r["u"] for r in words.collect()})
    scorer = WordScorer(vocabulary, None)
    known = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    plain = F.size(F.filter("w", lambda w: ~w.endswith("-")))
    sample = sets.select(key, "positive", "unlabelled", F.array_intersect("w", known).alias("w"), plain.alias("n")).orderBy(key).collect()
    x = scorer.matrix([(r["w"], r["n"]) for r in sample])
    p, u = np.array([r["positive"] is not None for r in sample]), np.array([r["unlabelled"] is not None for r in sample])
    scorer.model = pu.NonNegativePU(epochs=150, batch=4000, decay=1e-3).fit(x[p], x[u], prior)
    return scorer


def _distinct(counts: dict[str, int]) -> list[str]:
    """Features without the beginnings that stand for hardly more than one longer feature."""
    names = sorted(counts)
    covered = {
        stem
        for stem in names if stem[-1] == "-"
        for word in names if word != stem and word.startswith(stem[:-1]) and counts[word] >= 0.95 * counts[stem]
    }
    return [w for w in names if w not in covered]


def scored(documents: DataFrame, model: WordScorer, text: str = "text", out: str = "score") -> DataFrame:
    """All rows with ``out``, the estimated probability of being toxic."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        got = [model.predict(texts.iloc[at : at + 512]) for at in range(0, len(texts), 512)]
        return pd.Series(np.concatenate(got) if got else np.zeros(0))

    return documents.withColumn(out, run(F.col(text)))


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", parts: int = 5, part: int = 0) -> DataFrame:
    """(key, held_out, score, predicted) per document, learnt from rows that aren't held out.

    Defined results: missing and empty texts hold no word and get the score of that, repeated rows
    get equal scores, a missing key isn't held out, missing labels say nothing, labels that
    contradict each other count as toxic. Without positives every score is the prior.
    """
    out = pu.held_out(F.col(key), parts, part)
    model = fit(documents.where(~out), labels.where(~out), label, key, text)
    return (
        scored(documents.select(key, text), model, text)
        .withColumn("held_out", out)
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .select(key, "held_out", "score", "predicted")
    )
