"""Positive-unlabelled classifiers: held-out accuracy, the risk estimator, odd rows."""

import random
import zlib

import numpy as np
import pytest

from riskframe.llm import pu, quality, toxicity


def sampled(rng, n, share):
    y = rng.random(n) < share
    return rng.normal(0, 1, (n, 3)) + 2.0 * y[:, None], y


@pytest.mark.parametrize("hidden", [0, 8])
@pytest.mark.parametrize("prior", [0.15, 0.7])
def test_risk_recovers_the_boundary(hidden, prior):
    rng = np.random.default_rng(1)
    positive = rng.normal(0, 1, (2000, 3)) + 2.0
    unlabelled, _ = sampled(rng, 6000, prior)
    model = pu.NonNegativePU(hidden=hidden, epochs=60).fit(positive, unlabelled, prior)
    x, y = sampled(rng, 4000, prior)
    assert ((model.predict(x) >= 0.5) == y).mean() > 0.93


def test_fit_is_repeatable():
    rng = np.random.default_rng(2)
    p, u = rng.normal(1, 1, (300, 2)), rng.normal(0, 1, (900, 2))
    a, b = (pu.NonNegativePU(hidden=4, epochs=5).fit(p, u, 0.3).predict(u) for _ in range(2))
    assert (a == b).all()


def documents(n=900, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeilnorst") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(15, 200))]
        good, toxic = rng.random() < 0.8, rng.random() < 0.15
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["vilko", "grumf", "snarg"]) + rng.choice(["", "a", "eth"]))
        if not good:
            text = [w.upper() + "###" for w in text] if i % 2 else [text[0]] * len(text)
        rows.append((i, " ".join(text).capitalize() + "."))
        if i % 2:
            labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.mark.parametrize("module,column,parts,part", [(quality, 1, 3, 1), (toxicity, 2, 5, 0)])
def test_held_out_accuracy_and_contract(spark, module, column, parts, part):
    rows, labels = documents()
    d = spark.createDataFrame([(*r, "en", 7) for r in rows], "doc_id long, text string, score string, held_out int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = module.classify(d, lab).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[column] for r in labels}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    judged = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in judged]) > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_held_out_labels_are_not_read(spark, module):
    rows, labels = documents(300)
    parts, part = (3, 1) if module is quality else (5, 0)
    flipped = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % parts == part else (i, q, t) for i, q, t in labels]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (
        sorted((r.doc_id, r.score) for r in module.classify(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
        for x in (labels, flipped)
    )
    assert a == b


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, module):
    rows, labels = documents(200)
    odd = [(None, "text"), (-1, None), (-2, ""), (-3, "w " * 60_000), (-3, "w " * 60_000), (-4, " \n ")]
    d = spark.createDataFrame(rows + odd, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (5, 0, 0), (7, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = module.classify(d, lab).collect()
    assert len(got) == len(rows) + len(odd) and all(r.score is not None and r.held_out is not None for r in got)
    same = [r.score for r in got if r.doc_id == -3]
    assert len(same) == 2 and same[0] == same[1]
    assert module.classify(d.limit(0), lab).count() == 0
    none = module.classify(d, lab.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_keep_good_keeps_columns(spark):
    rows, labels = documents(300)
    d = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, _score double")
    kept = quality.keep_good(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == d.columns and 0 < kept.count() < 300


def test_words_and_beginnings():
    assert toxicity.features_of({"abcdef", "abc"}) == {"abcdef", "abc", "abcd-", "abcde-"}
    assert toxicity.words_of("Ab1cd É_é " + "x" * 90) == {"ab", "cd", "é", "x" * 40}
