"""Boosted trees on blocks: agreement with pyspark.ml, even shares, draws, bounded sums."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from riskframe.operators import boosting, models
from riskframe.session import materialise

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def matrix(spark):
    """A written matrix of one file and one row group, whatever the cores."""
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        x = [float(rng.randrange(12)) for _ in NAMES]
        y = int(x[0] + x[1] / 2 - x[2] / 3 + rng.gauss(0, 3) > 9)
        rows.append((*x, y))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in NAMES) + ", isFraud int").coalesce(1)
    return materialise(models.BoostedTrees.matrix(df, NAMES), "matrix")


def scores(model, rows) -> np.ndarray:
    return np.array([r["probability"][1] for r in model.transform(rows).select("probability").collect()])


@pytest.mark.parametrize("block", [300, 20_000])
def test_same_trees_as_pyspark_ml(matrix, monkeypatch, block):
    """Over several tasks, and in one."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block)
    mine = models.BoostedTrees(max_iter=6, max_depth=4, row_share=1.0, column_share=1.0).learn(matrix)
    library = GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=6, maxDepth=4, stepSize=0.1).fit(matrix)
    assert np.abs(scores(mine, matrix) - scores(library, matrix)).max() < 1e-12
    assert np.abs(mine.featureImportances.toArray() - library.featureImportances.toArray()).max() < 1e-9


def test_rows_are_dealt_evenly_however_they_lie(spark, matrix, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    found = matrix.groupBy(F.spark_partition_id()).count().collect()
    assert len(found) == 1
    data = boosting.Binned.of(matrix)
    shares = [n for n in data.rdd(boosting.Draw(1.0, [0])).mapPartitions(lambda s: [sum(len(b[2]) for b in s)]).collect()]
    cores = spark.sparkContext.defaultParallelism
    assert sum(shares) == 3000 and len(shares) == min(30, cores) and max(shares) <= 3000 / cores + 200
    monkeypatch.setattr(boosting, "TASK_ROWS", 3000 // (2 * cores))
    assert boosting.Binned.of(matrix).width > cores


@pytest.mark.parametrize("columns", [0.5, 1.0])
def test_draws_and_bounded_sums(matrix, monkeypatch, columns):
    """Nodes one at a time, sums added up in tasks, margins derived anew: the same trees."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 500)
    data = boosting.Binned.of(matrix)
    assert data.width == 6
    want = boosting.boost(data, 4, 3, 0.2, 0.7, columns, 5, 1 << 29)
    again = boosting.boost(data, 4, 3, 0.2, 0.7, columns, 5, 1 << 29)
    assert (scores(want, matrix) == scores(again, matrix)).all()
    monkeypatch.setattr(boosting, "CHAIN", 2)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    few = boosting.boost(data, 4, 3, 0.2, 0.7, columns, 5, 1)
    assert np.abs(scores(want, matrix) - scores(few, matrix)).max() < 1e-9
    other = boosting.boost(data, 4, 3, 0.2, 0.7, columns, 6, 1 << 29)
    assert np.abs(scores(want, matrix) - scores(other, matrix)).max() > 1e-6
    data.width, data.blocks = 1, data.blocks.coalesce(1)
    alone = boosting.boost(data, 4, 3, 0.2, 0.7, columns, 5, 1 << 29)
    assert np.abs(scores(want, matrix) - scores(alone, matrix)).max() < 1e-9
    drawn = data.rdd(boosting.Draw(0.7, [5, 0])).map(lambda s: (len(s[5]), int(s[5].sum()))).collect()
    assert abs(sum(n for _, n in drawn) / sum(n for n, _ in drawn) - 0.7) < 0.05


def test_cuts_lie_between_values():
    few = boosting.place_cuts(np.array([3.0, 1.0, 1.0, np.nan, 2.0]))
    assert few.tolist() == [1.5, 2.5]
    many = boosting.place_cuts(np.arange(10_000.0))
    assert len(many) == boosting.BINS - 1 and abs(np.diff(many) - 10_000 / boosting.BINS).max() <= 1
    hot = boosting.place_cuts(np.concatenate([np.zeros(9_000), np.arange(1_000.0)]))
    assert hot[0] == 0.5
    bins = boosting.bin_rows(np.array([[1.0], [1.5], [1.6], [np.nan], [9.0]]), [few])
    assert bins.tolist() == [[0, 0, 1, 2, 2]]


@pytest.mark.parametrize("label", [None, 2.0, float("nan")])
def test_labels_are_zero_or_one(spark, label):
    rows = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (3.0, label)], "a double, isFraud double")
    with pytest.raises(Exception):
        models.BoostedTrees(max_iter=1).fit(rows, ["a"])


def test_missing_values_go_right(spark):
    rows = spark.createDataFrame([(float(i), i % 2) for i in range(20)] + [(None, 1)] * 9, "a double, isFraud int")
    model = models.BoostedTrees(max_iter=3).fit(rows, ["a"])
    found = {r["a"]: r[models.PROBABILITY] for r in model.score(rows).collect()}
    assert found[None] > 0.5 and found[None] >= found[19.0]


def test_rows_of_one_kind(spark):
    rows = spark.range(50).select(F.lit(1.0).alias("a"), F.lit(0).alias("isFraud"))
    model = models.BoostedTrees(max_iter=3).fit(rows, ["a"])
    assert model.score(rows).agg(F.max(models.PROBABILITY)).first()[0] < 0.5
    with pytest.raises(ValueError):
        models.BoostedTrees(max_iter=1).fit(rows.where("a > 1"), ["a"])
