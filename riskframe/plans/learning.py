"""Queries: search over folds, the sequence network, whole training jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import models
from riskframe.operators.features import FeatureEngineer
from riskframe.operators.search import FoldSearch
from riskframe.operators.sequence_network import SequenceNetwork
from riskframe.plans import workflows
from riskframe.plans.base import SPLIT, query
from riskframe.plans.data import train_test
from riskframe.plans.detectors import _JUDGED, judged
from riskframe.plans.stored import _SAME, FEW, compared
from riskframe.session import materialise, scratch_path, spread
from riskframe.sources import views

KEY, LABEL, TIME = models.KEY, models.LABEL, "TransactionDT"


@query(
    "tune_folds",
    f"""WITH {SPLIT}, k AS (SELECT count(*) AS n, CAST(trunc(count(*) * 0.3::DOUBLE) AS BIGINT) AS t FROM train),
    f AS (SELECT CAST(i AS INTEGER) AS fold, n - (3 - i - 1) * (t // 3) - t AS train_rows, t AS test_rows
          FROM k, range(3) r(i)),
    r AS (SELECT CAST(rung AS INTEGER) AS rung, CAST(trees AS INTEGER) AS trees, CAST(trials AS BIGINT) AS trials
          FROM (VALUES (0, 3, 4), (1, 10, 2)) v(rung, trees, trials))
    SELECT rung, trees, fold, train_rows, test_rows, trials, trials AS scored, trials // 2 AS kept, true AS best_go_on
    FROM r, f""",
)
def tune_folds(spark, sf):
    """Four draws on three walk-forward folds of one matrix, halved once, per rung and fold."""
    train, _ = train_test(spark, sf)
    engineer = FeatureEngineer().fit(train)
    ready = materialise(engineer.prepare_for_model(engineer.transform(train), keep=(KEY, LABEL, TIME)), "prepared")
    search = FoldSearch(n_trials=4, rungs=(0.3, 1.0), base=FEW)
    _, trials = search.run(ready, engineer.state.features, LABEL, TIME, KEY)
    mean = trials.groupBy("rung", "trial").agg(F.avg("score").alias("mean"), F.first("kept").alias("kept"))
    order = mean.groupBy("rung").agg(
        (F.min(F.when(F.col("kept"), F.col("mean"))) >= F.max(F.when(~F.col("kept"), F.col("mean")))).alias("best_go_on")
    )
    return trials.groupBy("rung", "trees", "fold", "train_rows", "test_rows").agg(
        F.count(F.lit(1)).alias("trials"), F.count_if(F.col("score").between(0.0, 1.0)).alias("scored"), F.count_if("kept").alias("kept")
    ).join(order, "rung")


def _network(spark, sf):
    train, test = train_test(spark, sf)
    return SequenceNetwork().fit(train), train, test


@query("sequence_network_scores", _JUDGED)
def sequence_network_scores(spark, sf):
    """The network on trailing sequences, on the latest slice."""
    model, train, test = _network(spark, sf)
    return judged(model.predict_proba(test, train))


@query("sequence_network_roundtrip", _SAME)
def sequence_network_roundtrip(spark, sf):
    """A stored network that knows each card's latest rows, against one that reads all history."""
    model, train, test = _network(spark, sf)
    path = scratch_path(spark, "sequence-network")
    model.save(path, spark)
    return compared(model.predict_proba(test, train), SequenceNetwork.load(path, spark).predict_later(test))


# -- whole jobs ---------------------------------------------------------------------------------

_JOB = f"""WITH {SPLIT}
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum("isFraud") AS BIGINT) AS frauds,
           CAST(0 AS DOUBLE) AS max_difference FROM test"""


def _judged_again(spark, trained: dict, again: dict):
    """Rows and frauds of the confusion matrix, and how far the metrics of two runs are apart."""
    rows = sum(again[c] for c in ("tn", "fp", "fn", "tp"))
    apart = max(abs((trained[m] or 0.0) - (again[m] or 0.0)) for m in ("auc", "precision", "recall", "f1"))
    found = [(int(rows), int(again["fn"] + again["tp"]), round(float(apart), 9))]
    return spark.createDataFrame(found, "n_rows long, frauds long, max_difference double")


@query("workflow_train_evaluate", _JOB)
def workflow_train_evaluate(spark, sf):
    """Train and store; load model and feature state; evaluate: the metrics of training again."""
    df, out = spread(views.transactions(spark, sf), "transactions"), scratch_path(spark, "trained")
    trained = workflows.train_model(df, out, FEW)
    model = models.BoostedModel.load(f"{out}/fraud_model", spark)
    engineer = FeatureEngineer.load(f"{out}/feature_engineer", spark)
    return _judged_again(spark, trained, workflows.evaluate_model(df, model, engineer, advanced=False))


@query("workflow_ensemble", _JOB)
def workflow_ensemble(spark, sf):
    """Train and store the ensemble; load both parts; evaluate the probability again."""
    df, out = spread(views.transactions(spark, sf), "transactions"), scratch_path(spark, "trained")
    trained = workflows.train_ensemble(df, out, FEW)
    model = models.EnsembleDetector.load(f"{out}/ensemble", spark).boosted_model
    engineer = FeatureEngineer.load(f"{out}/feature_engineer", spark)
    return _judged_again(spark, trained, workflows.evaluate_model(df, model, engineer, advanced=False))

