"""Fitted detectors, workflows, JSON scoring, streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import forest, metrics, models
from riskframe.operators.features import FeatureEngineer
from riskframe.plans import workflows
from riskframe.sources import views
from riskframe.streaming import scoring

TINY = models.BoostedTrees(max_iter=2, max_depth=3)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in range(6)]
        y = int(x[0] + 0.3 * rng.gauss(0, 1) > 1)
        rows.append((i, *x, y))
    names = [f"feature_{i}" for i in range(6)]
    df = spark.createDataFrame(
        rows, "TransactionID bigint, " + ", ".join(f"{n} double" for n in names) + ", isFraud int"
    )
    return df.where("TransactionID < 300").cache(), df.where("TransactionID >= 300").cache(), names


def test_boosted_trees_rank_well_and_reload(spark, matrix, tmp_path):
    train, test, names = matrix
    model = TINY.fit(train, names)
    scored = model.score(test)
    assert scored.columns == [*test.columns, "fraud_probability"]
    assert metrics.roc_auc(scored, score="fraud_probability").first()[0] > 0.8
    top = model.feature_importance(spark, 5).collect()
    assert len(top) == 5 and top[0].feature == "feature_0"
    model.save(str(tmp_path / "m"), spark)
    again = models.BoostedModel.load(str(tmp_path / "m"), spark)
    both = again.score(model.score(test, "a"), "b")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-5).count() == 0
    summary = spark.read.parquet(str(tmp_path / "m" / "summary")).first()
    assert summary.num_features == 6 and summary.model_version and summary.model_type
    with pytest.raises(ValueError):
        model.score(test.drop("feature_3"))


def test_forest_flags_outliers(spark, matrix, tmp_path):
    train, _, names = matrix
    model = forest.IsolationForest(contamination=0.05, trees=50).fit(train, names)
    flagged = model.flag(train)
    rate = flagged.agg(F.avg("if_flag")).first()[0]
    assert abs(rate - 0.05) < 0.02
    far = spark.createDataFrame([(1, *[6.0] * 6, 1)], train.schema)
    assert model.flag(far).first().if_flag == 1
    model.save(str(tmp_path / "f"), spark)
    again = forest.IsolationForestModel.load(str(tmp_path / "f"), spark)
    joined = again.flag(flagged, "again", "flag_again")
    assert joined.where("abs(again - anomaly_score) > 1e-12 or flag_again <> if_flag").count() == 0
    sizes = model.nodes.groupBy("tree").count().collect()
    assert len(sizes) == 50 and all(r["count"] <= 2 * 256 for r in sizes)


def test_forest_on_constant_and_copied_rows(spark):
    df = spark.range(600).select(
        F.lit(1.0).alias("a"), F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id") * 1.0).alias("b")
    )
    model = forest.IsolationForest(0.1, trees=10, sample_rows=32).fit(df, ["a", "b"])
    assert model.flag(df).where("anomaly_score is null").count() == 0
    with pytest.raises(ValueError):
        forest.IsolationForest(0.1).fit(df.where("a > 5"), ["a"])


def test_ensemble_is_the_or_of_both(spark, matrix, tmp_path):
    train, test, names = matrix
    detector = models.EnsembleDetector(0.05, TINY)
    with pytest.raises(ValueError):
        detector.predict(test)
    with pytest.raises(ValueError):
        detector.predict_proba(test)
    rows = detector.fit(train, names).predict(test)
    assert rows.count() == 100
    assert rows.where("prediction <> greatest(if_flag, boosted_flag)").count() == 0
    detector.save(str(tmp_path / "e"), spark)
    again = models.EnsembleDetector.load(str(tmp_path / "e"), spark)
    assert again.predict(test).select("prediction").collect() == rows.select("prediction").collect()


def test_explanations_move_no_rows_between_tasks(spark, matrix, monkeypatch):
    """Equal to a rescoring per feature; neither the written rows nor the result pass an exchange."""
    train, test, names = matrix
    detector = models.EnhancedDetector(boosted=TINY)
    detector.train(train, names)
    plans, real = [], models.materialise
    monkeypatch.setattr(models, "materialise", lambda df, name: plans.append(df) or real(df, name))
    explained = detector.predict_with_explanation(test, len(names))
    plain = detector.score(test)._jdf.queryExecution().executedPlan().toString().count("Exchange")
    for df in (*plans, explained):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") <= plain
    found = {r["TransactionID"]: r for r in explained.collect()}
    assert len(found) == test.count()
    for name in names:
        again = detector.score(test.withColumn(name, F.lit(float(detector.medians[name]))))
        for r in again.select("TransactionID", models.PROBABILITY).collect():
            row = found[r[0]]
            assert {e.feature: e.delta for e in row.explanation}[name] == row[models.PROBABILITY] - r[1]


def test_enhanced_detector(spark, matrix, tmp_path):
    train, test, names = matrix
    detector = models.EnhancedDetector(boosted=TINY)
    assert detector.fraud_threshold == 0.2
    assert 0 <= detector.train(train, names)["train_accuracy"] <= 1
    row = detector.predict_with_explanation(test, 3).first()
    assert isinstance(row.is_fraud, bool) and row.model_type == "xgboost"
    assert len(row.explanation) == 3
    sizes = [abs(e.delta) for e in row.explanation]
    assert sizes == sorted(sizes, reverse=True)
    given = test.where(F.col("TransactionID") == row.TransactionID).first()
    assert [row[n] for n in names] == [given[n] for n in names]
    assert detector.get_feature_importance(spark, 5).count() == 5
    detector.save(str(tmp_path / "d"), spark)
    again = models.EnhancedDetector.load(str(tmp_path / "d"), spark)
    assert again.predict_with_explanation(test, 3).where(F.col("TransactionID") == row.TransactionID).first() == row
    assert "train_accuracy" in models.EnhancedDetector("ensemble", explain=False, boosted=TINY).train(
        train, names
    )
    with pytest.raises(ValueError):
        models.EnhancedDetector("other").train(train, names)


def test_workflows(spark, sf_dir, tmp_path):
    df = views.transactions(spark, sf_dir)
    out = str(tmp_path / "models")
    found = workflows.train_model(df, out, TINY)
    assert set(found) == {"auc", "precision", "recall", "f1"} and 0 <= found["auc"] <= 1
    model = models.BoostedModel.load(f"{out}/fraud_model", spark)
    engineer = FeatureEngineer.load(f"{out}/feature_engineer", spark)
    report = workflows.evaluate_model(df, model, engineer)
    assert report["auroc"] == pytest.approx(found["auc"]) and "precision@10" in report
    assert report["drift_detected"] is False
    basic = workflows.evaluate_model(df, model, engineer, advanced=False, exclude_from_drift=())
    assert basic["tp"] + basic["fn"] + basic["tn"] + basic["fp"] == 200
    ensemble = workflows.train_ensemble(df, out, TINY)
    assert {"auc", "flag_accuracy", "flag_recall"} <= set(ensemble)


def test_advanced_workflows(spark, sf_dir):
    df = views.transactions(spark, sf_dir)
    for kind in workflows.ADVANCED:
        found = workflows.train_advanced(df, kind, TINY)
        assert 0 <= found["auroc"] <= 1 and "recall@500" in found
    with pytest.raises(ValueError):
        workflows.train_advanced(df, "other")
    assert workflows.with_label(df.drop("isFraud")).where("isFraud <> 0").count() == 0


# -- JSON and streams ---------------------------------------------------------------------------


def test_json_bodies(spark):
    one = {"transaction_id": "tx_001", "amount": 100.0, "source": "online", "hour_of_day": 14}
    two = [dict(one, transaction_id="a"), dict(one, transaction_id="b", amount=500)]
    bodies = ["", None, "invalid json", "[]", "[oops", json.dumps({"foo": "bar"}), json.dumps(one), json.dumps(two)]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    valid, errors = scoring.parse_transactions(df)
    rows = scoring.score_transactions(valid, scoring.rule_scorer).collect()
    assert {(r.transaction_id, r.fraud_probability, r.is_fraud) for r in rows} == {
        ("tx_001", 0.5, False),
        ("a", 0.5, False),
        ("b", 500 / 600, True),
    }
    found = {r.body: r.error for r in errors.collect()}
    assert found == {
        "": "empty body",
        None: "empty body",
        "invalid json": "invalid JSON",
        "[]": "empty or invalid batch",
        "[oops": "empty or invalid batch",
        json.dumps({"foo": "bar"}): "amount missing",
    }


def test_stream_restarts_without_repeats(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def write(low, high):
        spark.range(low, high).select(
            F.to_json(
                F.struct(
                    F.col("id").cast("string").alias("transaction_id"),
                    (F.col("id") * 10.0).alias("amount"),
                )
            ).alias("value")
        ).coalesce(1).write.mode("append").text(source)

    def run():
        stream = spark.readStream.schema("body string").text(source).withColumnRenamed("value", "body")
        valid, _ = scoring.parse_transactions(stream)
        return scoring.run_to_parquet(
            scoring.score_transactions(valid, scoring.rule_scorer), sink
        )

    write(0, 50)
    assert run().count() == 50
    write(50, 80)
    rows = run()
    assert rows.count() == 80 and rows.select("transaction_id").distinct().count() == 80


def test_late_rows_are_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    # the watermark of one batch judges the rows two batches later
    for stamps in (["01:10:00", "05:30:00"], ["05:40:00"], ["01:20:00", "05:50:00"], ["09:00:00"]):
        rows = [(f"2024-01-01 {s}", True) for s in stamps]
        spark.createDataFrame(rows, "ts string, is_fraud boolean").select(
            F.col("ts").cast("timestamp").alias("ts"), "is_fraud"
        ).coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema("ts timestamp, is_fraud boolean")
        .option("maxFilesPerTrigger", 1)
        .parquet(source)
    )
    out = scoring.run_to_parquet(scoring.prediction_counts(stream), str(tmp_path / "out"))
    counts = {r.window_start.hour: r.predictions for r in out.collect()}
    assert counts == {1: 1, 5: 3}


def test_forest_splits_neighbouring_and_infinite_values(spark):
    import numpy as np

    from riskframe.operators.forest import IsolationForest

    low = 0.34
    pairs = [(low,), (float(np.nextafter(low, 1)),)] * 40 + [(float("-inf"),), (float("inf"),)]
    df = spark.createDataFrame(pairs, "x double")
    model = IsolationForest(contamination=0.1, trees=20, sample_rows=64).fit(df, ["x"])
    scores = [r[0] for r in df.select(model.score()).collect()]
    assert len(scores) == 82 and all(0 < s <= 1 for s in scores)


def test_forest_draws_alike_at_every_size(spark):
    from riskframe.operators.forest import IsolationForest

    forest = IsolationForest(trees=30, sample_rows=50)
    for n in (10, 200, 40_000):
        vectors = spark.range(n).selectExpr("array(cast(id as double)) AS x")
        rows = min(50, n)
        drawn = forest._draw(vectors, n, rows).groupBy("tree").agg(
            F.count("*").alias("n"), F.countDistinct("x").alias("d")
        ).collect()
        assert len(drawn) == 30 and all(r.n == r.d <= rows for r in drawn)
        assert sum(r.n for r in drawn) >= 0.98 * 30 * rows


def test_json_reasons_and_positions(spark):
    bodies = ['[{"amount": 5}, {"amount": "x"}, {"source": "a"}, {"amount": "NaN"}]', '{"amount": "Infinity"}', '{"amount": "y"}', '{"amount": 2}', "{}"]
    valid, errors = scoring.parse_transactions(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert sorted(r.amount for r in valid.collect()) == [2, 5]
    got = {(r.body[:12], r.position): r.error for r in errors.collect()}
    assert got == {
        (bodies[0][:12], 1): "amount is not a number", (bodies[0][:12], 2): "amount missing",
        (bodies[0][:12], 3): "amount is not finite", (bodies[1][:12], 0): "amount is not finite",
        (bodies[2][:12], 0): "amount is not a number", ("{}", 0): "amount missing",
    }
