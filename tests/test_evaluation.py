"""Metrics and drift on hand examples and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators import drift, metrics, ordering

# fixed values of a hand example
LABELS = [0, 0, 1, 1, 1, 0, 1, 0, 1, 1]
SCORES = [0.1, 0.2, 0.9, 0.8, 0.7, 0.3, 0.85, 0.15, 0.95, 0.75]


@pytest.fixture
def scored(spark):
    rows = list(zip(range(10), LABELS, SCORES))
    return spark.createDataFrame(rows, "TransactionID bigint, isFraud int, score double")


def test_top_k(scored):
    got = {r.k: r for r in metrics.precision_recall_at_k(scored, (5, 100)).collect()}
    assert got[5].precision_at_k == 1.0 and got[5].recall_at_k == pytest.approx(5 / 6)
    assert got[100].precision_at_k == pytest.approx(0.6) and got[100].recall_at_k == 1.0


def test_every_k_by_one_rule(spark, scored):
    got = {r.k: r.precision_at_k for r in metrics.precision_recall_at_k(scored, (2, 7, 99)).collect()}
    assert got == {2: 1.0, 7: pytest.approx(6 / 7), 99: pytest.approx(0.6)}


def test_missing_and_nan_scores_rank_last_at_every_k(spark):
    nan = float("nan")
    rows = [(i, 0, 0.5) for i in range(1000)] + [(None, 1, 0.5)] * 3
    rows += [(2000 + i, 1, nan if i % 2 else None) for i in range(400)] + [(-1, 1, 0.9)]
    df = spark.createDataFrame(rows, "TransactionID bigint, isFraud int, score double")
    got = {r.k: r for r in metrics.precision_recall_at_k(df, (1, 1000, 1001, 1002, 1004, 1005)).collect()}
    hits = {k: round(r.precision_at_k * k) for k, r in got.items()}
    assert hits == {1: 1, 1000: 1, 1001: 1, 1002: 2, 1004: 4, 1005: 5}
    assert got[1005].recall_at_k == pytest.approx(5 / 404)
    assert metrics.roc_auc(df).first()[0] == metrics.roc_auc(df.where("score < 2")).first()[0]
    flags = df.select(X.binarise(F.col("score"), 0.1).alias("f"), "score").where("isnan(score)")
    assert flags.agg(F.max("f")).first()[0] == 0


def test_cost(spark):
    df = spark.createDataFrame(list(zip([0, 0, 1, 1, 1], [0, 0, 0, 1, 1])), "isFraud int, prediction int")
    assert metrics.cost_sensitive_score(df).first()[0] == 10.0


def test_areas(spark, scored):
    perfect = spark.createDataFrame(
        list(zip([0, 0, 1, 1, 1], [0.1, 0.2, 0.7, 0.8, 0.9])), "isFraud int, score double"
    )
    assert metrics.auprc(perfect).first()[0] == 1.0 and metrics.roc_auc(perfect).first()[0] == 1.0
    flat = spark.createDataFrame([(0, 0.5), (1, 0.5)], "isFraud int, score double")
    assert metrics.roc_auc(flat).first()[0] == 0.5
    one_class = flat.where("isFraud = 0")
    assert metrics.roc_auc(one_class).first()[0] is None
    names = {r.metric for r in metrics.comprehensive_evaluation(scored, (5, 10)).collect()}
    assert names == {
        "auroc", "auprc", "precision", "recall", "f1", "cost_sensitive_score",
        "precision@5", "recall@5", "precision@10", "recall@10",
    }


def test_areas_with_a_hot_score(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SINGLE_BUCKET_ROWS", 10)
    rng = random.Random(8)
    rows = []
    for _ in range(1500):
        y = int(rng.random() < 0.1)
        rows.append((y, 0.0 if rng.random() < 0.35 else rng.random() + 0.2 * y))
    df = spark.createDataFrame(rows, "isFraud int, score double")
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(wins / len(pos) / len(neg))
    area, seen, hits = 0.0, 0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        at = [y for y, v in rows if v == s]
        seen, hits = seen + len(at), hits + sum(at)
        area += sum(at) / len(pos) * hits / seen
    assert metrics.auprc(df).first()[0] == pytest.approx(area)


def test_absent_class_counts_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "isFraud int, prediction int")
    assert tuple(metrics.confusion_matrix(df).first()) == (2, 0, 0, 0)
    row = metrics.performance_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (1.0, 0.0, 0.0, 0.0)


# -- drift --------------------------------------------------------------------------------------


def normal(spark, n, mean=0.0, seed=1, columns=2):
    rng = random.Random(seed)
    rows = [[rng.gauss(mean, 1) for _ in range(columns)] for _ in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"feature_{i} double" for i in range(columns)))


def test_psi(spark):
    ref = normal(spark, 1000)
    same = {r.feature: r.psi for r in drift.psi_drift(ref, normal(spark, 1000, seed=2)).collect()}
    moved = {r.feature: r.psi for r in drift.psi_drift(ref, normal(spark, 1000, 2.0, 3)).collect()}
    assert len(same) == 2 and all(v < 0.1 for v in same.values())
    assert all(v > 0.1 for v in moved.values())


def test_ks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SINGLE_BUCKET_ROWS", 10)
    a, b = normal(spark, 400, columns=1), normal(spark, 300, 0.3, 9, 1)
    # a value that fills a third of one side
    b = b.withColumn("feature_0", F.when(F.col("feature_0") > 0.5, 0.5).otherwise(F.col("feature_0")))
    xs = [r[0] for r in a.collect()]
    ys = [r[0] for r in b.collect()]
    want = max(
        abs(sum(x <= v for x in xs) / len(xs) - sum(y <= v for y in ys) / len(ys)) for v in xs + ys
    )
    row = drift.ks_drift(a, b).first()
    assert row.statistic == pytest.approx(want) and row.drifted == 1
    assert drift.ks_drift(a, a).first().p_value == 1.0


def test_mean_shift_edge_cases(spark):
    ref = spark.createDataFrame(
        [(1.0, 5.0, 1.0, None, "s"), (3.0, 5.0, 2.0, None, "s")],
        "a double, constant double, b double, empty double, text string",
    )
    cur = spark.createDataFrame([(50.0, 7.0, None)], "a double, constant double, b double")
    found = drift.DriftDetector(ref, drift_threshold=0.2).check_drift(cur).first()
    # four numeric features count, one drifted, two have no score
    assert found.drift_share == 0.25 and found.drift_detected
    assert found.drifted_features == ["a"] and set(found.drift_scores) == {"a"}
    assert not drift.DriftDetector(ref, 0.25).check_drift(cur).first().drift_detected


def test_numeric_profile_skips_nan_and_text(spark):
    df = spark.createDataFrame(
        [(1.0, True, "x"), (float("nan"), False, "y"), (2.0, True, "z"), (10.0, True, None)],
        "v double, flag boolean, t string",
    )
    (row,) = drift.numeric_profile(df).collect()
    assert (row.feature, row.min, row.max, row.median) == ("v", 1.0, 10.0, 2.0)
    assert row["mean"] == pytest.approx(13 / 3)


def test_wide_profile(spark):
    df = spark.range(50).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(70)])
    rows = {r.feature: r.median for r in drift.numeric_profile(df).collect()}
    assert len(rows) == 70 and rows["c3"] == 24.5 * 3


def test_monitor(spark, tmp_path):
    monitor = drift.ModelMonitor("m")
    with pytest.raises(ValueError):
        monitor.detect_data_drift(normal(spark, 10))
    labels = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "label int, prediction int")
    monitor.set_reference_data(None, labels)
    assert monitor.reference_data is None and "accuracy" in monitor.reference_metrics
    monitor.set_reference_data(normal(spark, 100), labels)
    for method in ("ks", "psi"):
        rows = monitor.detect_data_drift(normal(spark, 50, seed=4), method).collect()
        assert len(rows) == 2 and {r.method for r in rows} == {method}
    report = monitor.generate_report(normal(spark, 50, seed=4), labels).first()
    assert report.model_name == "m" and len(report.feature_stats) == 2
    assert report.performance.false_positive_rate == 0.5 and report.timestamp is not None
    for _ in range(2):
        monitor.save_report(monitor.generate_report(normal(spark, 50, seed=4), labels), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2
