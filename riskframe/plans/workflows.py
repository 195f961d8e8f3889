"""End-to-end jobs: load, validate, split, fit, score, evaluate, save."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.expressions import binarise
from riskframe.operators import metrics, models
from riskframe.operators.drift import DriftDetector
from riskframe.operators.features import DROPPED, FeatureEngineer
from riskframe.operators.splits import temporal_train_test_split
from riskframe.session import balanced, materialise
from riskframe.sources.transactions import TransactionLoader, warn_of

KEY, LABEL = "TransactionID", "isFraud"
ADVANCED = ("gnn", "transformer", "hybrid")


def load_checked(
    spark: SparkSession, data_dir: str, sample_frac: float | None = None, fmt: str = "csv"
) -> DataFrame:
    """The loaded table, written once in columns; a warning for every quality check that fails."""
    loader = TransactionLoader(spark, data_dir, fmt)
    df = materialise(loader.load(sample_frac=sample_frac), "transactions")
    warn_of(loader.validate(df))
    return df


def with_label(df: DataFrame) -> DataFrame:
    """The frame with a label column, zero where the table has none."""
    return df if LABEL in df.columns else df.withColumn(LABEL, F.lit(0))


def _prepared(engineer: FeatureEngineer, df: DataFrame) -> DataFrame:
    """Numeric features beside id and label, written once; the manifest is enforced."""
    ready = engineer.prepare_for_model(engineer.transform(df), keep=(KEY, LABEL))
    engineer.check_features(ready.columns)
    return balanced(materialise(ready, "prepared"))


def _basic(scored: DataFrame, score: str = models.PROBABILITY) -> dict:
    flagged = scored.withColumn("_flag", binarise(F.col(score)))
    row = metrics.performance_metrics(flagged, LABEL, "_flag").first()
    return {
        "auc": metrics.roc_auc(scored, LABEL, score).first()["auroc"],
        "precision": row["precision"],
        "recall": row["recall"],
        "f1": row["f1_score"],
    }


def train_model(
    df: DataFrame, out_dir: str | None = None, boosted: models.BoostedTrees | None = None
) -> dict:
    """Boosted trees on the earlier rows, judged on the later ones; returns the metrics.

    With ``out_dir`` the model, the feature state and the feature manifest are stored there.
    """
    spark = df.sparkSession
    train, test = temporal_train_test_split(df, test_size=0.2)
    engineer = FeatureEngineer().fit(train)
    features = engineer.state.features
    model = (boosted or models.BoostedTrees()).fit(_prepared(engineer, train), features)
    scored = materialise(
        model.score(_prepared(engineer, test)).select(KEY, LABEL, models.PROBABILITY), "scored"
    )
    if out_dir is not None:
        model.save(f"{out_dir}/fraud_model", spark)
        engineer.save(f"{out_dir}/feature_engineer", spark)
    return _basic(scored)


def train_ensemble(
    df: DataFrame, out_dir: str | None = None, boosted: models.BoostedTrees | None = None
) -> dict:
    """Forest and boosted trees; metrics of the probability and of the combined flag."""
    spark = df.sparkSession
    train, test = temporal_train_test_split(df, test_size=0.2)
    engineer = FeatureEngineer().fit(train)
    ready = _prepared(engineer, train)
    rate = ready.agg(F.avg(LABEL).alias("r")).first()["r"]
    detector = models.EnsembleDetector(rate or 0.035, boosted).fit(ready, engineer.state.features)
    scored = materialise(
        detector.predict(_prepared(engineer, test)).select(
            KEY, LABEL, models.PROBABILITY, "prediction"
        ),
        "scored",
    )
    if out_dir is not None:
        detector.save(f"{out_dir}/ensemble", spark)
        engineer.save(f"{out_dir}/feature_engineer", spark)
    flags = metrics.performance_metrics(scored, LABEL, "prediction").first().asDict()
    return _basic(scored) | {f"flag_{k}": v for k, v in flags.items()}


def evaluate_model(
    df: DataFrame,
    model: models.BoostedModel | models.EnsembleDetector,
    engineer: FeatureEngineer,
    advanced: bool = True,
    exclude_from_drift: tuple[str, ...] = DROPPED,
) -> dict:
    """Scores the later rows and compares their features with those of the earlier rows.

    Id, time and label drift by construction under a split by time, so they are left out
    unless ``exclude_from_drift`` says otherwise.
    """
    train, test = temporal_train_test_split(df, test_size=0.2)
    scored = materialise(
        model.score(_prepared(engineer, test)).select(KEY, LABEL, models.PROBABILITY), "scored"
    )
    if advanced:
        rows = metrics.comprehensive_evaluation(scored, score=models.PROBABILITY)
        out = {r["metric"]: r["value"] for r in rows.collect()}  # one row per metric
    else:
        cm = metrics.confusion_matrix(
            scored.withColumn("_flag", binarise(F.col(models.PROBABILITY))), LABEL, "_flag"
        )
        out = _basic(scored) | cm.first().asDict()
    detector = DriftDetector(engineer.transform(train), 0.3, exclude_from_drift)
    drift = detector.check_drift(engineer.transform(test)).first()
    return out | {"drift_detected": drift["drift_detected"], "drift_share": drift["drift_share"]}


def train_advanced(
    df: DataFrame, model_type: str = "hybrid", boosted: models.BoostedTrees | None = None
) -> dict:
    """Graph, sequence or hybrid detector, judged on the latest rows."""
    if model_type not in ADVANCED:
        raise ValueError(f"Unknown model type: {model_type}")
    df = with_label(df)
    graph = models.GraphDetector(boosted=boosted)
    sequence = models.SequenceDetector(boosted=boosted)
    if model_type == "hybrid":
        train, validation, test = temporal_train_test_split(df, validation_size=0.2)
        detector = models.HybridDetector(graph, sequence).fit(train, validation)
        scored = detector.predict_proba(test, train.unionByName(validation))
    else:
        train, test = temporal_train_test_split(df, test_size=0.2)
        if model_type == "gnn":
            scored = graph.fit(train).predict_proba(test)
        else:
            scored = sequence.fit(train).predict_proba(test, train)
    kept = materialise(scored.select(KEY, LABEL, models.PROBABILITY), "scored")
    rows = metrics.comprehensive_evaluation(kept, score=models.PROBABILITY)
    return {r["metric"]: r["value"] for r in rows.collect()}  # one row per metric
