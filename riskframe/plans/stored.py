"""Queries: detectors, reference profiles and stream states that are stored and read again."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import models, splits, stages
from riskframe.operators.profiles import ReferenceProfile
from riskframe.plans import evaluation, structure  # noqa: F401  their SQL is used here
from riskframe.plans.base import ORACLES, SPLIT, query, rounded
from riskframe.plans.data import train_test
from riskframe.session import scratch_path
from riskframe.sources import views
from riskframe.streaming.trailing import TrailingState

KEY, LABEL, P = models.KEY, models.LABEL, models.PROBABILITY
#: Small trees: these queries compare a model with its stored copy.
FEW = models.BoostedTrees(max_iter=10, max_depth=4)
FEW_PARAMS = {"maxIter": 10, "maxDepth": 4}

_SAME = f"""WITH {SPLIT}
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS max_difference,
           CAST(0 AS BIGINT) AS other_flags FROM test"""


def compared(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that both scored, the largest difference of scores, and how many flags differ."""
    flag = F.col("prediction") if "prediction" in before.columns else (F.col(P) > 0.5).cast("int")
    left = before.select(KEY, F.col(P).alias("p"), flag.alias("f"))
    right = after.select(KEY, F.col(P).alias("q"), flag.alias("g"))
    return left.join(right, KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.max(F.abs(F.col("p") - F.col("q"))), 9).alias("max_difference"),
        F.count_if(F.col("f") != F.col("g")).alias("other_flags"),
    )


def stored(spark, model: PipelineModel) -> PipelineModel:
    path = scratch_path(spark, "pipeline-model")
    model.save(path)
    return PipelineModel.load(path)


@query("ml_pipeline_ensemble", _SAME)
def ml_pipeline_ensemble(spark, sf):
    """Features, trees, forest and flag in one Pipeline: the stored model scores as the fitted one."""
    train, test = train_test(spark, sf)
    pipeline = Pipeline(stages=[stages.Features(), stages.Boosted(**FEW_PARAMS), stages.Forest(trees=50), stages.Flag(threshold=0.5)])
    model = pipeline.fit(train)
    return compared(model.transform(test), stored(spark, model).transform(test))


@query(
    "ml_pipeline_flags",
    f"""WITH {SPLIT} SELECT "TransactionID", "isFraud", CAST(0 AS INTEGER) AS off FROM test""",
)
def ml_pipeline_flags(spark, sf):
    """Per row, how far the flag of a stored pipeline is from the OR of its parts."""
    train, test = train_test(spark, sf)
    pipeline = Pipeline(stages=[stages.Features(), stages.Boosted(**FEW_PARAMS), stages.Forest(trees=50), stages.Flag(threshold=0.2)])
    scored = stored(spark, pipeline.fit(train)).transform(test)
    parts = F.greatest("if_flag", (F.col(P) > 0.2).cast("int"))
    return scored.select(KEY, LABEL, F.abs(F.col("prediction") - parts).alias("off"))


@query("graph_roundtrip", _SAME)
def graph_roundtrip(spark, sf):
    """A graph detector and its stored version: node tables of all hops, trees."""
    train, test = train_test(spark, sf)
    model = Pipeline(stages=[stages.Graph(**FEW_PARAMS), stages.Flag()]).fit(train)
    return compared(model.transform(test), stored(spark, model).transform(test))


@query("sequence_roundtrip", _SAME)
def sequence_roundtrip(spark, sf):
    """A stored sequence detector that knows each card's latest rows, against one that reads all history."""
    train, test = train_test(spark, sf)
    detector = models.SequenceDetector(boosted=FEW).fit(train)
    path = scratch_path(spark, "sequence-model")
    detector.save(path, spark)
    again = models.SequenceDetector.load(path, spark)
    return compared(detector.predict_proba(test, train), again.predict_later(test))


@query("hybrid_roundtrip", _SAME)
def hybrid_roundtrip(spark, sf):
    """A stored hybrid detector: both base detectors and the fusion."""
    train, validation, test = splits.temporal_train_test_split(views.transactions(spark, sf), validation_size=0.2)
    detector = models.HybridDetector(models.GraphDetector(boosted=FEW), models.SequenceDetector(boosted=FEW))
    detector.fit(train, validation)
    history = train.unionByName(validation)
    detector.sequence.keep_recent(history)
    path = scratch_path(spark, "hybrid-model")
    detector.save(path, spark)
    again = models.HybridDetector.load(path, spark)
    return compared(detector.predict_proba(test, history), again.predict_later(test))


# -- reference profile --------------------------------------------------------------------------


def stored_profile(spark, sf) -> ReferenceProfile:
    """The profile of the training slice, written and loaded."""
    train, _ = train_test(spark, sf)
    path = scratch_path(spark, "profile")
    ReferenceProfile.build(evaluation._hours(train, early=True), evaluation._KS_FEATURES).save(path, spark)
    return ReferenceProfile.load(path, spark)


@query("drift_ks_stored", ORACLES["drift_ks"])
def drift_ks_stored(spark, sf):
    """KS of the latest slice against a stored profile: the reference is not read again."""
    out = stored_profile(spark, sf).ks(evaluation._hours(train_test(spark, sf)[1]))
    return rounded(rounded(out, "statistic"), "p_value", places=4)


@query("drift_psi_stored", ORACLES["drift_psi"])
def drift_psi_stored(spark, sf):
    """PSI of the latest slice against a stored profile."""
    return rounded(stored_profile(spark, sf).psi(evaluation._hours(train_test(spark, sf)[1])), "psi")


# -- stream state -------------------------------------------------------------------------------

SLICES = 4


@query("stream_sequence_features", ORACLES["sequence_features"])
def stream_sequence_features(spark, sf):
    """Trailing features of all transactions, arriving in four batches: the rows of one batch job."""
    rows = views.transactions(spark, sf)
    first, last = rows.agg(F.min("TransactionDT"), F.max("TransactionDT")).first()
    part = F.floor((F.col("TransactionDT") - (first or 0)) * SLICES / max(1, (last or 0) - (first or 0) + 1))
    source = scratch_path(spark, "arriving")
    state = TrailingState(spark, scratch_path(spark, "trailing"))
    for i in range(SLICES):  # the query stops after each batch and goes on from its checkpoint
        rows.where(part == i).write.mode("append").parquet(source)
        found = state.run(spark.readStream.schema(rows.schema).parquet(source))
    out = found.select("TransactionID", "seq_len", "seq_mean", "seq_std", "seq_min", "seq_max", "seq_gap")
    return rounded(rounded(out, "seq_mean"), "seq_std", places=4)
