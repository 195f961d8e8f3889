"""Stored detectors: versions, half-written models, pyspark.ml stages."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskframe.operators import models, sequences, splits, stages
from riskframe.operators.store import ModelStore
from riskframe.sources import views

TINY = {"maxIter": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def slices(spark, sf_dir):
    return splits.temporal_train_test_split(views.transactions(spark, sf_dir), test_size=0.2)


def test_half_written_versions_are_never_read(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="nothing finished"):
        store.latest("graph")
    first = store.begin()
    spark.range(3).write.parquet(f"{first}/nodes")
    with pytest.raises(ValueError, match="nothing finished"):
        store.latest("graph")
    store.commit(first, "graph", {"hops": 2})
    second = store.begin()
    spark.range(5).write.parquet(f"{second}/nodes")  # the writer dies here
    assert store.latest("graph") == (first, {"hops": 2})
    with pytest.raises(ValueError, match="not a hybrid"):
        store.latest("hybrid")
    third = store.begin()
    store.commit(third, "graph", {"hops": 1})
    assert store.latest("graph") == (third, {"hops": 1})


def test_unfitted_detectors_cannot_be_saved(spark, tmp_path):
    for detector in (models.GraphDetector(), models.SequenceDetector(), models.HybridDetector(models.GraphDetector(), models.SequenceDetector())):
        with pytest.raises(ValueError, match="not fitted"):
            detector.save(str(tmp_path / "x"), spark)


def test_params_travel_with_the_model(spark, slices, tmp_path):
    train, test = slices
    assert stages.Boosted().value("maxIter") == 100 and not stages.Boosted().isDefined("inputCols")
    pipeline = Pipeline(stages=[stages.Features(keep=["TransactionID", "isFraud"]), stages.Boosted(**TINY, inputCols=["TransactionAmt", "hour"]), stages.Flag(threshold=0.1)])
    pipeline.save(str(tmp_path / "pipeline"))
    pipeline = Pipeline.load(str(tmp_path / "pipeline"))
    assert [s.uid for s in pipeline.getStages()] and pipeline.getStages()[1].value("inputCols") == ["TransactionAmt", "hour"]
    model = pipeline.fit(train)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.stages[1].value("maxIter") == 2 and again.stages[1].learnt.features == ["TransactionAmt", "hour"]
    assert again.stages[2].value("threshold") == 0.1 and [s.uid for s in again.stages] == [s.uid for s in model.stages]
    scored = again.transform(test)
    assert scored.count() == test.count()
    assert scored.where("prediction <> cast(fraud_probability > 0.1 as int)").count() == 0


def test_hybrid_stage_scores_later_rows(spark, slices, tmp_path):
    train, test = slices
    model = Pipeline(stages=[stages.Hybrid(**TINY, fusionShare=0.3), stages.Flag()]).fit(train)
    model.save(str(tmp_path / "h"))
    before, after = (m.transform(test).orderBy("TransactionID").collect() for m in (model, PipelineModel.load(str(tmp_path / "h"))))
    assert before == after and len(after) == test.count()


def test_latest_rows_replace_the_history(spark, slices):
    train, test = slices
    few = sequences.latest_rows(train, 9)
    assert few.groupBy("card1").count().where("count > 9").count() == 0
    windows = [
        sequences.sequence_features(test.withColumn("new", F.lit(True)).unionByName(h.withColumn("new", F.lit(False)))).where("new").orderBy("TransactionID").collect()
        for h in (train, few)
    ]
    assert windows[0] == windows[1]




def test_profile_reads_the_reference_once(spark, slices, tmp_path):
    from riskframe.operators import drift
    from riskframe.operators.profiles import ReferenceProfile

    train, test = (df.select("TransactionAmt", F.col("TransactionDT").cast("double").alias("dt"), F.lit(None).cast("double").alias("none")) for df in slices)
    train.write.parquet(str(tmp_path / "reference"))
    reference = spark.read.parquet(str(tmp_path / "reference"))
    ReferenceProfile.build(reference).save(str(tmp_path / "profile"), spark)
    profile = ReferenceProfile.load(str(tmp_path / "profile"), spark)
    for found, wanted in ((profile.ks(test), drift.ks_drift(reference, test)), (profile.psi(test), drift.psi_drift(reference, test))):
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
        assert not [f for f in found.inputFiles() if "/reference/" in f]
    assert profile.edges["TransactionAmt"] == drift.decile_edges(reference, ["TransactionAmt"])["TransactionAmt"]


def test_profiles_add_up(spark, slices):
    from riskframe.operators import drift
    from riskframe.operators.profiles import ReferenceProfile

    train, test = (df.select("TransactionAmt") for df in slices)
    half = slices[0].where("TransactionID % 2 = 0").select("TransactionAmt")
    rest = slices[0].where("TransactionID % 2 = 1").select("TransactionAmt")
    both = ReferenceProfile.build(half).merged(rest)
    assert both.edges == drift.decile_edges(train, ["TransactionAmt"])
    assert both.ks(test).collect() == drift.ks_drift(train, test).collect()
    empty = ReferenceProfile.build(train.limit(0))
    assert [r.status for r in empty.ks(test).collect()] == ["no reference values"]


def test_repeated_batch_changes_nothing(spark, sf_dir, tmp_path):
    from riskframe.streaming.trailing import TrailingState

    rows = views.transactions(spark, sf_dir).withColumn("card1", F.when(F.col("TransactionID") % 9 > 0, F.col("card1")))
    cuts = rows.approxQuantile("TransactionDT", [0.0, 0.3, 0.31, 0.8, 1.0], 0.0)
    state = TrailingState(spark, str(tmp_path), length=4, buckets=5)
    parts = [rows.where((F.col("TransactionDT") >= lo) & (F.col("TransactionDT") < hi)) for lo, hi in zip(cuts, [*cuts[1:-1], cuts[-1] + 1])]
    seen = lambda: sorted(map(str, state.rows().collect()))
    for i, part in enumerate(parts):
        state.process(part, i)
        before, versions = seen(), state.versions()
        state.process(part, i)  # the driver died before the batch was committed
        assert seen() == before and state.versions() == versions
    assert seen() == sorted(map(str, sequences.sequence_features(rows, 4).collect()))
    assert all(len(v) <= 2 for v in versions.values())
    state.process(rows.limit(0), 9)
    assert seen() == before
