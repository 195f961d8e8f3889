"""The operators as ``pyspark.ml`` stages: Estimators whose Models score, save and load inside a Pipeline.

    Pipeline(stages=[Features(), Boosted(), Forest(), Flag()])      # the ensemble
    Pipeline(stages=[Graph(), Flag()])
    Pipeline(stages=[Hybrid(), Flag(threshold=0.2)])

``Features`` replaces a frame by its model matrix beside id and label; all other stages add columns.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expressions import binarise, either
from riskframe.operators import forest, models, splits
from riskframe.operators.features import DROPPED, FeatureEngineer

INT, REAL, TEXT, TEXTS = TypeConverters.toInt, TypeConverters.toFloat, TypeConverters.toString, TypeConverters.toListString


class _Writer(MLWriter):
    """Params as JSON, what was learnt as tables below ``data``."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.stage, path, spark)
        self.stage._save_learnt(f"{path}/data", spark)


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._load_learnt(f"{path}/data", spark)
        return stage


class _Stage(Params, MLReadable, MLWritable):
    """Params declared in ``PARAMS``: name -> (default, converter, what it says)."""

    PARAMS: dict = {}

    def __init__(self, **given):
        super().__init__()
        for name, (default, kind, doc) in self.PARAMS.items():
            setattr(self, name, Param(self, name, doc, kind))
            if default is not None:
                self._setDefault(**{name: default})
        self._set(**given)

    def value(self, name: str):
        return self.getOrDefault(name)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _save_learnt(self, path: str, spark) -> None:
        """An estimator or a plain transformer has learnt nothing."""

    def _load_learnt(self, path: str, spark) -> None:
        """See ``_save_learnt``."""


class _Learnt(_Stage, Model):
    """A Model around ``learnt``, an object with save(path, spark) and load(path, spark)."""

    KIND: type

    def __init__(self, learnt=None):
        super().__init__()
        self.learnt = learnt

    def _save_learnt(self, path: str, spark) -> None:
        self.learnt.save(path, spark)

    def _load_learnt(self, path: str, spark) -> None:
        self.learnt = self.KIND.load(path, spark)


class _Learner(_Stage, Estimator):
    MODEL: type

    @keyword_only
    def __init__(self, **given):
        super().__init__(**given)

    def _fit(self, df: DataFrame):
        return self._copyValues(self.MODEL(self.learn(df)))

    def learn(self, df: DataFrame):
        raise NotImplementedError


_LABEL = {"labelCol": (models.LABEL, TEXT, "0/1 column learnt from")}
_KEEP = {"keep": ([models.KEY, models.LABEL], TEXTS, "columns that stay beside the features")}
_TREES = _LABEL | {
    "maxIter": (100, INT, "number of trees"), "maxDepth": (6, INT, "depth of a tree"), "stepSize": (0.1, REAL, "share of each tree"),
    "rowShare": (0.8, REAL, "rows drawn per tree"), "columnShare": (0.8, REAL, "columns drawn per node"), "seed": (42, INT, "of all draws"),
}


def _features(stage: _Stage, df: DataFrame) -> list[str]:
    """``inputCols``, or every column of the matrix that a model may see."""
    if stage.isDefined("inputCols"):
        return stage.value("inputCols")
    return FeatureEngineer._feature_names(df, {*DROPPED, stage.value("labelCol")})


def _trees(stage: _Stage) -> models.BoostedTrees:
    named = ("maxIter", "maxDepth", "stepSize", "rowShare", "columnShare", "seed")
    return models.BoostedTrees(*map(stage.value, named))


class FeaturesModel(_Learnt):
    KIND, PARAMS = FeatureEngineer, _KEEP

    def _transform(self, df: DataFrame) -> DataFrame:
        ready = self.learnt.prepare_for_model(self.learnt.transform(df), keep=tuple(self.value("keep")))
        self.learnt.check_features(ready.columns)
        return ready


class Features(_Learner):
    """Amount and time features, codes of strings, missing values filled: learnt on the frame fitted."""

    MODEL, PARAMS = FeaturesModel, _KEEP

    def learn(self, df: DataFrame) -> FeatureEngineer:
        return FeatureEngineer().fit(df)


class BoostedStage(_Learnt):
    KIND, PARAMS = models.BoostedModel, _TREES

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.learnt.score(df)


class Boosted(_Learner):
    """Boosted trees; the model adds fraud_probability."""

    MODEL, PARAMS = BoostedStage, _TREES | {"inputCols": (None, TEXTS, "features; by default all numbers of the frame")}

    def learn(self, df: DataFrame) -> models.BoostedModel:
        return _trees(self).fit(df, _features(self, df), self.value("labelCol"))


_FOREST = _LABEL | {
    "contamination": (0.035, REAL, "share of the rows learnt from that is flagged"), "trees": (100, INT, "number of trees"),
    "sampleRows": (256, INT, "rows drawn per tree"), "seed": (42, INT, "of all draws"),
}


class ForestStage(_Learnt):
    KIND, PARAMS = forest.IsolationForestModel, _FOREST

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.learnt.flag(df)


class Forest(_Learner):
    """Isolation forest of the legitimate rows; the model adds anomaly_score and if_flag."""

    MODEL, PARAMS = ForestStage, _FOREST | {"inputCols": (None, TEXTS, "features; by default all numbers but scores")}

    def learn(self, df: DataFrame) -> forest.IsolationForestModel:
        features = [c for c in _features(self, df) if c != models.PROBABILITY]
        learner = forest.IsolationForest(*map(self.value, ("contamination", "trees", "sampleRows", "seed")))
        return learner.fit(df.where(F.col(self.value("labelCol")) == 0), features)


class Flag(_Stage, Transformer):
    """Adds ``prediction``: the probability is above the threshold, or the forest flags the row."""

    PARAMS = {"threshold": (0.5, REAL, "probability above which a row is flagged")}

    @keyword_only
    def __init__(self, **given):
        super().__init__(**given)

    def _transform(self, df: DataFrame) -> DataFrame:
        flag = binarise(F.col(models.PROBABILITY), self.value("threshold"))
        return df.withColumn("prediction", either(F.col("if_flag"), flag) if "if_flag" in df.columns else flag)


class _LaterStage(_Learnt):
    """Scores rows later than those learnt from."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.learnt.predict_later(df) if hasattr(self.learnt, "predict_later") else self.learnt.predict_proba(df)


_GRAPH = _TREES | {"hops": (2, INT, "hops of neighbourhood means")}
_SEQUENCE = _TREES | {"maxSeqLen": (10, INT, "rows of a card that a window holds")}
_HYBRID = _GRAPH | _SEQUENCE | {"fusionShare": (0.25, REAL, "latest share of the rows, on which the fusion learns")}


class GraphStage(_LaterStage):
    KIND, PARAMS = models.GraphDetector, _GRAPH


class Graph(_Learner):
    """Trees on neighbourhood features of raw transactions."""

    MODEL, PARAMS = GraphStage, _GRAPH

    def learn(self, df: DataFrame) -> models.GraphDetector:
        return models.GraphDetector(self.value("hops"), _trees(self)).fit(df, self.value("labelCol"))


class SequenceStage(_LaterStage):
    KIND, PARAMS = models.SequenceDetector, _SEQUENCE


class Sequence(_Learner):
    """Trees on trailing windows; the model remembers each card's latest rows."""

    MODEL, PARAMS = SequenceStage, _SEQUENCE

    def learn(self, df: DataFrame) -> models.SequenceDetector:
        return models.SequenceDetector(self.value("maxSeqLen"), _trees(self)).fit(df, self.value("labelCol"))


class HybridStage(_LaterStage):
    KIND, PARAMS = models.HybridDetector, _HYBRID


class Hybrid(_Learner):
    """Graph and sequence scores of an early slice, fused on a later one."""

    MODEL, PARAMS = HybridStage, _HYBRID

    def learn(self, df: DataFrame) -> models.HybridDetector:
        early, late = splits.temporal_train_test_split(df, test_size=self.value("fusionShare"))
        detector = models.HybridDetector(
            models.GraphDetector(self.value("hops"), _trees(self)), models.SequenceDetector(self.value("maxSeqLen"), _trees(self))
        ).fit(early, late, self.value("labelCol"))
        detector.sequence.keep_recent(df)  # the rows to be scored follow the later slice
        return detector
