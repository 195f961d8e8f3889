"""Detectors: boosted trees, the forest-plus-trees ensemble, graph, sequence and hybrid scores.

Every detector learns from a DataFrame and scores a DataFrame by adding ``fraud_probability``.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.expressions import binarise, either
from riskframe.operators import graph, metrics, sequences
from riskframe.operators.boosting import Binned, TreesModel, boost
from riskframe.operators.features import MISSING
from riskframe.operators.forest import IsolationForest, IsolationForestModel
from riskframe.operators.ordering import exact_quantiles
from riskframe.operators.store import ModelStore
from riskframe.session import materialise

PROBABILITY = "fraud_probability"
LABEL, KEY = "isFraud", "TransactionID"
MODEL_VERSION = "1.0"


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")


@dataclass
class BoostedTrees:
    """Gradient-boosted trees (``boosting``); row and column sampling as fractions."""

    max_iter: int = 100
    max_depth: int = 6
    step_size: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    max_memory_mb: int = 512

    @staticmethod
    def matrix(df: DataFrame, features: Sequence[str], label: str = LABEL, keep: Sequence[str] = ()) -> DataFrame:
        """(``_features``, ``_label``, ``keep``): what learning reads, ready to be written."""
        rows = df.select(
            *[F.col(f"`{c}`") for c in features], F.col(label).cast("double").alias("_label"),
            *[F.col(c) for c in keep if c not in features],
        )
        return _assembler(features).transform(rows).select("_features", "_label", *keep)

    def learn(self, rows: DataFrame | Binned, n_rows: int | None = None) -> TreesModel:
        """The trees of a written matrix, or of its blocks; the blocks are read once per tree level."""
        data = rows if isinstance(rows, Binned) else Binned.of(rows, n_rows)
        return boost(
            data, self.max_iter, self.max_depth, self.step_size, self.row_share, self.column_share, self.seed, self.max_memory_mb << 20
        )

    def fit(self, df: DataFrame, features: Sequence[str], label: str = LABEL) -> BoostedModel:
        return BoostedModel.of(self.learn(materialise(self.matrix(df, features, label), "matrix")), features)


@dataclass
class BoostedModel:
    model: PipelineModel
    features: list[str]
    kind: str = "boosted_trees"

    @classmethod
    def of(cls, trees, features: Sequence[str]) -> BoostedModel:
        return cls(PipelineModel([_assembler(features), trees]), list(features))

    @property
    def trees(self):
        return self.model.stages[-1]

    def score(self, df: DataFrame, name: str = PROBABILITY) -> DataFrame:
        lacking = [c for c in self.features if c not in df.columns]
        if lacking:
            raise ValueError(f"features are missing: {lacking}")
        scored = self.model.transform(df)
        return scored.withColumn(name, vector_to_array("probability")[1]).drop(
            "_features", "rawPrediction", "probability", "prediction"
        )

    def feature_importance(self, spark: SparkSession, top_n: int | None = None) -> DataFrame:
        """Rows (feature, importance), largest first; from the model alone."""
        weights = self.trees.featureImportances.toArray()
        rows = sorted(zip(self.features, map(float, weights)), key=lambda r: (-r[1], r[0]))
        return spark.createDataFrame(rows[:top_n], "feature string, importance double")

    def save(self, path: str, spark: SparkSession) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        model_summary(spark, self.kind, self.features).write.mode("overwrite").parquet(
            f"{path}/summary"
        )

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> BoostedModel:
        row = spark.read.parquet(f"{path}/summary").first()
        return cls(PipelineModel.load(f"{path}/model"), list(row["features"]), row["model_type"])


def model_summary(spark: SparkSession, kind: str, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(
        [(MODEL_VERSION, kind, len(features), list(features))],
        "model_version string, model_type string, num_features int, features array<string>",
    )


# -- ensemble -----------------------------------------------------------------------------------


class EnsembleDetector:
    """Flags a row if the isolation forest or the boosted trees flag it."""

    def __init__(
        self,
        contamination: float = 0.035,
        boosted: BoostedTrees | None = None,
        forest: IsolationForest | None = None,
    ):
        self.boosted = boosted or BoostedTrees(row_share=1.0, column_share=1.0)
        self.forest = forest or IsolationForest(contamination=contamination)
        self.boosted_model: BoostedModel | None = None
        self.forest_model: IsolationForestModel | None = None

    @property
    def fitted(self) -> bool:
        return self.boosted_model is not None

    def fit(self, df: DataFrame, features: Sequence[str], label: str = LABEL) -> EnsembleDetector:
        self.forest_model = self.forest.fit(df.where(F.col(label) == 0), list(features))
        self.boosted_model = self.boosted.fit(df, features, label)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """Add fraud_probability, if_flag, boosted_flag and their OR as ``prediction``."""
        if not self.fitted:
            raise ValueError("not fitted: call fit() first")
        scored = self.forest_model.flag(self.boosted_model.score(df))
        return scored.withColumn("boosted_flag", binarise(F.col(PROBABILITY))).withColumn(
            "prediction", either(F.col("if_flag"), F.col("boosted_flag"))
        )

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add the boosted trees' probability; the forest takes no part in it."""
        if not self.fitted:
            raise ValueError("not fitted: call fit() first")
        return self.boosted_model.score(df)

    score = predict_proba

    def save(self, path_prefix: str, spark: SparkSession) -> None:
        if not self.fitted:
            raise ValueError("not fitted: nothing to save")
        self.forest_model.save(f"{path_prefix}_forest", spark)
        self.boosted_model.save(f"{path_prefix}_boosted", spark)

    @classmethod
    def load(cls, path_prefix: str, spark: SparkSession) -> EnsembleDetector:
        out = cls()
        out.forest_model = IsolationForestModel.load(f"{path_prefix}_forest", spark)
        out.boosted_model = BoostedModel.load(f"{path_prefix}_boosted", spark)
        return out


# -- explained single detector ------------------------------------------------------------------


class EnhancedDetector:
    """Boosted or ensemble detector with a low threshold and occlusion explanations."""

    TYPES = ("xgboost", "ensemble")

    def __init__(
        self,
        model_type: str = "xgboost",
        fraud_threshold: float = 0.2,
        explain: bool = True,
        boosted: BoostedTrees | None = None,
        contamination: float = 0.035,
    ):
        self.model_type, self.fraud_threshold, self.explain = model_type, fraud_threshold, explain
        self.boosted, self.contamination = boosted, contamination
        self.model = None
        self.feature_names: list[str] | None = None
        self.medians: dict[str, float] = {}

    def train(self, df: DataFrame, features: Sequence[str], label: str = LABEL) -> dict:
        """Fit and return ``{'train_accuracy': ...}`` at the detector's threshold."""
        if self.model_type not in self.TYPES:
            raise ValueError(f"Unknown model type: {self.model_type}")
        if self.model_type == "xgboost":
            self.model = (self.boosted or BoostedTrees()).fit(df, features, label)
        else:
            self.model = EnsembleDetector(self.contamination, self.boosted).fit(
                df, features, label
            )
        self.feature_names = list(features)
        if self.explain:
            self.learn_medians(df)
        flagged = self.score(df).withColumn(
            "_flag", binarise(F.col(PROBABILITY), self.fraud_threshold)
        )
        accuracy = metrics.performance_metrics(flagged, label, "_flag").first()["accuracy"]
        return {"train_accuracy": accuracy}

    def learn_medians(self, df: DataFrame) -> None:
        """The exact median of each feature: what an explanation puts in its place."""
        keys = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in self.feature_names}
        self.medians = {
            c: m[0] if m[0] is not None else float(MISSING)
            for c, m in exact_quantiles(df, keys, [0.5]).items()
        }

    @property
    def _boosted_model(self) -> BoostedModel:
        if self.model is None:
            raise ValueError("Model has not been trained yet")
        return self.model if self.model_type == "xgboost" else self.model.boosted_model

    def score(self, df: DataFrame) -> DataFrame:
        return self._boosted_model.score(df)

    def predict_with_explanation(self, df: DataFrame, top_n: int = 5) -> DataFrame:
        """Add fraud_probability, is_fraud, model_type and ``explanation``.

        ``explanation`` lists the features whose replacement by the training median moves the
        probability most. The task that holds a row scores it once more per feature, with that
        feature replaced: rows are neither repeated between tasks nor shuffled.
        """
        scored = self.score(df)
        if self.explain:
            names = self.feature_names
            given = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
            changed = self._boosted_model.trees.replaced(given, [float(self.medians[c]) for c in names])
            scored = materialise(scored.withColumn("_p", changed), "scored")
            deltas = [(F.col(PROBABILITY) - F.col("_p")[i]) for i in range(len(names))]
            ranked = F.array_sort(
                F.array(*[F.struct((-F.abs(d)).alias("rank"), F.lit(c).alias("feature"), d.alias("delta")) for c, d in zip(names, deltas)])
            )
            top = F.transform(F.slice(ranked, 1, top_n), lambda x: F.struct(x["feature"].alias("feature"), x["delta"].alias("delta")))
            scored = scored.withColumn("explanation", top).drop("_p")
        return scored.withColumns(
            {
                "is_fraud": F.col(PROBABILITY) > self.fraud_threshold,
                "model_type": F.lit(self.model_type),
            }
        )

    def get_feature_importance(self, spark: SparkSession, top_n: int = 10) -> DataFrame:
        return self._boosted_model.feature_importance(spark, top_n)

    def save(self, path: str, spark: SparkSession) -> None:
        if self.model is None:
            raise ValueError("Model has not been trained yet")
        self.model.save(f"{path}/detector", spark)
        spark.createDataFrame(
            [(self.model_type, self.fraud_threshold, self.feature_names, self.medians)],
            "model_type string, fraud_threshold double, features array<string>, "
            "medians map<string,double>",
        ).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> EnhancedDetector:
        row = spark.read.parquet(f"{path}/settings").first()
        out = cls(row["model_type"], row["fraud_threshold"], bool(row["medians"]))
        loader = BoostedModel if out.model_type == "xgboost" else EnsembleDetector
        out.model = loader.load(f"{path}/detector", spark)
        out.feature_names, out.medians = list(row["features"]), dict(row["medians"])
        return out


# -- graph, sequence and hybrid scores ----------------------------------------------------------


class GraphDetector:
    """Boosted trees on neighbourhood features learnt from the training slice."""

    def __init__(self, hops: int = 2, boosted: BoostedTrees | None = None):
        self.hops, self.boosted = hops, boosted or BoostedTrees()
        self.stats: graph.NodeStats | None = None
        self.model: BoostedModel | None = None

    def _matrix(self, df: DataFrame, own: bool) -> DataFrame:
        return graph.apply_node_stats(df, self.stats, leave_one_out=own).fillna(float(MISSING))

    def fit(self, df: DataFrame, label: str = LABEL) -> GraphDetector:
        self.stats = graph.fit_node_stats(df, self.hops, label=label)
        rows = self._matrix(df, own=True)
        features = [c for c in rows.columns if c not in df.columns] + ["TransactionAmt"]
        self.model = self.boosted.fit(rows, features, label)
        return self

    def predict_proba(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("not fitted: call fit() first")
        return self.model.score(self._matrix(df, own=False)).select(*df.columns, PROBABILITY)

    def save(self, path: str, spark: SparkSession) -> None:
        """A new version: the trees and one table per hop and node type."""
        if self.model is None:
            raise ValueError("not fitted: nothing to save")
        store = ModelStore(spark, path)
        folder = store.begin()
        for hop, tables in enumerate(self.stats.hops, start=1):
            for kind, table in tables.items():
                table.write.parquet(f"{folder}/{kind}-{hop}")
        self.model.save(f"{folder}/trees", spark)
        store.commit(folder, "graph", {"hops": len(self.stats.hops), "value": self.stats.value, "label": self.stats.label})

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> GraphDetector:
        folder, settings = ModelStore(spark, path).latest("graph")
        out = cls(settings["hops"])
        hops = [{kind: spark.read.parquet(f"{folder}/{kind}-{hop}") for kind in graph.LINKS} for hop in range(1, out.hops + 1)]
        out.stats = graph.NodeStats(hops, settings["value"], settings["label"])
        out.model = BoostedModel.load(f"{folder}/trees", spark)
        return out


class SequenceDetector:
    """Boosted trees on trailing-window features of the card's past."""

    KIND = "sequence"
    FEATURES = ("seq_len", "seq_mean", "seq_std", "seq_min", "seq_max", "seq_gap")

    def __init__(self, max_seq_len: int = 10, boosted: BoostedTrees | None = None):
        self.max_seq_len, self.boosted = max_seq_len, boosted or BoostedTrees()
        self.model: BoostedModel | None = None
        self.recent: DataFrame | None = None

    def _matrix(self, df: DataFrame) -> DataFrame:
        return sequences.sequence_features(df, self.max_seq_len).fillna(float(MISSING))

    def fit(self, df: DataFrame, label: str = LABEL) -> SequenceDetector:
        features = [*self.FEATURES, "TransactionAmt"]
        self.model = self.boosted.fit(self._matrix(df), features, label)
        self.keep_recent(df)
        return self

    def keep_recent(self, df: DataFrame) -> None:
        """Remember each card's latest rows of ``df``: all the history that later windows reach."""
        self.recent = materialise(sequences.latest_rows(df, self.max_seq_len - 1), "recent-rows")

    def predict_later(self, df: DataFrame) -> DataFrame:
        """Score rows that lie after the remembered ones, without reading the whole history again."""
        return self.predict_proba(df, self.recent)

    def save(self, path: str, spark: SparkSession) -> None:
        """A new version: the trees and the latest rows of each card."""
        if self.model is None:
            raise ValueError("not fitted: nothing to save")
        store = ModelStore(spark, path)
        folder = store.begin()
        self.recent.write.parquet(f"{folder}/recent")
        self.model.save(f"{folder}/trees", spark)
        store.commit(folder, self.KIND, {"max_seq_len": self.max_seq_len})

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> SequenceDetector:
        folder, settings = ModelStore(spark, path).latest(cls.KIND)
        out = cls(settings["max_seq_len"])
        out.model, out.recent = BoostedModel.load(f"{folder}/trees", spark), spark.read.parquet(f"{folder}/recent")
        return out

    def predict_proba(self, df: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """Score ``df``; ``history`` (earlier rows) only fills the windows."""
        if self.model is None:
            raise ValueError("not fitted: call fit() first")
        rows = df.withColumn("_new", F.lit(True))
        if history is not None:
            # columns that history lacks play no part in its windows
            rows = rows.unionByName(history.select(*[c for c in df.columns if c in history.columns]).withColumn("_new", F.lit(False)), allowMissingColumns=True)
        return self.model.score(self._matrix(rows).where("_new")).select(*df.columns, PROBABILITY)


def fuse_scores(structural: DataFrame, temporal: DataFrame, key: str = KEY) -> DataFrame:
    """Inner join of two score tables of the same transactions."""
    return structural.select(
        key, F.col(PROBABILITY).alias("p_graph"), *[c for c in (LABEL,) if c in structural.columns]
    ).join(temporal.select(key, F.col(PROBABILITY).alias("p_sequence")), key)


class HybridDetector:
    """Logistic regression over the graph and the sequence score.

    The base detectors learn on an early slice, the fusion on a later one.
    """

    def __init__(self, graph_detector: GraphDetector, sequence_detector: SequenceDetector):
        self.graph, self.sequence = graph_detector, sequence_detector
        self.fusion: PipelineModel | None = None

    def _scores(self, df: DataFrame, history: DataFrame | None) -> DataFrame:
        return fuse_scores(self.graph.predict_proba(df), self.sequence.predict_proba(df, history))

    def fit(self, train: DataFrame, validation: DataFrame, label: str = LABEL) -> HybridDetector:
        self.graph.fit(train, label)
        self.sequence.fit(train, label)
        assembler = _assembler(["p_graph", "p_sequence"])
        rows = materialise(
            self._scores(validation, train).withColumn("_label", F.col(label).cast("double")),
            "scores",
        )
        learner = LogisticRegression(featuresCol="_features", labelCol="_label", regParam=1e-3)
        model = learner.fit(assembler.transform(rows))
        self.fusion = PipelineModel([assembler, model])
        return self

    def predict_proba(self, df: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """Rows (TransactionID, isFraud, p_graph, p_sequence, fraud_probability)."""
        if self.fusion is None:
            raise ValueError("not fitted: call fit() first")
        scored = self.fusion.transform(self._scores(df, history))
        return scored.withColumn(PROBABILITY, vector_to_array("probability")[1]).drop(
            "_features", "rawPrediction", "probability", "prediction"
        )

    def predict_later(self, df: DataFrame) -> DataFrame:
        """Score rows after those that the sequence detector remembers."""
        return self.predict_proba(df, self.sequence.recent)

    def save(self, path: str, spark: SparkSession) -> None:
        """A new version of both base detectors and the fusion; visible once all three are written."""
        if self.fusion is None:
            raise ValueError("not fitted: nothing to save")
        store = ModelStore(spark, path)
        folder = store.begin()
        self.graph.save(f"{folder}/graph", spark)
        self.sequence.save(f"{folder}/sequence", spark)
        self.fusion.write().save(f"{folder}/fusion")
        store.commit(folder, "hybrid", {})

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> HybridDetector:
        folder, _ = ModelStore(spark, path).latest("hybrid")
        out = cls(GraphDetector.load(f"{folder}/graph", spark), SequenceDetector.load(f"{folder}/sequence", spark))
        out.fusion = PipelineModel.load(f"{folder}/fusion")
        return out


# -- parameter search ---------------------------------------------------------------------------

# fixed search ranges
SEARCH = {
    "max_depth": (3, 6),
    "step_size": (0.05, 0.3),
    "row_share": (0.6, 1.0),
    "column_share": (0.6, 1.0),
}


@dataclass
class ParameterSearch:
    """Seeded random draws, each fitted on one slice and judged by ROC-AUC on a later slice."""

    n_trials: int = 10
    seed: int = 42
    parallelism: int = 2
    base: BoostedTrees = field(default_factory=BoostedTrees)

    def draws(self) -> list[BoostedTrees]:
        rng = np.random.default_rng(self.seed)
        out = []
        for _ in range(self.n_trials):
            low, high = SEARCH["max_depth"]
            values = {"max_depth": int(rng.integers(low, high + 1))}
            for name in ("step_size", "row_share", "column_share"):
                values[name] = round(float(rng.uniform(*SEARCH[name])), 4)
            out.append(replace(self.base, **values))
        return out

    @staticmethod
    def objective(
        params: BoostedTrees,
        train: DataFrame,
        validation: DataFrame,
        features: Sequence[str],
        label: str = LABEL,
    ) -> tuple[float, BoostedModel]:
        model = params.fit(train, features, label)
        return metrics.area_of_model(model.score(validation), label, PROBABILITY), model

    def run(
        self, train: DataFrame, validation: DataFrame, features: Sequence[str], label: str = LABEL
    ) -> tuple[BoostedModel, DataFrame]:
        """The best model and the rows (trial, parameters, score); one binned matrix serves all trials."""
        trials = self.draws()
        rows = Binned.of(materialise(BoostedTrees.matrix(train, features, label), "matrix"))

        def tried(params: BoostedTrees) -> tuple[float, BoostedModel]:
            model = BoostedModel.of(params.learn(rows), features)
            return metrics.area_of_model(model.score(validation), label, PROBABILITY), model

        with ThreadPool(min(self.parallelism, len(trials))) as pool:
            results = pool.map(tried, trials)
        rows = [
            (i, p.max_depth, p.step_size, p.row_share, p.column_share, float(score))
            for i, (p, (score, _)) in enumerate(zip(trials, results))
        ]
        best = max(range(len(rows)), key=lambda i: (rows[i][-1], -i))
        table = train.sparkSession.createDataFrame(
            rows,
            "trial int, max_depth int, step_size double, row_share double, "
            "column_share double, score double",
        )
        return results[best][1], table


def train_report(
    model: BoostedModel, test: DataFrame, started: float, label: str = LABEL, threshold: float = 0.5
) -> dict:
    """roc_auc, recall, precision, f1_score of a model on ``test`` and the seconds since start."""
    scored = materialise(
        model.score(test).select(F.col(label), F.col(PROBABILITY)), "scores"
    ).withColumn("_flag", binarise(F.col(PROBABILITY), threshold))
    row = metrics.performance_metrics(scored, label, "_flag").first()
    area = metrics.roc_auc(scored, label, PROBABILITY).first()["auroc"]
    return {
        "roc_auc": 0.5 if area is None else area,
        "recall": row["recall"],
        "precision": row["precision"],
        "f1_score": row["f1_score"],
        "training_time_seconds": time.time() - started,
    }
