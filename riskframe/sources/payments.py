"""The payments table: scan, features, and the trainer on top of it."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators import models, splits
from riskframe.operators.features import FeatureEngineer, FeatureState, category_table
from riskframe.session import materialise
from riskframe.sources.schemas import PAYMENTS

TARGET, KEY = "fraud_bool", "transaction_id"
CATEGORIES = ("browser", "country_code", "device_os", "merchant_category", "source", "zip_code")


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(PAYMENTS).csv(path)


def payment_codes(train: DataFrame) -> FeatureEngineer:
    """The category codes of a training slice."""
    codes, sizes = category_table(train, list(CATEGORIES))
    return FeatureEngineer(FeatureState(codes=codes, code_bytes=sizes))


def prepare_payments(
    df: DataFrame, engineer: FeatureEngineer | None = None
) -> tuple[DataFrame, list[str]]:
    """(rows with key, target, time and numeric features; sorted feature names).

    Category codes are those of ``engineer`` (:func:`payment_codes` of a training slice; what it
    hasn't seen is -1), without one those of the rows given.
    """
    day = F.weekday("timestamp")
    wide = df.select(
        KEY,
        TARGET,
        "timestamp",
        "amount",
        X.amount_log(F.col("amount")).alias("amount_log"),
        F.hour("timestamp").alias("hour_of_day"),
        day.alias("day_of_week"),
        X.is_weekend(day).alias("is_weekend"),
        F.col("is_international").cast("int").alias("is_international"),
        *CATEGORIES,
    )
    own = (KEY, TARGET, "timestamp")
    mode = "fitted" if engineer else "per_frame"
    ready = (engineer or FeatureEngineer()).prepare_for_model(
        wide, drop_cols=own, keep=own, mode=mode
    )
    names = sorted(c for c in ready.columns if c not in own)
    return ready.select(*own, *names), names


def split_payments(raw: DataFrame, test_size: float) -> tuple[list[DataFrame], list[str]]:
    """([train, validation, test], feature names): split by time, codes learnt on train alone."""
    parts = splits.temporal_train_test_split(
        materialise(raw, "payments"), "timestamp", test_size, test_size, KEY
    )
    engineer = payment_codes(parts[0])
    ready = [prepare_payments(part, engineer) for part in parts]
    return [materialise(rows, "payments-part") for rows, _ in ready], ready[0][1]


class PaymentTrainer:
    """Reads payments, searches parameters on a time-ordered slice, reports on the last slice."""

    def __init__(
        self,
        data_path: str,
        test_size: float = 0.2,
        random_state: int = 42,
        n_trials: int = 10,
        base: models.BoostedTrees | None = None,
        spark: SparkSession | None = None,
    ):
        self.data_path, self.test_size = data_path, test_size
        self.random_state, self.n_trials = random_state, n_trials
        self.base = base or models.BoostedTrees(seed=random_state)
        self.spark = spark
        self.model: models.BoostedModel | None = None
        self.feature_columns: list[str] | None = None
        self.trials: DataFrame | None = None

    def load_and_prepare_data(self) -> DataFrame:
        spark = self.spark or SparkSession.active()
        rows, self.feature_columns = prepare_payments(read_payments(spark, self.data_path))
        return rows

    def train(self) -> dict:
        started = time.time()
        raw = read_payments(self.spark or SparkSession.active(), self.data_path)
        parts, self.feature_columns = split_payments(raw, self.test_size)
        train, validation, test = parts
        search = models.ParameterSearch(self.n_trials, self.random_state, base=self.base)
        self.model, self.trials = search.run(train, validation, self.feature_columns, TARGET)
        return models.train_report(self.model, test, started, TARGET)

    def objective(
        self, params: models.BoostedTrees, train: DataFrame, validation: DataFrame
    ) -> float:
        return models.ParameterSearch.objective(
            params, train, validation, self.feature_columns, TARGET
        )[0]

    def save_model(self, path: str = "models/payments") -> None:
        if self.model is None:
            raise ValueError("Model has not been trained yet")
        self.model.save(path, self.spark or SparkSession.active())
