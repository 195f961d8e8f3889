"""Stateful feature engineering: statistics are learnt on the training slice only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import expressions as X
from riskframe.operators.ordering import dense_codes, exact_quantiles, numeric_key
from riskframe.operators.skew import lookup_join
from riskframe.session import materialise

AMOUNT, TIME = "TransactionAmt", "TransactionDT"
DROPPED = ("TransactionID", "TransactionDT", "isFraud")
MISSING = -999


@dataclass
class FeatureState:
    """What ``fit`` learns: amount statistics, category codes, the feature manifest."""

    amount_mean: float | None = None
    amount_std: float | None = None
    amount_median: float | None = None
    features: list[str] = field(default_factory=list)
    codes: DataFrame | None = None  # column_name, value, code
    code_bytes: dict[str, int] = field(default_factory=dict)


STATE_SCHEMA = (
    "amount_mean double, amount_std double, amount_median double, features array<string>"
)


def fit_amount_stats(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    """One row (amount_mean, amount_std, amount_median); the median by rank selection."""
    clean = numeric_key(df, amount)
    median = exact_quantiles(df, {amount: clean}, [0.5])[amount][0]
    return df.agg(
        F.avg(clean).alias("amount_mean"), F.stddev_samp(clean).alias("amount_std")
    ).withColumn("amount_median", F.lit(median).cast("double"))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def category_table(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """((column_name, value, code), bytes per column): 0-based codes of the sorted distinct values.

    One pre-aggregated shuffle serves all columns; only the distinct table is numbered.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    distinct = pairs.where("value is not null").distinct()
    values = materialise(distinct, "values")
    sizes = _sizes(values)
    coded = dense_codes(
        values, "value", "code", ["column_name"], sum(rows for rows, _ in sizes.values())
    )
    codes = materialise(
        coded.select("column_name", "value", F.col("code").cast("int").alias("code")), "codes"
    )
    return codes, {c: size for c, (_, size) in sizes.items()}


def _sizes(values: DataFrame) -> dict[str, tuple[int, int]]:
    """(rows, bytes) per coded column; one row per column reaches the driver."""
    size = F.octet_length("value") + 32
    rows = values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")
    )
    return {r["column_name"]: (r["n"], r["b"]) for r in rows.collect()}


def apply_codes(
    df: DataFrame, codes: DataFrame, columns: list[str], sizes: dict[str, int]
) -> DataFrame:
    """Replace each string column by its code; missing and unseen values get -1."""
    out = df
    for c in columns:
        lookup = codes.where(F.col("column_name") == c).select(
            F.col("value").alias(c), F.col("code").alias("_code")
        )
        out = lookup_join(out, lookup, c, sizes.get(c, 0), probe=df)
        out = out.withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code")
    return out.select(*df.columns)


class FeatureEngineer:
    """fit / transform / prepare_for_model on DataFrames."""

    def __init__(self, state: FeatureState | None = None):
        self.state = state

    @property
    def fitted(self) -> bool:
        return self.state is not None

    def fit(self, df: DataFrame, with_codes: bool = True) -> FeatureEngineer:
        state = FeatureState()
        if AMOUNT in df.columns:
            row = fit_amount_stats(df).first()
            state.amount_mean, state.amount_std, state.amount_median = row
        self.state = state
        strings = [c for c in string_columns(df) if c not in DROPPED] if with_codes else []
        if strings:
            state.codes, state.code_bytes = category_table(df, strings)
        state.features = self._feature_names(self.transform(df), DROPPED)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the amount and time features; works on batch and streaming frames."""
        if self.state is None:
            raise ValueError("not fitted: call fit() first")
        new = {}
        if AMOUNT in df.columns:
            amount = F.col(AMOUNT)
            new["amount_log"] = X.amount_log(amount)
            new["amount_decimal"] = X.amount_decimal(amount)
            new["amount_vs_mean"] = X.ratio(amount, self.state.amount_mean)
            new["amount_vs_median"] = X.ratio(amount, self.state.amount_median)
        if TIME in df.columns:
            seconds = F.col(TIME)
            new["hour"] = X.hour_of_offset(seconds)
            new["day_of_week"] = X.day_of_offset(seconds)
            new["is_weekend"] = X.is_weekend(X.day_of_offset(seconds))
        return df.withColumns(new) if new else df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    @staticmethod
    def _feature_names(df: DataFrame, drop_cols) -> list[str]:
        usable = (T.NumericType, T.StringType, T.BooleanType)
        return [
            f.name for f in df.schema if f.name not in drop_cols and isinstance(f.dataType, usable)
        ]

    def prepare_for_model(
        self,
        df: DataFrame,
        drop_cols=None,
        keep: tuple[str, ...] = (),
        mode: str = "fitted",
        fill: float = MISSING,
    ) -> DataFrame:
        """Drop id, time and label, code the strings, fill missing numbers.

        NaN and infinite numbers (the logarithm of an amount of -1) count as missing.

        ``keep`` columns stay beside the features. ``mode='fitted'`` uses the codes learnt on the
        training slice; ``mode='per_frame'`` numbers the values of this frame.
        """
        drop_cols = DROPPED if drop_cols is None else drop_cols
        names = self._feature_names(df, drop_cols)
        kept = [c for c in keep if c in df.columns and c not in names]
        strings = [c for c in string_columns(df) if c in names]
        out = df.select(*[F.col(f"`{c}`") for c in kept + names])
        if strings:
            if mode == "per_frame":
                codes, sizes = category_table(df, strings)
            elif mode == "fitted":
                if self.state is None or self.state.codes is None:
                    raise ValueError("fit() has learnt no category codes")
                codes, sizes = self.state.codes, self.state.code_bytes
            else:
                raise ValueError(f"unknown mode: {mode}")
            out = apply_codes(out, codes, strings, sizes)
        changed = {}
        for f in out.schema:
            if f.name in kept:
                continue
            col = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.BooleanType):
                col = col.cast("int")
            if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
                col = F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)
            kind = "int" if isinstance(f.dataType, T.BooleanType) else f.dataType
            changed[f.name] = F.coalesce(col, F.lit(fill).cast(kind))
        return out.withColumns(changed) if changed else out

    # -- state tables ---------------------------------------------------------------------------

    def save(self, path: str, spark: SparkSession) -> None:
        """Write the state as Parquet tables ``stats`` and ``codes`` below ``path``."""
        if self.state is None:
            raise ValueError("not fitted: nothing to save")
        s = self.state
        spark.createDataFrame(
            [(s.amount_mean, s.amount_std, s.amount_median, s.features)], STATE_SCHEMA
        ).write.mode("overwrite").parquet(f"{path}/stats")
        codes = s.codes
        if codes is None:
            codes = spark.createDataFrame([], "column_name string, value string, code int")
        codes.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> FeatureEngineer:
        row = spark.read.schema(STATE_SCHEMA).parquet(f"{path}/stats").first()
        codes = spark.read.parquet(f"{path}/codes")
        return cls(
            FeatureState(
                row["amount_mean"],
                row["amount_std"],
                row["amount_median"],
                list(row["features"]),
                codes,
                {c: size for c, (_, size) in _sizes(codes).items()},
            )
        )

    def check_features(self, names: list[str]) -> None:
        """Raise if a frame to be scored lacks features of the manifest."""
        lacking = [c for c in self.state.features if c not in names]
        if lacking:
            raise ValueError(f"features are missing: {lacking}")
