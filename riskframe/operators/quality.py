"""Data-quality profile: label rate, duplicates, missing values, exact sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expressions import hash52
from riskframe.operators.ordering import content_keys, order_cuts, slice_rows, total_order

LABEL, KEY = "isFraud", "TransactionID"


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL, so that COUNT sees values only."""
    col = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(col, F.lit(None))
    return col


def _as_rows(wide: DataFrame, names: list[str], key: str, fields: list[str]) -> DataFrame:
    """One-row frame of structs ``_0, _1, ...`` turned into a row per name."""
    entries = [
        F.struct(F.lit(n).alias(key), *[F.col(f"_{i}.{f}").alias(f) for f in fields])
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*entries)))


def label_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.sum(label).alias("fraud_count"), F.avg(label).alias("fraud_rate"))


def duplicate_count(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows beyond the first of each key; a missing key is one value."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, in one scan."""
    n = F.count(F.lit(1))
    missing = {c: n - F.count(present(df, c)) for c in df.columns}
    wide = df.agg(
        *[
            F.struct(
                m.alias("missing"), F.try_divide(m * 100.0, n).alias("missing_pct")
            ).alias(f"_{i}")
            for i, m in enumerate(missing.values())
        ]
    )
    return _as_rows(wide, list(missing), "column_name", ["missing", "missing_pct"])


def high_missing(df: DataFrame, above: float = 50.0, top: int = 10) -> DataFrame:
    return (
        missing_profile(df)
        .where(F.col("missing_pct") > above)
        .orderBy(F.desc("missing_pct"), "column_name")
        .limit(top)
    )


def basic_stats(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: size, label statistics if labelled, missing-value summary; one scan."""
    n = F.count(F.lit(1))
    missing = [n - F.count(present(df, c)) for c in df.columns]
    asks = [n.alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")]
    if label in df.columns:
        asks += [F.sum(label).alias("fraud_count"), F.avg(label).alias("fraud_rate")]
    asks.append(F.array(*missing).alias("_missing"))
    return (
        df.agg(*asks)
        .withColumn(
            "missing_total",
            F.aggregate("_missing", F.lit(0).cast("bigint"), lambda acc, m: acc + m),
        )
        .withColumn(
            "columns_with_missing",
            F.size(F.filter("_missing", lambda m: m > 0)).cast("bigint"),
        )
        .drop("_missing")
    )


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type, from the schema alone."""
    counts: dict[str, int] = {}
    for _, kind in df.dtypes:
        counts[kind] = counts.get(kind, 0) + 1
    schema = "data_type string, n_columns bigint"
    return df.sparkSession.createDataFrame(sorted(counts.items()), schema)


def quality_report(
    df: DataFrame,
    label: str = LABEL,
    key: str = KEY,
    low: float = 0.01,
    high: float = 0.5,
    above: float = 50.0,
) -> DataFrame:
    """The validation checks as rows (check_name, value, status)."""
    n_rows = F.count(F.lit(1)).cast("double")
    n_missing = [F.count(present(df, c)) for c in df.columns]
    bad = sum(
        (F.when(F.count(F.lit(1)) - m > F.count(F.lit(1)) * (above / 100), 1).otherwise(0))
        for m in n_missing
    )
    asks = [n_rows.alias("n_rows"), bad.cast("double").alias("n_high_missing")]
    if label in df.columns:
        asks.append(F.avg(label).alias("rate"))
    ok, warn = F.lit("ok"), F.lit("warning")

    def check(name: str, value: Column, failed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            value.alias("value"),
            F.when(failed, warn).otherwise(ok).alias("status"),
        )

    rows = [
        check("rows", F.col("n_rows"), F.lit(False)),
        check("columns", F.lit(float(len(df.columns))), F.lit(False)),
        check("high_missing_columns", F.col("n_high_missing"), F.col("n_high_missing") > 0),
    ]
    if label in df.columns:
        rate = F.col("rate")
        rows.append(check("label_rate", rate, (rate < low) | (rate > high)))
    report = df.agg(*asks).select(F.inline(F.array(*rows)))
    if key in df.columns:
        dupes = duplicate_count(df, key).select(
            F.inline(
                F.array(
                    check(
                        "duplicates", F.col("duplicates").cast("double"), F.col("duplicates") > 0
                    )
                )
            )
        )
        report = report.unionByName(dupes)
    return report


def sample_exact(
    df: DataFrame, frac: float, seed: int = 42, key: str = KEY, portable: bool = False
) -> DataFrame:
    """Exactly round(frac * n) rows: those with the smallest seeded hash of the key.

    The cut is found by rank selection, so the sample is a filter and no rows are sorted.
    ``portable`` takes an MD5 hash that other engines can repeat, at a higher cost per row.
    """
    if key not in df.columns:
        order = [F.shiftright(F.xxhash64(F.lit(seed), content_keys(df)[0]), 12)]
        order += content_keys(df)
    else:
        text = F.coalesce(F.col(key).cast("string"), F.lit(""))
        quick = F.shiftright(F.xxhash64(F.lit(seed), F.col(key)), 12)
        order = [hash52(text, F.lit(seed)) if portable else quick, *total_order(df, key)]
    (cut,) = order_cuts(df, order, lambda n: [round(frac * n)])
    return slice_rows(df, order, end=cut)


def sample_bernoulli(df: DataFrame, frac: float, seed: int = 42) -> DataFrame:
    """About frac * n rows in one pass."""
    return df.sample(withReplacement=False, fraction=frac, seed=seed)
