"""Distribution profiles and drift: mean shift, Kolmogorov-Smirnov, population stability."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import expressions as X
from riskframe.operators import metrics
from riskframe.operators.ordering import (
    exact_quantiles,
    numeric_key,
    range_bounds,
    running_sums,
    with_buckets,
)
from riskframe.operators.quality import _as_rows
from riskframe.session import materialise

STATS = ["mean", "std", "min", "max", "median"]
MEAN_SHIFT = 2.0
PSI_FLOOR = 1e-4
PSI_LIMIT = 0.1
KS_LEVEL = 0.05


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def numeric_profile(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows (feature, mean, std, min, max, median): one aggregate plus exact rank selection."""
    names = numeric_columns(df, exclude)
    keys = {c: numeric_key(df, f"`{c}`") for c in names}
    medians = exact_quantiles(df, keys, [0.5])
    wide = df.agg(
        *[
            F.struct(
                F.avg(k).alias("mean"),
                F.stddev_samp(k).alias("std"),
                F.min(k).cast("double").alias("min"),
                F.max(k).cast("double").alias("max"),
                F.lit(medians[c][0]).cast("double").alias("median"),
            ).alias(f"_{i}")
            for i, (c, k) in enumerate(keys.items())
        ]
    )
    return _as_rows(wide, names, "feature", STATS)


def mean_shift(reference: DataFrame, current: DataFrame, limit: float = MEAN_SHIFT) -> DataFrame:
    """Per feature of both profiles: score |mean difference| / reference std, and the flag.

    A zero or missing reference std, or a missing mean, gives no score and no drift.
    """
    ref = reference.select("feature", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std"))
    cur = current.select("feature", F.col("mean").alias("cur_mean"))
    score = F.when(
        F.col("ref_std") > 0, F.abs(F.col("cur_mean") - F.col("ref_mean")) / F.col("ref_std")
    )
    return (
        ref.join(cur, "feature")
        .withColumn("drift_score", score)
        .withColumn("drifted", F.coalesce(F.col("drift_score") > limit, F.lit(False)).cast("int"))
    )


class DriftDetector:
    """Mean-shift drift against a reference frame."""

    def __init__(
        self,
        reference_data: DataFrame,
        drift_threshold: float = 0.3,
        exclude_cols: Sequence[str] = (),
    ):
        self.exclude_cols = tuple(exclude_cols)
        self.drift_threshold = drift_threshold
        self.reference_stats = materialise(
            numeric_profile(reference_data, self.exclude_cols), "profile"
        )

    def drift_scores(self, current_data: DataFrame) -> DataFrame:
        return mean_shift(
            self.reference_stats, numeric_profile(current_data, self.exclude_cols)
        )

    def check_drift(self, current_data: DataFrame) -> DataFrame:
        """One row drift_detected, drift_share, drifted_features, drift_scores (a map)."""
        return drift_summary(
            self.reference_stats, self.drift_scores(current_data), self.drift_threshold
        )


def drift_summary(reference: DataFrame, scores: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The share counts drifted features over all reference features."""
    joined = reference.select("feature").join(scores, "feature", "left")
    hit = F.col("drifted") == 1
    return joined.agg(
        F.coalesce(
            F.try_divide(F.count_if(hit).cast("double"), F.count(F.lit(1))), F.lit(0.0)
        ).alias("drift_share"),
        F.array_sort(F.collect_list(F.when(hit, F.col("feature")))).alias("drifted_features"),
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.when(F.col("drift_score").isNotNull(), F.struct("feature", "drift_score"))
                )
            )
        ).alias("drift_scores"),
    ).select(
        (F.col("drift_share") > threshold).alias("drift_detected"),
        "drift_share",
        "drifted_features",
        F.slice("drifted_features", 1, 5).alias("first_drifted"),
        "drift_scores",
    )


def _paired(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, flag: int) -> DataFrame:
        return df.select(
            F.lit(flag).alias("is_current"),
            *[
                numeric_key(df, f"`{c}`").cast("double").alias(f"f{i}")
                for i, c in enumerate(features)
            ],
        )

    return side(reference, 0).unionByName(side(current, 1))


def shared_features(
    reference: DataFrame, current: DataFrame, exclude: Sequence[str] = ()
) -> list[str]:
    other = set(numeric_columns(current))
    return [c for c in numeric_columns(reference, exclude) if c in other]


def ks_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    level: float = KS_LEVEL,
) -> DataFrame:
    """Rows (feature, statistic, p_value, drifted, status) of the two-sample KS test.

    Every feature has a row; without values on one side its statistic is missing.

    Values are counted per distinct value first; the distribution functions come from running
    totals per feature and range bucket.
    """
    features = list(features or shared_features(reference, current))
    both = _paired(reference, current, features)
    aliases = [f"f{i}" for i in range(len(features))]
    bucketed = with_buckets(both, range_bounds(both, aliases))
    long = bucketed.select(
        "is_current",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature"),
                        F.col(a).alias("value"),
                        F.col(f"{a}_bucket").alias("bucket"),
                    )
                    for a, name in zip(aliases, features)
                ]
            )
        ),
    ).where("value is not null")
    per_value = long.groupBy("feature", "bucket", "value").agg(
        F.count_if(F.col("is_current") == 0).alias("ref_n"),
        F.count_if(F.col("is_current") == 1).alias("cur_n"),
    )
    return ks_of_counts(per_value, features, level)


def ks_of_counts(per_value: DataFrame, features: Sequence[str], level: float = KS_LEVEL) -> DataFrame:
    """The KS rows from (feature, bucket, value, ref_n, cur_n), one row per distinct value."""
    curve = running_sums(
        per_value, "value", {"ref_cum": "ref_n", "cur_cum": "cur_n"}, "bucket", ["feature"]
    )
    totals = per_value.groupBy("feature").agg(
        F.sum("ref_n").cast("double").alias("n"), F.sum("cur_n").cast("double").alias("m")
    )
    gap = F.abs(F.col("ref_cum") / F.col("n") - F.col("cur_cum") / F.col("m"))
    d = curve.join(totals.where("n > 0 and m > 0"), "feature").groupBy("feature").agg(
        F.max(gap).alias("statistic")
    )
    p_value = F.when(
        F.col("statistic").isNotNull(), X.ks_p_value(F.col("statistic"), F.col("n"), F.col("m"))
    )
    found = _every_feature(per_value, features, totals).join(d, "feature", "left")
    return found.withColumn("p_value", p_value).select(
        "feature", "statistic", "p_value", _drifted(F.col("p_value") < level), "status"
    )


def _every_feature(frame: DataFrame, features: Sequence[str], totals: DataFrame) -> DataFrame:
    """One row per feature with its counts n and m, 0 where a side has no value, and a status."""
    names = frame.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    status = (
        F.when((F.col("n") > 0) & (F.col("m") > 0), "compared")
        .when(F.col("n") > 0, "no current values")
        .when(F.col("m") > 0, "no reference values")
        .otherwise("no values")
    )
    return (
        names.join(totals, "feature", "left").na.fill(0.0, ["n", "m"]).withColumn("status", status)
    )


def _drifted(beyond) -> Column:
    """A feature that has values on one side only has drifted; one without any values hasn't."""
    one_sided = F.col("status").isin("no current values", "no reference values")
    return F.coalesce(beyond, one_sided).cast("int").alias("drifted")


def decile_edges(
    reference: DataFrame, features: Sequence[str], bins: int = 10
) -> dict[str, list[float]]:
    """Inner edges per feature: exact quantiles of the reference, rounded to 9 places."""
    keys = {c: numeric_key(reference, f"`{c}`") for c in features}
    inner = exact_quantiles(reference, keys, [i / bins for i in range(1, bins)])
    return {c: [round(e, 9) for e in edges if e is not None] for c, edges in inner.items()}


def psi_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    bins: int = 10,
    limit: float = PSI_LIMIT,
) -> DataFrame:
    """Rows (feature, psi, drifted, status) over bins at the reference's quantiles, ends open.

    Every feature has a row; without values on one side its index is missing.

    One pre-aggregated pass over both frames; the shuffle carries features x bins counters.
    """
    features = list(features or shared_features(reference, current))
    edges = decile_edges(reference, features, bins)
    both = _paired(reference, current, features)

    def bin_of(column, inner):
        out = F.when(column.isNotNull(), 0)
        for e in inner:
            out = out + (column >= F.lit(e)).cast("int")
        return out

    long = both.select(
        "is_current",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"), bin_of(F.col(f"f{i}"), edges[c]).alias("bin")
                    )
                    for i, c in enumerate(features)
                ]
            )
        ),
    ).where("bin is not null")
    counts = long.groupBy("feature", "bin").agg(
        F.count_if(F.col("is_current") == 0).alias("ref_n"),
        F.count_if(F.col("is_current") == 1).alias("cur_n"),
    )
    return psi_of_counts(counts, features, bins, limit)


def psi_of_counts(counts: DataFrame, features: Sequence[str], bins: int = 10, limit: float = PSI_LIMIT) -> DataFrame:
    """The PSI rows from (feature, bin, ref_n, cur_n)."""
    # one small row per feature: at most `bins` counters each
    packed = counts.groupBy("feature").agg(
        F.sum("ref_n").cast("double").alias("n"),
        F.sum("cur_n").cast("double").alias("m"),
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct("ref_n", "cur_n")))).alias("by"),
    )

    def term(acc, b):
        entry = F.col("by")[b]
        r = F.greatest(F.coalesce(entry["ref_n"], F.lit(0)) / F.col("n"), F.lit(PSI_FLOOR))
        c = F.greatest(F.coalesce(entry["cur_n"], F.lit(0)) / F.col("m"), F.lit(PSI_FLOOR))
        return acc + (c - r) * F.log(c / r)

    psi = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(0.0), term)
    scored = packed.where("n > 0 and m > 0").select("feature", psi.alias("psi"))
    found = _every_feature(counts, features, packed.select("feature", "n", "m"))
    return found.join(scored, "feature", "left").select(
        "feature", "psi", _drifted(F.col("psi") > limit), "status"
    )


class ModelMonitor:
    """Keeps a reference and reports drift and performance of later data against it."""

    def __init__(self, model_name: str = "model", drift_threshold: float = KS_LEVEL):
        self.model_name, self.drift_threshold = model_name, drift_threshold
        self.reference_data: DataFrame | None = None
        self.reference_metrics: dict | None = None
        self.profile = None

    def set_reference_data(
        self,
        features: DataFrame | None,
        scored: DataFrame | None = None,
        label: str = "label",
        prediction: str = "prediction",
    ) -> None:
        """``features`` for drift, ``scored`` (label and prediction columns) for performance.

        The reference is read here once; every later check reads its profile.
        """
        from riskframe.operators.profiles import ReferenceProfile

        self.reference_data = features
        self.profile = None if features is None else ReferenceProfile.build(features)
        if scored is not None:
            self.reference_metrics = self.track_performance(scored, label, prediction).first(
            ).asDict()

    def set_reference_profile(self, profile) -> None:
        """A profile built earlier, for instance one that was loaded, in place of the reference data."""
        self.profile = profile

    def detect_data_drift(self, current: DataFrame, method: str = "ks") -> DataFrame:
        """Rows per feature with timestamp, method, score, drifted."""
        if self.profile is None:
            raise ValueError("Reference data not set")
        if method == "ks":
            found = self.profile.ks(current, self.drift_threshold)
            score = F.col("p_value")
        elif method == "psi":
            found = self.profile.psi(current)
            score = F.col("psi")
        else:
            raise ValueError(f"unknown method: {method}")
        now = dt.datetime.now(dt.timezone.utc)
        return found.select(
            F.lit(now).alias("timestamp"),
            F.lit(method).alias("method"),
            "feature",
            score.alias("score"),
            "drifted",
        )

    @staticmethod
    def track_performance(
        scored: DataFrame, label: str = "label", prediction: str = "prediction"
    ) -> DataFrame:
        return metrics.performance_metrics(scored, label, prediction)

    def generate_report(
        self,
        current: DataFrame,
        scored: DataFrame,
        label: str = "label",
        prediction: str = "prediction",
        method: str = "ks",
    ) -> DataFrame:
        """One row: timestamp, model_name, drift_detection, performance, feature_stats."""
        drift = self.detect_data_drift(current, method).agg(
            F.struct(
                (F.max("drifted") == 1).alias("drift_detected"),
                F.array_sort(F.collect_list(F.struct("feature", "score", "drifted"))).alias(
                    "features"
                ),
            ).alias("s")
        )
        performance = self.track_performance(scored, label, prediction)
        stats = numeric_profile(current).agg(
            F.array_sort(F.collect_list(F.struct("feature", *STATS))).alias("s")
        )
        return performance.select(
            F.lit(dt.datetime.now(dt.timezone.utc)).alias("timestamp"),
            F.lit(self.model_name).alias("model_name"),
            drift.scalar().alias("drift_detection"),
            F.struct(*performance.columns).alias("performance"),
            stats.scalar().alias("feature_stats"),
        )

    @staticmethod
    def save_report(report: DataFrame, path: str) -> None:
        """Append a report to the history at ``path``."""
        report.write.mode("append").parquet(path)
