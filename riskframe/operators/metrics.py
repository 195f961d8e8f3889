"""Exact metrics for scored, imbalanced data.

Rank metrics first collapse the rows to one per distinct score (a shared score costs one row),
then take running totals over range buckets, so no task sees the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators.ordering import (
    before,
    order_cuts,
    range_bounds,
    rows_at,
    running_sums,
    slice_rows,
    total_order,
    with_buckets,
)
from riskframe.operators.quality import _as_rows
from riskframe.session import materialise



def _scores(df: DataFrame, score: str) -> DataFrame:
    """``score`` as a double in which NaN is missing, the one rule for all metrics of this module."""
    return df.withColumn(score, F.nanvl(F.col(score).cast("double"), F.lit(None)))


def confusion_matrix(
    df: DataFrame, label: str = "isFraud", prediction: str = "prediction"
) -> DataFrame:
    """One row tn, fp, fn, tp; an absent class counts 0."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def _share(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def performance_metrics(
    df: DataFrame, label: str = "isFraud", prediction: str = "prediction"
) -> DataFrame:
    """One row accuracy, precision, recall, f1_score, false_positive_rate."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion_matrix(df, label, prediction).select(
        _share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        _share(fp, fp + tn).alias("false_positive_rate"),
    )


def precision_recall_f1(
    df: DataFrame, label: str = "isFraud", prediction: str = "prediction"
) -> DataFrame:
    return performance_metrics(df, label, prediction).select(
        "precision", "recall", F.col("f1_score").alias("f1")
    )


def cost_sensitive_score(
    df: DataFrame,
    label: str = "isFraud",
    prediction: str = "prediction",
    fn_cost: float = 10.0,
    fp_cost: float = 1.0,
) -> DataFrame:
    return confusion_matrix(df, label, prediction).select(
        (F.col("fn") * F.lit(fn_cost) + F.col("fp") * F.lit(fp_cost)).alias("cost_sensitive_score")
    )


def focal_loss(
    df: DataFrame,
    label: str = "isFraud",
    score: str = "score",
    alpha: float = 0.25,
    gamma: float = 2.0,
) -> DataFrame:
    term = X.focal_term(F.col(label), F.col(score), alpha, gamma)
    return df.agg(F.avg(term).alias("focal_loss"))


def score_curve(df: DataFrame, label: str = "isFraud", score: str = "score") -> DataFrame:
    """Per distinct score: pos, neg and the totals of rows that score at least as high."""
    points = _scores(df, score).where(F.col(score).isNotNull()).select(
        (-F.col(score).cast("double")).alias("key"), F.col(label).alias("label")
    )
    bounds = range_bounds(points, ["key"])
    per_score = (
        with_buckets(points, bounds)
        .groupBy("key_bucket", "key")
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") != 1).alias("neg"),
        )
    )
    return running_sums(per_score, "key", {"cum_pos": "pos", "cum_neg": "neg"}, "key_bucket")


def _area(curve: DataFrame) -> DataFrame:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cum_pos, cum_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    return curve.agg(
        F.try_divide(F.sum(neg * (cum_pos - pos / 2)), F.sum(pos) * F.sum(neg)).alias("auroc"),
        F.try_divide(F.sum(pos * cum_pos / (cum_pos + cum_neg)), F.sum(pos)).alias("auprc"),
    )


def roc_auc(df: DataFrame, label: str = "isFraud", score: str = "score") -> DataFrame:
    """Mann-Whitney area with tied scores averaged; NULL if a class is absent."""
    return _area(score_curve(df, label, score)).select("auroc")


def area_of_model(scored: DataFrame, label: str, score: str) -> float:
    """The area of rows that a model has yet to score, 0.5 if a class is absent.

    They are written before they are ranked, since a ranking reads its rows several times.
    """
    area = roc_auc(materialise(scored.select(label, score), "scores"), label, score).first()["auroc"]
    return 0.5 if area is None else float(area)


def auprc(df: DataFrame, label: str = "isFraud", score: str = "score") -> DataFrame:
    """Average precision over the distinct thresholds; NULL without positives."""
    return _area(score_curve(df, label, score)).select("auprc")


def _ranking(df: DataFrame, score: str, key: str) -> tuple[DataFrame, list]:
    """The frame and its order: best score first, then by id, then by content; missing keys last."""
    flipped = _scores(df, score).withColumn("_flipped", -F.col(score))
    return flipped, total_order(flipped, "_flipped", key)


def top_rows(df: DataFrame, score: str, k: int, key: str = "TransactionID") -> DataFrame:
    """The k best scores (all rows if fewer), ties by id and then by content."""
    flipped, order = _ranking(df, score, key)
    (cut,) = order_cuts(flipped, order, lambda _: [k])
    return slice_rows(flipped, order, end=cut).drop("_flipped")


def precision_recall_at_k(
    df: DataFrame,
    k_values: Sequence[int] = (10, 50, 100, 500),
    label: str = "isFraud",
    score: str = "score",
    key: str = "TransactionID",
) -> DataFrame:
    """Rows (k, precision_at_k, recall_at_k); k is clamped to the number of rows.

    The cuts of all k are searched together and counted alike, however large k is. Missing and NaN
    scores rank last, as do missing ids within a score.
    """
    columns = list(dict.fromkeys(c for c in (key, score, label) if c in df.columns))
    slim = df.select(*columns)
    totals = slim.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p"))
    wanted = sorted(set(k_values))
    flipped, order = _ranking(slim, score, key)
    positive = F.col(label) == 1
    cuts = order_cuts(flipped, order, lambda _: wanted)
    inner = [
        F.count_if(positive & F.coalesce(before(order, cut), F.lit(False))).alias(f"h{i}")
        for i, cut in enumerate(cuts)
    ]
    counted = flipped.agg(*inner)
    spare = {  # of identical rows at a cut some lie before it: all have one label
        i: flipped.where(rows_at(order, cut)).limit(1).select(positive.cast("int")).scalar()
        for i, cut in enumerate(cuts) if cut.spare
    }
    hits = counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(k).alias("k"),
            (F.col(f"h{i}") + (F.coalesce(spare[i], F.lit(0)) * cuts[i].spare if i in spare else 0)).cast("bigint").alias("hits"),
        )
        for i, k in enumerate(wanted)
    ])))
    n, p = totals.select("n").scalar(), totals.select("p").scalar()
    return hits.select(
        "k",
        _share(F.col("hits"), F.least(F.col("k"), n)).alias("precision_at_k"),
        _share(F.col("hits"), p).alias("recall_at_k"),
    )


def comprehensive_evaluation(
    df: DataFrame,
    k_values: Sequence[int] = (10, 50, 100, 500),
    label: str = "isFraud",
    score: str = "score",
    key: str = "TransactionID",
    threshold: float = 0.5,
    fn_cost: float = 10.0,
    fp_cost: float = 1.0,
) -> DataFrame:
    """All metrics as rows (metric, value). Persist or write ``df`` first if scoring is costly."""

    def rows(wide: DataFrame) -> DataFrame:
        packed = wide.select(*[F.struct(F.col(c).alias("value")).alias(f"_{i}")
                               for i, c in enumerate(wide.columns)])
        return _as_rows(packed, wide.columns, "metric", ["value"])

    flagged = df.withColumn("_flag", X.binarise(F.col(score), threshold))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    counted = confusion_matrix(flagged, label, "_flag").select(
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (fn * F.lit(fn_cost) + fp * F.lit(fp_cost)).alias("cost_sensitive_score"),
    )
    at_k = precision_recall_at_k(df, k_values, label, score, key).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.concat(F.lit(f"{name}@"), F.col("k").cast("string")).alias("metric"),
                        F.col(f"{name}_at_k").alias("value"),
                    )
                    for name in ("precision", "recall")
                ]
            )
        )
    )
    areas = _area(score_curve(df, label, score))
    return rows(areas).unionByName(rows(counted)).unionByName(at_k)
