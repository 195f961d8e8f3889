"""Queries: metrics of a rule score, and drift between the time slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators import drift, metrics
from riskframe.plans.base import SCORED, SPLIT, TXN, query, r6, rounded
from riskframe.plans.data import train_test
from riskframe.sources import views


def flagged(spark, sf) -> DataFrame:
    return views.scored(spark, sf).withColumn("prediction", X.binarise(F.col("score")))


_CM = f"""WITH {SCORED},
cm AS (
  SELECT count(*) FILTER ("isFraud" <> 1 AND score <= 0.5) AS tn,
         count(*) FILTER ("isFraud" <> 1 AND score > 0.5) AS fp,
         count(*) FILTER ("isFraud" = 1 AND score <= 0.5) AS fn,
         count(*) FILTER ("isFraud" = 1 AND score > 0.5) AS tp
  FROM scored)"""
_PRECISION = "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)"
_RECALL = "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)"
_F1 = "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)"
_CURVE = """per_score AS (
  SELECT score, count(*) FILTER ("isFraud" = 1) AS pos, count(*) FILTER ("isFraud" <> 1) AS neg
  FROM scored GROUP BY score),
curve AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos,
         sum(neg) OVER (ORDER BY score DESC) AS cum_neg
  FROM per_score)"""
_AUROC = "sum(neg * (cum_pos - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg))"
_AUPRC = "sum(pos * cum_pos::DOUBLE / (cum_pos + cum_neg)) / sum(pos)"
_TOP = """top AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, "TransactionID") AS rn,
         count(*) OVER () AS n, sum("isFraud") OVER () AS p
  FROM scored),
at_k AS (
  SELECT k, count(*) FILTER (rn <= k AND "isFraud" = 1)::DOUBLE AS hits,
         any_value(n) AS n, any_value(p) AS p
  FROM top, (VALUES (10), (50), (100), (500)) v(k) GROUP BY k)"""


@query(
    "binarise_scores",
    f"""WITH {SCORED}
    SELECT "TransactionID", CAST(score > 0.5 AS INTEGER) AS flag_50,
           CAST(score > 0.2 AS INTEGER) AS flag_20
    FROM scored""",
)
def binarise_scores(spark, sf):
    return views.scored(spark, sf).select(
        "TransactionID",
        X.binarise(F.col("score")).alias("flag_50"),
        X.binarise(F.col("score"), 0.2).alias("flag_20"),
    )


@query(
    "ensemble_or",
    f"""WITH {TXN}
    SELECT "TransactionID",
           greatest(CAST("TransactionAmt" > 100 AS INTEGER),
                    CAST(CAST(floor("TransactionDT" / 3600) AS BIGINT) % 24 < 6 AS INTEGER))
             AS prediction
    FROM txn""",
)
def ensemble_or(spark, sf):
    return views.transactions(spark, sf).select(
        "TransactionID",
        X.either(
            (F.col("TransactionAmt") > 100).cast("int"),
            (X.hour_of_offset(F.col("TransactionDT")) < 6).cast("int"),
        ).alias("prediction"),
    )


@query("confusion_matrix", f"{_CM} SELECT * FROM cm")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(flagged(spark, sf))


@query(
    "precision_recall_f1",
    f"""{_CM} SELECT round({_PRECISION}, 6) AS precision, round({_RECALL}, 6) AS recall,
    round({_F1}, 6) AS f1 FROM cm""",
)
def precision_recall_f1(spark, sf):
    return rounded(
        metrics.precision_recall_f1(flagged(spark, sf)), "precision", "recall", "f1"
    )


@query(
    "performance_metrics",
    f"""{_CM} SELECT round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 6) AS accuracy,
    round({_PRECISION}, 6) AS precision, round({_RECALL}, 6) AS recall,
    round({_F1}, 6) AS f1_score,
    round(coalesce(fp / nullif(fp + tn, 0)::DOUBLE, 0), 6) AS false_positive_rate FROM cm""",
)
def performance_metrics(spark, sf):
    out = metrics.performance_metrics(flagged(spark, sf))
    return rounded(out, *out.columns)


@query(
    "cost_sensitive",
    f"{_CM} SELECT fn * 10.0::DOUBLE + fp * 1.0::DOUBLE AS cost_sensitive_score FROM cm",
)
def cost_sensitive(spark, sf):
    return metrics.cost_sensitive_score(flagged(spark, sf))


@query(
    "focal_loss",
    f"""WITH {SCORED}, t AS (
      SELECT CASE WHEN "isFraud" = 1 THEN score ELSE 1 - score END AS pt,
             CASE WHEN "isFraud" = 1 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END AS w
      FROM scored),
    c AS (SELECT w, least(greatest(pt, 1e-12::DOUBLE), 1 - 1e-12::DOUBLE) AS pt FROM t)
    SELECT round(avg(-w * pow(1 - pt, 2) * ln(pt)), 6) AS focal_loss FROM c""",
)
def focal_loss(spark, sf):
    return rounded(metrics.focal_loss(views.scored(spark, sf)), "focal_loss")


@query("roc_auc", f"WITH {SCORED}, {_CURVE} SELECT round({_AUROC}, 6) AS auroc FROM curve")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(views.scored(spark, sf)), "auroc")


@query("auprc", f"WITH {SCORED}, {_CURVE} SELECT round({_AUPRC}, 6) AS auprc FROM curve")
def auprc(spark, sf):
    return rounded(metrics.auprc(views.scored(spark, sf)), "auprc")


@query(
    "precision_recall_at_k",
    f"""WITH {SCORED}, {_TOP}
    SELECT k, round(hits / least(k, n), 6) AS precision_at_k, round(hits / p, 6) AS recall_at_k
    FROM at_k""",
)
def precision_recall_at_k(spark, sf):
    return rounded(
        metrics.precision_recall_at_k(views.scored(spark, sf)), "precision_at_k", "recall_at_k"
    )


@query(
    "comprehensive_evaluation",
    f"""{_CM}, {_CURVE}, {_TOP}
    SELECT 'auroc' AS metric, round({_AUROC}, 6) AS value FROM curve
    UNION ALL SELECT 'auprc', round({_AUPRC}, 6) FROM curve
    UNION ALL SELECT 'precision', round({_PRECISION}, 6) FROM cm
    UNION ALL SELECT 'recall', round({_RECALL}, 6) FROM cm
    UNION ALL SELECT 'f1', round({_F1}, 6) FROM cm
    UNION ALL SELECT 'cost_sensitive_score', fn * 10.0::DOUBLE + fp FROM cm
    UNION ALL SELECT 'precision@' || k, round(hits / least(k, n), 6) FROM at_k
    UNION ALL SELECT 'recall@' || k, round(hits / p, 6) FROM at_k""",
)
def comprehensive_evaluation(spark, sf):
    return rounded(metrics.comprehensive_evaluation(views.scored(spark, sf)), "value")


# -- drift --------------------------------------------------------------------------------------

_NUMERIC = ("TransactionID", "TransactionDT", "TransactionAmt", "isFraud")
_KS_FEATURES = ("TransactionAmt", "hour", "early_amount")


def _profile_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, avg("{c}") AS mean, stddev_samp("{c}") AS std,
        CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max,
        median("{c}") AS median FROM {source}"""
        for c in _NUMERIC
    )


_SHIFT = f"""ref AS ({_profile_sql("train")}), cur AS ({_profile_sql("test")}),
shift AS (
  SELECT ref.feature, ref.mean AS ref_mean, ref.std AS ref_std, cur.mean AS cur_mean,
         CASE WHEN ref.std > 0 THEN abs(cur.mean - ref.mean) / ref.std END AS drift_score
  FROM ref JOIN cur ON ref.feature = cur.feature)"""


@query(
    "numeric_profile",
    f"""WITH {TXN}, p AS ({_profile_sql("txn")})
    SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std, min, max,
           round(median, 6) AS median
    FROM p""",
)
def numeric_profile(spark, sf):
    return rounded(
        drift.numeric_profile(views.transactions(spark, sf)), "mean", "std", "median"
    )


@query(
    "drift_mean_shift",
    f"""WITH {SPLIT}, {_SHIFT}
    SELECT feature, round(ref_mean, 6) AS ref_mean, round(ref_std, 6) AS ref_std,
           round(cur_mean, 6) AS cur_mean, round(drift_score, 6) AS drift_score,
           CAST(coalesce(drift_score > 2.0, false) AS INTEGER) AS drifted
    FROM shift""",
)
def drift_mean_shift(spark, sf):
    train, test = train_test(spark, sf)
    out = drift.mean_shift(drift.numeric_profile(train), drift.numeric_profile(test))
    return rounded(out, "ref_mean", "ref_std", "cur_mean", "drift_score")


@query(
    "drift_summary",
    f"""WITH {SPLIT}, {_SHIFT}
    SELECT avg(CAST(coalesce(drift_score > 2.0, false) AS INTEGER)) > 0.3 AS drift_detected,
           round(avg(CAST(coalesce(drift_score > 2.0, false) AS INTEGER)), 6) AS drift_share,
           string_agg(feature, ',' ORDER BY feature) FILTER (drift_score > 2.0)
             AS drifted_features,
           array_to_string(list_slice(list(feature ORDER BY feature) FILTER (drift_score > 2.0), 1, 5), ',')
             AS first_drifted,
           CAST(count(drift_score) AS INTEGER) AS n_scores
    FROM shift""",
)
def drift_summary(spark, sf):
    train, test = train_test(spark, sf)
    return drift.DriftDetector(train).check_drift(test).select(
        "drift_detected",
        r6("drift_share").alias("drift_share"),
        F.array_join("drifted_features", ",").alias("drifted_features"),
        F.array_join("first_drifted", ",").alias("first_drifted"),
        F.size("drift_scores").alias("n_scores"),
    )


def _hours(df: DataFrame, early: bool = False) -> DataFrame:
    """Amount, hour, and a feature that later slices lack."""
    amount = F.col("TransactionAmt")
    return df.select(
        amount,
        X.hour_of_offset(F.col("TransactionDT")).alias("hour"),
        (amount if early else F.lit(None).cast("double")).alias("early_amount"),
    )


_HOUR = 'CAST(floor("TransactionDT" / 3600) AS BIGINT) % 24'
_LONG = f"""long AS (
  SELECT 0 AS side, 'TransactionAmt' AS feature, "TransactionAmt" AS v FROM train
  UNION ALL SELECT 1, 'TransactionAmt', "TransactionAmt" FROM test
  UNION ALL SELECT 0, 'hour', CAST({_HOUR} AS DOUBLE) FROM train
  UNION ALL SELECT 1, 'hour', CAST({_HOUR} AS DOUBLE) FROM test
  UNION ALL SELECT 0, 'early_amount', "TransactionAmt" FROM train
  UNION ALL SELECT 1, 'early_amount', NULL FROM test),
seen AS (
  SELECT feature, count(v) FILTER (side = 0) AS n, count(v) FILTER (side = 1) AS m,
         CASE WHEN count(v) FILTER (side = 0) > 0 AND count(v) FILTER (side = 1) > 0 THEN 'compared'
              WHEN count(v) FILTER (side = 0) > 0 THEN 'no current values'
              WHEN count(v) FILTER (side = 1) > 0 THEN 'no reference values'
              ELSE 'no values' END AS status
  FROM long GROUP BY feature)"""
_ONE_SIDED = "status IN ('no current values', 'no reference values')"


@query(
    "drift_ks",
    f"""WITH {SPLIT}, {_LONG},
    g AS (
      SELECT feature, v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c
      FROM long WHERE v IS NOT NULL GROUP BY feature, v),
    cum AS (
      SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc,
             sum(r) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS m
      FROM g WINDOW w AS (PARTITION BY feature ORDER BY v)),
    d AS (
      SELECT feature, max(abs(cr / n::DOUBLE - cc / m::DOUBLE)) AS d,
             any_value(n)::DOUBLE AS n, any_value(m)::DOUBLE AS m
      FROM cum WHERE n > 0 AND m > 0 GROUP BY feature),
    l AS (SELECT feature, d, d * sqrt(n * m / (n + m)) AS lam FROM d),
    p AS (
      SELECT feature, d, lam,
             CASE WHEN lam < 1e-3 THEN 1.0::DOUBLE ELSE
               least(greatest((SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE
                 END * exp(-2.0::DOUBLE * k * k * lam * lam)) FROM range(1, 101) t(k)), 0), 1)
             END AS p
      FROM l)
    SELECT feature, round(d, 6) AS statistic, round(p, 4) AS p_value,
           CAST(coalesce(p < 0.05, {_ONE_SIDED}) AS INTEGER) AS drifted, status
    FROM seen LEFT JOIN p USING (feature)""",
)
def drift_ks(spark, sf):
    train, test = train_test(spark, sf)
    out = drift.ks_drift(_hours(train, early=True), _hours(test), _KS_FEATURES)
    return rounded(rounded(out, "statistic"), "p_value", places=4)


@query(
    "drift_psi",
    f"""WITH {SPLIT}, {_LONG},
    e AS (
      SELECT feature, unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))
               AS edge
      FROM long WHERE side = 0 GROUP BY feature),
    b AS (
      SELECT feature, side, (SELECT count(*) FROM e
                             WHERE e.feature = long.feature AND round(e.edge, 9) <= long.v) AS bin
      FROM long WHERE v IS NOT NULL),
    g AS (
      SELECT feature, bin, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c
      FROM b GROUP BY feature, bin),
    t AS (SELECT feature, sum(r)::DOUBLE AS n, sum(c)::DOUBLE AS m FROM g GROUP BY feature
          HAVING sum(r) > 0 AND sum(c) > 0),
    f AS (
      SELECT t.feature, greatest(coalesce(r, 0) / n, 1e-4::DOUBLE) AS r,
             greatest(coalesce(c, 0) / m, 1e-4::DOUBLE) AS c
      FROM t CROSS JOIN range(10) k(bin) LEFT JOIN g ON g.feature = t.feature AND g.bin = k.bin)
    , psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM f GROUP BY feature)
    SELECT feature, round(psi, 6) AS psi,
           CAST(coalesce(psi > 0.1, {_ONE_SIDED}) AS INTEGER) AS drifted, status
    FROM seen LEFT JOIN psi USING (feature)""",
)
def drift_psi(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(drift.psi_drift(_hours(train, early=True), _hours(test), _KS_FEATURES), "psi")


@query(
    "monitor_report",
    f"""WITH {SPLIT}, t AS (
      SELECT *, CAST("TransactionAmt" > 100 AS INTEGER) AS y FROM test)
    SELECT 'rule' AS model_name, true AS drift_detected, CAST(4 AS INTEGER) AS n_features,
           round(avg(CAST("isFraud" = y AS INTEGER)), 6) AS accuracy,
           round(avg("TransactionAmt"), 6) AS mean_amount
    FROM t""",
)
def monitor_report(spark, sf):
    """The report on the latest slice, flattened and without its time stamp."""
    train, test = train_test(spark, sf)
    train, test = (
        df.withColumn("y", (F.col("TransactionAmt") > 100).cast("int")) for df in (train, test)
    )
    numeric = list(_NUMERIC)
    monitor = drift.ModelMonitor("rule")
    monitor.set_reference_data(train.select(numeric), train, "isFraud", "y")
    report = monitor.generate_report(test.select(numeric), test, "isFraud", "y")
    amount = F.filter("feature_stats", lambda s: s["feature"] == "TransactionAmt")
    return report.select(
        "model_name",
        F.col("drift_detection.drift_detected").alias("drift_detected"),
        F.size("feature_stats").alias("n_features"),
        r6(F.col("performance.accuracy")).alias("accuracy"),
        r6(F.element_at(amount, 1)["mean"]).alias("mean_amount"),
    )
