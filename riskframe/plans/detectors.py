"""Queries: fitted detectors, JSON scoring, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators import drift, metrics, models, splits, stress
from riskframe.operators.features import FeatureEngineer, apply_codes, category_table
from riskframe.operators.forest import IsolationForest
from riskframe.plans.base import SPLIT, query, rounded
from riskframe.plans.data import train_test
from riskframe.session import balanced, materialise, scratch_path
from riskframe.sources import views
from riskframe.sources.payments import split_payments
from riskframe.sources.schemas import TRANSACTION_INPUT
from riskframe.streaming import scoring

KEY, LABEL, P = "TransactionID", "isFraud", models.PROBABILITY
FLOOR = 0.6  # area under the curve that a fitted detector must pass on later data

_FITTED: dict[tuple, tuple] = {}


def matrices(spark, sf) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, features): both slices prepared with what the training slice taught."""
    train, test = train_test(spark, sf)
    engineer = FeatureEngineer().fit(train)
    ready = [
        balanced(
            materialise(
                engineer.prepare_for_model(engineer.transform(df), keep=(KEY, LABEL)), "prepared"
            )
        )
        for df in (train, test)
    ]
    return ready[0], ready[1], engineer.state.features


def fitted(spark, sf):
    """(model, train, test, features) of boosted trees at full settings, fitted once per session."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        train, test, features = matrices(spark, sf)
        _FITTED[at] = models.BoostedTrees().fit(train, features), train, test, features
    return _FITTED[at]


def judged(scored: DataFrame, score: str = P) -> DataFrame:
    """Per class: rows, probabilities inside [0, 1], and whether the ranking passes the floor
    (NULL below 50 frauds, where the area says little)."""
    scored = materialise(scored.select(LABEL, score), "judged")
    area = metrics.roc_auc(scored, LABEL, score).select("auroc").scalar()
    frauds = scored.agg(F.count_if(F.col(LABEL) == 1)).scalar()
    return scored.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(score).between(0.0, 1.0)).alias("n_valid")
    ).withColumn("above_floor", F.when(frauds >= 50, area > FLOOR))


_JUDGED = f"""WITH {SPLIT}
    SELECT "isFraud", CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_valid,
           CASE WHEN (SELECT count(*) FROM test WHERE "isFraud" = 1) >= 50 THEN true END AS above_floor
    FROM test GROUP BY 1"""


@query("gbt_scores", _JUDGED)
def gbt_scores(spark, sf):
    """Boosted trees on the latest slice: every row has a probability, fraud ranks higher."""
    model, _, test, _ = fitted(spark, sf)
    return judged(model.score(test))


@query(
    "feature_importance",
    """SELECT CAST(11 AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS total, true AS falling,
              CAST(5 AS BIGINT) AS n_top""",
)
def feature_importance(spark, sf):
    """Importances sum to 1 and fall; the best five come first."""
    model, *_ = fitted(spark, sf)
    rows = model.feature_importance(spark).agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("total"),
        F.collect_list("importance").alias("x"),
    )
    top = model.feature_importance(spark, 5)
    return rows.select(
        "n_features", "total", (F.col("x") == F.reverse(F.array_sort("x"))).alias("falling"),
        top.agg(F.count(F.lit(1))).scalar().alias("n_top"),
    )


@query(
    "model_roundtrip",
    f"""WITH {SPLIT}
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS max_difference FROM test""",
)
def model_roundtrip(spark, sf):
    """Largest difference between the scores of a model and of its stored copy."""
    model, _, test, _ = fitted(spark, sf)
    path = scratch_path(spark, "model")
    model.save(path, spark)
    again = models.BoostedModel.load(path, spark)
    both = again.score(model.score(test, "p_before"), "p_after")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.max(F.abs(F.col("p_before") - F.col("p_after"))), 5).alias("max_difference"),
    )


@query(
    "isolation_forest_flags",
    f"""WITH {SPLIT}, legit AS (SELECT count(*) AS n FROM train WHERE "isFraud" = 0)
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM test) AS n_test,
           (SELECT CAST(count(*) AS BIGINT) FROM test) AS n_valid,
           n AS n_legit, true AS share_is_met
    FROM legit""",
)
def isolation_forest_flags(spark, sf):
    """Scores lie in (0, 1); on the rows learnt from, the flagged share is the contamination."""
    train, test, features = matrices(spark, sf)
    legit, rate = train.where("isFraud = 0"), 0.035
    forest = IsolationForest(contamination=rate).fit(legit, features)
    flagged, own = forest.flag(test), materialise(forest.flag(legit), "flags")
    tied = own.where(F.col("anomaly_score") == forest.threshold).count()
    on_legit = own.agg(F.count(F.lit(1)).alias("n_legit"), F.sum("if_flag").alias("flags"))
    valid = F.count_if((F.col("anomaly_score") > 0) & (F.col("anomaly_score") < 1) & F.col("if_flag").isin(0, 1))
    return flagged.agg(F.count(F.lit(1)).alias("n_test"), valid.alias("n_valid")).select(
        "n_test", "n_valid", on_legit.select("n_legit").scalar().alias("n_legit"),
        (F.abs(on_legit.select("flags").scalar() - rate * on_legit.select("n_legit").scalar()) <= 1 + tied).alias("share_is_met"),
    )


@query(
    "ensemble_flags",
    f"""WITH {SPLIT}
    SELECT "TransactionID", "isFraud", CAST(0 AS INTEGER) AS off FROM test""",
)
def ensemble_flags(spark, sf):
    """Per row, how far the prediction is from the OR of both flags."""
    train, test, features = matrices(spark, sf)
    detector = models.EnsembleDetector().fit(train, features)
    either = F.greatest("if_flag", (F.col(P) > 0.5).cast("int"))
    return detector.predict(test).select(KEY, LABEL, F.abs(F.col("prediction") - either).alias("off"))


@query(
    "explain_scores",
    f"""WITH {SPLIT}
    SELECT "TransactionID", CAST(3 AS INTEGER) AS n_reasons, CAST(0 AS DOUBLE) AS first_gap,
           true AS falling
    FROM test""",
)
def explain_scores(spark, sf):
    """Three reasons per row, largest first; the first equals a rescoring of its own."""
    model, train, test, features = fitted(spark, sf)
    detector = models.EnhancedDetector()
    detector.model, detector.feature_names = model, features
    detector.learn_medians(train)
    rows = materialise(detector.predict_with_explanation(test, 3), "explained")
    first = F.col("explanation")[0]
    swapped = rows.withColumns({
        c: F.when(first["feature"] == c, F.lit(detector.medians[c])).otherwise(F.col(c).cast("double")) for c in features
    })
    again = model.score(swapped, "_again")
    size = F.transform("explanation", lambda e: F.abs(e["delta"]))
    return again.select(
        KEY, F.size("explanation").alias("n_reasons"),
        F.round(F.abs(first["delta"] - (F.col(P) - F.col("_again"))), 9).alias("first_gap"),
        (size == F.reverse(F.array_sort(size))).alias("falling"),
    )


@query("graph_scores", _JUDGED)
def graph_scores(spark, sf):
    train, test = train_test(spark, sf)
    return judged(models.GraphDetector().fit(train).predict_proba(test))


@query("sequence_scores", _JUDGED)
def sequence_scores(spark, sf):
    train, test = train_test(spark, sf)
    return judged(models.SequenceDetector().fit(train).predict_proba(test, train))


@query("hybrid_scores", _JUDGED)
def hybrid_scores(spark, sf):
    train, validation, test = splits.temporal_train_test_split(
        views.transactions(spark, sf), validation_size=0.2
    )
    detector = models.HybridDetector(models.GraphDetector(), models.SequenceDetector())
    detector.fit(train, validation)
    return judged(detector.predict_proba(test, train.unionByName(validation)))


@query(
    "tune_gbt",
    """SELECT CAST(i AS INTEGER) AS trial, true AS in_range, true AS best_is_highest
       FROM range(10) t(i)""",
)
def tune_gbt(spark, sf):
    """Ten trials over the payments features, judged on a later slice."""
    (train, validation, _), features = split_payments(views.payments(spark, sf), 0.2)
    best, trials = models.ParameterSearch().run(train, validation, features, "fraud_bool")
    area = metrics.roc_auc(best.score(validation), "fraud_bool", P).first()["auroc"]
    top = trials.agg(F.max("score")).scalar()
    low, high = models.SEARCH["step_size"]
    return trials.select(
        "trial", F.col("step_size").between(low, high).alias("in_range"),
        (F.abs(top - F.lit(0.5 if area is None else area)) < 1e-9).alias("best_is_highest"),
    )


@query(
    "evasion_of_model",
    f"""WITH {SPLIT}, f AS (SELECT CAST(count(*) AS BIGINT) AS n FROM test WHERE "isFraud" = 1)
    SELECT 5 * n AS attempts, true AS rates_are_shares FROM f""",
)
def evasion_of_model(spark, sf):
    """Evasion rates against a fitted detector; amounts are re-derived after each change."""
    train, test = train_test(spark, sf)
    engineer = FeatureEngineer().fit(train, with_codes=False)
    names = ["TransactionAmt", "amount_log", "amount_decimal", "amount_vs_mean",
             "amount_vs_median", "hour"]
    model = models.BoostedTrees().fit(engineer.transform(train).fillna(-999.0), names)
    frauds = engineer.transform(test).where("isFraud = 1").select(KEY, "TransactionAmt", "hour")

    def score(df: DataFrame) -> DataFrame:
        return model.score(engineer.transform(df).fillna(-999.0), "score")

    rates = stress.evasion(frauds, score, threshold=0.5)
    share = F.coalesce(F.col("evasion_rate"), F.lit(0.0)).between(0.0, 1.0)
    return rates.agg(
        F.sum("attempts").alias("attempts"), F.min(share).alias("rates_are_shares")
    )


# -- JSON scoring -------------------------------------------------------------------------------


def payloads(spark, sf) -> DataFrame:
    """``events`` as JSON bodies: single objects, batches, and every kind of broken body."""
    return events_as_json(views.table(spark, sf, "events"))


def events_as_json(events: DataFrame) -> DataFrame:
    record = F.struct(
        F.concat(F.lit("tx_"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("source"),
        F.lit("Electronics").alias("merchant_category"),
    )
    kind = F.col("event_id") % 50
    body = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit("invalid json"))
        .when(kind == 3, F.lit("[]"))
        .when(kind == 4, F.to_json(record.dropFields("amount")))
        .when(kind == 5, F.to_json(F.array(record, record)))
        .otherwise(F.to_json(record))
    )
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), body.alias("body"))


_VALID = """v AS (
  SELECT 'tx_' || event_id AS transaction_id, value / (value + 100.0::DOUBLE) AS p,
         unnest(range(CASE WHEN event_id % 50 = 5 THEN 2 ELSE 1 END)) AS i
  FROM events WHERE event_id % 50 NOT IN (1, 2, 3, 4))"""
_SCORE_SQL = f"""WITH {_VALID}
    SELECT transaction_id, round(p, 6) AS fraud_probability, p > 0.5 AS is_fraud,
           CAST(0.5 AS DOUBLE) AS threshold
    FROM v"""


@query("score_json_batch", _SCORE_SQL)
def score_json_batch(spark, sf):
    valid, _ = scoring.parse_transactions(payloads(spark, sf))
    return rounded(scoring.score_transactions(valid, scoring.rule_scorer), "fraud_probability")


@query(
    "score_json_errors",
    """SELECT CASE event_id % 50 WHEN 1 THEN 'empty body' WHEN 2 THEN 'invalid JSON'
                WHEN 3 THEN 'empty or invalid batch' ELSE 'amount missing' END AS error,
              CAST(count(*) AS BIGINT) AS bodies
       FROM events WHERE event_id % 50 IN (1, 2, 3, 4) GROUP BY 1""",
)
def score_json_errors(spark, sf):
    _, errors = scoring.parse_transactions(payloads(spark, sf))
    return errors.groupBy("error").agg(F.count(F.lit(1)).alias("bodies"))


@query(
    "score_json_model",
    f"WITH {_VALID} SELECT transaction_id, true AS valid, CAST(0.2 AS DOUBLE) AS threshold FROM v",
)
def score_json_model(spark, sf):
    """JSON bodies scored on all their fields by boosted trees fitted on the training slice."""
    train, _ = train_test(spark, sf)
    kinds, strings = {f.name: f.dataType for f in TRANSACTION_INPUT}, ["source", "device_os", "merchant_category"]
    known = {
        "amount": F.col("TransactionAmt"),
        "source": F.col("ProductCD"),
        "device_os": F.col("DeviceInfo"),
        "hour_of_day": X.hour_of_offset(F.col("TransactionDT")),
    }
    fields = ["amount", "source", "device_os", "merchant_category", "is_international", "hour_of_day"]
    rows = materialise(
        train.select(LABEL, *[known.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in fields]), "payload-rows"
    )
    codes, sizes = category_table(rows, strings)

    def matrix(df: DataFrame) -> DataFrame:
        coded = apply_codes(df, codes, strings, sizes)
        return coded.withColumns({
            "amount_log": X.amount_log(F.col("amount")),
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(-999.0)) for c in fields},
        })

    model = models.BoostedTrees().fit(matrix(rows), [*fields, "amount_log"])
    valid, _ = scoring.parse_transactions(payloads(spark, sf))
    out = scoring.score_transactions(valid, lambda df: model.score(matrix(df)), 0.2)
    p = F.col("fraud_probability")
    return out.select(
        "transaction_id", (p.between(0.0, 1.0) & (F.col("is_fraud") == (p > 0.2))).alias("valid"), "threshold"
    )


# -- streams ------------------------------------------------------------------------------------


def event_stream(spark, sf) -> DataFrame:
    schema = views.table(spark, sf, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 100)
        .parquet(sf)
    )


@query("score_stream", _SCORE_SQL)
def score_stream(spark, sf):
    valid, _ = scoring.parse_transactions(events_as_json(event_stream(spark, sf)))
    scored = scoring.score_transactions(valid, scoring.rule_scorer)
    out = scoring.run_to_parquet(scored, scratch_path(spark, "score-stream"))
    return rounded(out, "fraud_probability")


@query(
    "score_stream_features",
    f"""WITH {SPLIT}, s AS (SELECT avg("TransactionAmt") AS mean FROM train)
    SELECT "TransactionID", round("TransactionAmt" / mean, 6) AS amount_vs_mean,
           CAST(floor("TransactionDT" / 3600) AS BIGINT) % 24 AS hour
    FROM txn, s""",
)
def score_stream_features(spark, sf):
    """Features fitted on a batch and applied to the stream."""
    train, _ = train_test(spark, sf)
    engineer = FeatureEngineer().fit(train, with_codes=False)
    rows = engineer.transform(views.events_as_transactions(event_stream(spark, sf)))
    out = scoring.run_to_parquet(
        rows.select(KEY, "amount_vs_mean", "hour"), scratch_path(spark, "feature-stream")
    )
    return rounded(out, "amount_vs_mean")


@query(
    "stream_prediction_counts",
    """WITH w AS (
      SELECT date_trunc('hour', ts) AS start, value / (value + 100.0::DOUBLE) > 0.5 AS is_fraud,
             max(ts) OVER () AS latest
      FROM events)
    SELECT CAST(date_diff('second', TIMESTAMP '1970-01-01', start) AS BIGINT) AS window_start,
           is_fraud, CAST(count(*) AS BIGINT) AS predictions
    FROM w WHERE start + INTERVAL 1 HOUR <= latest - INTERVAL 1 HOUR
    GROUP BY start, is_fraud""",
)
def stream_prediction_counts(spark, sf):
    """Counts of the closed windows only: a window that is still open is not emitted."""
    rows = event_stream(spark, sf).select(
        F.col("ts").cast("timestamp").alias("ts"),
        (scoring.rule_score(F.col("value")) > 0.5).alias("is_fraud"),
    )
    out = scoring.run_to_parquet(
        scoring.prediction_counts(rows), scratch_path(spark, "count-stream")
    )
    return out.select(
        F.unix_seconds("window_start").alias("window_start"), "is_fraud", "predictions"
    )


@query(
    "stream_drift",
    f"""WITH {SPLIT}
    SELECT 'TransactionAmt' AS feature,
           round(abs((SELECT avg("TransactionAmt") FROM txn) - avg("TransactionAmt"))
                 / stddev_samp("TransactionAmt"), 6) AS drift_score,
           CAST(0 AS INTEGER) AS drifted
    FROM train""",
)
def stream_drift(spark, sf):
    """Each micro-batch against the training slice (the test table is one file: one batch)."""
    train, _ = train_test(spark, sf)
    detector = drift.DriftDetector(train.select("TransactionAmt"))
    rows = views.events_as_transactions(event_stream(spark, sf)).select("TransactionAmt")
    out = scoring.run_drift_checks(rows, detector, scratch_path(spark, "drift-stream"))
    return rounded(out.select("feature", "drift_score", "drifted"), "drift_score")
