"""Queries: streams whose rows come in several deliveries, some late, some twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import drift
from riskframe.plans.base import SPLIT, query, rounded
from riskframe.plans.data import train_test
from riskframe.plans.detectors import events_as_json
from riskframe.session import scratch_path
from riskframe.sources import views
from riskframe.streaming import scoring

DELIVERIES, DAYS = 4, 8
_SLICE = f"least({DELIVERIES - 1}, greatest(0, CAST(date_diff('day', TIMESTAMP '2024-01-01', CAST(ts AS TIMESTAMP)) // {DAYS} AS INTEGER)))"


def slice_of(events: DataFrame):
    """Number of the delivery that an event's day belongs to."""
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    return F.least(F.lit(DELIVERIES - 1), F.greatest(F.lit(0), F.floor(day / DAYS).cast("int")))


def deliveries(spark, rows: DataFrame, run) -> DataFrame:
    """``run(stream)`` after each delivery of ``rows`` (column ``at``): the query stops in between
    and goes on from its checkpoint. Returns what the last run returned."""
    source, found = scratch_path(spark, "deliveries"), None
    schema = rows.drop("at").schema
    for i in range(DELIVERIES):
        rows.where(F.col("at") == i).drop("at").write.mode("append").parquet(source)
        found = run(spark.readStream.schema(schema).parquet(source))
    return found


_ERRORS = """CASE event_id % 50 WHEN 1 THEN 'empty body' WHEN 2 THEN 'invalid JSON'
             WHEN 3 THEN 'empty or invalid batch' ELSE 'amount missing' END"""


@query(
    "score_stream_outcomes",
    f"""SELECT 'tx_' || event_id AS transaction_id, round(value / (value + 100.0::DOUBLE), 6) AS fraud_probability,
           value / (value + 100.0::DOUBLE) > 0.5 AS is_fraud, NULL AS error
    FROM (SELECT *, unnest(range(CASE WHEN event_id % 50 = 5 THEN 2 ELSE 1 END)) AS i FROM events)
    WHERE event_id % 50 NOT IN (1, 2, 3, 4)
    UNION ALL SELECT NULL, NULL, NULL, {_ERRORS} FROM events WHERE event_id % 50 IN (1, 2, 3, 4)""",
)
def score_stream_outcomes(spark, sf):
    """Scored rows and error rows of a JSON stream in four deliveries, from one read of each."""
    events = views.table(spark, sf, "events")
    bodies = events_as_json(events.withColumn("ts", F.col("ts").cast("timestamp")))
    rows = bodies.withColumn("at", slice_of(bodies))
    sink = scoring.OutcomeSink(spark, scratch_path(spark, "outcomes"), scoring.rule_scorer)
    scored, errors = deliveries(spark, rows, sink.run)
    both = scored.drop("threshold").unionByName(errors.select("error"), allowMissingColumns=True)
    return rounded(both, "fraud_probability")


@query(
    "stream_late_counts",
    f"""WITH e AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, value, {_SLICE} AS slice FROM events),
    d AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN least({DELIVERIES - 1}, slice + 1) ELSE slice END AS at FROM e
          UNION ALL SELECT *, {DELIVERIES - 1} FROM e WHERE event_id % 11 = 0),
    m AS (SELECT i AS at, date_trunc('milliseconds', (SELECT max(ts) FROM d WHERE d.at < i)) - INTERVAL 2 DAY AS mark
          FROM range({DELIVERIES}) r(i)),
    kept AS (SELECT DISTINCT event_id, ts, value FROM d JOIN m ON d.at = m.at WHERE mark IS NULL OR ts > mark),
    last AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY AS mark FROM e)
    SELECT CAST(date_diff('second', TIMESTAMP '1970-01-01', date_trunc('hour', ts)) AS BIGINT) AS window_start,
           value / (value + 100.0::DOUBLE) > 0.5 AS is_fraud, CAST(count(*) AS BIGINT) AS predictions
    FROM kept, last WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY 1, 2""",
)
def stream_late_counts(spark, sf):
    """Counts per hour of four deliveries: a seventh of the rows comes one delivery late, an eleventh
    comes again in the last. Rows behind the watermark (two days) are dropped, others count once."""
    events = views.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), (scoring.rule_score(F.col("value")) > 0.5).alias("is_fraud")
    )
    own = slice_of(events)
    late = F.when(F.col("event_id") % 7 == 0, F.least(F.lit(DELIVERIES - 1), own + 1)).otherwise(own)
    again = events.where(F.col("event_id") % 11 == 0).withColumn("at", F.lit(DELIVERIES - 1))
    rows = events.withColumn("at", late).unionByName(again)
    path = scratch_path(spark, "late-counts")
    out = deliveries(
        spark, rows, lambda s: scoring.run_to_parquet(scoring.prediction_counts(s, delay="2 days", key="event_id"), path)
    )
    return out.select(F.unix_seconds("window_start").alias("window_start"), "is_fraud", "predictions")


@query(
    "stream_drift_batches",
    f"""WITH {SPLIT}, r AS (SELECT avg("TransactionAmt") AS mean, stddev_samp("TransactionAmt") AS std FROM train),
    e AS (SELECT value * (1 + 2 * {_SLICE}) AS amount, {_SLICE} AS slice FROM events),
    s AS (SELECT slice, abs(avg(amount) - any_value(mean)) / any_value(std) AS score FROM e, r GROUP BY slice)
    SELECT CAST(row_number() OVER (ORDER BY slice) - 1 AS INTEGER) AS batch_id, round(score, 6) AS drift_score,
           CAST(score > {drift.MEAN_SHIFT} AS INTEGER) AS drifted
    FROM s""",
)
def stream_drift_batches(spark, sf):
    """Drift of four micro-batches whose amounts grow from one to the next."""
    train, _ = train_test(spark, sf)
    detector = drift.DriftDetector(train.select("TransactionAmt"))
    events = views.table(spark, sf, "events")
    at = slice_of(events)
    rows = events.select((F.col("value") * (1 + 2 * at)).alias("TransactionAmt"), at.alias("at"))
    path = scratch_path(spark, "drift-batches")
    out = deliveries(spark, rows, lambda s: scoring.run_drift_checks(s, detector, path))
    return rounded(out.select(F.col("batch_id").cast("int").alias("batch_id"), "drift_score", "drifted"), "drift_score")
