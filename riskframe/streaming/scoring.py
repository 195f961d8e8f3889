"""Scoring of JSON transactions, in batch and on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expressions import binarise
from riskframe.operators.drift import DriftDetector
from riskframe.sources.schemas import FEATURE_OUTPUT, TRANSACTION_INPUT

CORRUPT = "_corrupt_record"


def checked_transactions(df: DataFrame, body: str = "body") -> DataFrame:
    """(body, position, t, error): every object of a JSON text column in the input schema, one read.

    A body is one object or an array of objects. Empty bodies, bad JSON and empty arrays are errors,
    and so are objects whose amount is missing, not a number, or not finite; in an array the other
    objects stay valid. Error rows hold the body, the position of the object in it (0 for a single
    one) and the reason. Works on batch and streaming frames.
    """
    schema = T.StructType(
        [*TRANSACTION_INPUT.fields, T.StructField(CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.trim(F.col(body))
    is_list = F.startswith(text, F.lit("["))
    one = F.from_json(F.when(~is_list, text), schema, options)
    many = F.from_json(F.when(is_list, text), T.ArrayType(TRANSACTION_INPUT))
    # an array that is empty or not valid JSON still yields one row, which becomes an error
    parsed = df.withColumn("_one", one).withColumn("_many", many)
    entries = F.when(is_list, F.when(F.size("_many") > 0, F.col("_many"))).otherwise(
        F.array(F.struct(*[F.col(f"_one.{f.name}").alias(f.name) for f in TRANSACTION_INPUT]))
    )
    # the same objects as text, to tell an amount that isn't a number from one that isn't there
    loose = T.MapType(T.StringType(), T.StringType())
    raw = F.when(is_list, F.from_json(text, T.ArrayType(loose))).otherwise(F.array(F.from_json(text, loose)))
    rows = parsed.select(
        body,
        F.col(f"_one.{CORRUPT}").alias("_bad"),
        is_list.alias("_list"),
        raw.alias("_raw"),
        F.posexplode_outer(entries).alias("position", "t"),
    )
    given = F.get(F.col("_raw"), F.col("position"))["amount"].isNotNull()
    amount = F.col("t.amount")
    error = (
        F.when(F.coalesce(F.length(F.trim(F.col(body))), F.lit(0)) == 0, "empty body")
        .when(F.col("_bad").isNotNull() & ~F.coalesce(given, F.lit(False)), "invalid JSON")
        .when(F.col("_list") & F.col("t").isNull(), "empty or invalid batch")
        .when(amount.isNull() & F.coalesce(given, F.lit(False)), "amount is not a number")
        .when(amount.isNull(), "amount missing")
        .when(F.isnan(amount) | (F.abs(amount) == float("inf")), "amount is not finite")
    )
    return rows.select(body, F.coalesce("position", F.lit(0)).alias("position"), "t", error.alias("error"))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).select("t.*")


def error_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull()).drop("t")


def parse_transactions(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(valid rows in the input schema, error rows) from a JSON text column."""
    checked = checked_transactions(df, body)
    return valid_rows(checked), error_rows(checked)


Scorer = Callable[[DataFrame], DataFrame]


def rule_score(amount: Column) -> Column:
    return amount / (amount + 100.0)


def rule_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("fraud_probability", rule_score(F.col("amount")))


def score_transactions(df: DataFrame, scorer: Scorer, threshold: float = 0.5) -> DataFrame:
    """Rows in the output schema; ``scorer`` adds fraud_probability."""
    return (
        scorer(df)
        .withColumn("is_fraud", binarise(F.col("fraud_probability"), threshold) == 1)
        .withColumn("threshold", F.lit(float(threshold)))
        .select(*[F.col(f.name).cast(f.dataType) for f in FEATURE_OUTPUT])
    )


class OutcomeSink:
    """Scored rows and error rows of a JSON stream, from one read of each micro-batch.

    Both go into one folder per batch id by one write, so neither is seen without the other; a batch
    that failed and is run again replaces both. ``scorer`` sees valid rows only.
    """

    def __init__(self, spark: SparkSession, path: str, scorer: Scorer, threshold: float = 0.5, body: str = "body"):
        self.spark, self.path = spark, path.rstrip("/")
        self.scorer, self.threshold, self.body = scorer, threshold, body

    def process(self, batch: DataFrame, batch_id: int) -> None:
        checked = checked_transactions(batch, self.body).persist()  # parsed once, read by both outputs
        try:
            scored = score_transactions(valid_rows(checked), self.scorer, self.threshold)
            both = scored.withColumn("outcome", F.lit("scored")).unionByName(
                error_rows(checked).withColumn("outcome", F.lit("error")), allowMissingColumns=True
            )
            both.write.mode("overwrite").partitionBy("outcome").parquet(f"{self.path}/data/batch_id={batch_id}")
        finally:
            checked.unpersist()

    def run(self, stream: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Process what the source has; (scored rows, error rows) of all batches so far."""
        query = (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self.outcomes()

    def outcomes(self) -> tuple[DataFrame, DataFrame]:
        found = [T.StructField(self.body, T.StringType()), T.StructField("position", T.IntegerType()), T.StructField("error", T.StringType())]
        kept = [T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())]
        schema = T.StructType([*FEATURE_OUTPUT.fields, *found, *kept])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data")
        columns = [f.name for f in FEATURE_OUTPUT]
        return (
            rows.where(F.col("outcome") == "scored").select(*columns),
            rows.where(F.col("outcome") == "error").select(self.body, "position", "error"),
        )


def run_to_parquet(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process all available input into Parquet files and return them as a batch frame.

    The sink and its checkpoint lie in shared storage: a restarted query goes on exactly once.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


def prediction_counts(
    scored: DataFrame, time: str = "ts", window: str = "1 hour", delay: str = "1 hour", key: str | None = None
) -> DataFrame:
    """Predictions per window and outcome; rows later than the watermark are dropped.

    With ``key``, a row that arrives again (same key and time) counts once. What is known of a key
    is forgotten once the watermark has passed it, since from then on its copies are late.
    """
    marked = scored.withWatermark(time, delay)
    if key is not None:
        marked = marked.dropDuplicates([key, time])
    return (
        marked
        .groupBy(F.window(time, window).alias("w"), "is_fraud")
        .agg(F.count(F.lit(1)).alias("predictions"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "is_fraud",
            "predictions",
        )
    )


def run_drift_checks(stream: DataFrame, detector: DriftDetector, path: str) -> DataFrame:
    """Mean-shift scores of every micro-batch, one folder per batch, so retries overwrite."""
    spark = stream.sparkSession

    def check(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()  # profiled by several aggregates
        try:
            if not rows.isEmpty():
                detector.drift_scores(rows).write.mode("overwrite").parquet(
                    f"{path}/data/batch_id={batch_id}"
                )
        finally:
            rows.unpersist()

    query = (
        stream.writeStream.foreachBatch(check)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/data")
