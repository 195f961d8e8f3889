"""Canonical views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORIGIN = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def origin_seconds(spark: SparkSession) -> int:
    """The second from which ``TransactionDT`` counts, in session time."""
    return spark.range(1).select(F.unix_seconds(F.lit(ORIGIN).cast("timestamp"))).first()[0]


def _label(event_id, user_id, value):
    limit = F.when(value > 100, F.lit(15)).otherwise(F.lit(1))
    return ((event_id * 7919 + user_id * 104729) % 100 < limit).cast("int")


def events_as_transactions(events: DataFrame) -> DataFrame:
    """Rows of ``events`` (batch or stream) in the shape of card transactions."""
    origin = F.lit(ORIGIN).cast("timestamp")
    return events.select(
        F.col("event_id").alias("TransactionID"),
        (
            F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(origin)
        ).alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        F.col("user_id").cast("string").alias("card1"),
        F.col("event_type").alias("ProductCD"),
        F.concat(F.lit("D"), F.get_json_object("props", "$.k")).alias("DeviceInfo"),
        _label(F.col("event_id"), F.col("user_id"), F.col("value")).alias("isFraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(table(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a rule score amount / (amount + 100) in [0, 1)."""
    amount = F.col("TransactionAmt")
    return transactions(spark, sf_dir).select(
        "TransactionID",
        "TransactionDT",
        "TransactionAmt",
        "isFraud",
        (amount / (amount + 100.0)).alias("score"),
    )


def documents_with_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A wide table and a partly covering one that share the key ``doc_id``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs, table(spark, sf_dir, "labels")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as payments: the payer from ``customer`` and ``nation``, the goods from ``part``."""
    k = F.get_json_object("props", "$.k").cast("int")
    digest = lambda *parts: F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]))
    events = table(spark, sf_dir, "events").withColumn("goods", k)
    payer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    goods = table(spark, sf_dir, "part")
    rows = events.join(payer, F.col("user_id") == F.col("c_custkey"), "left").join(
        goods, F.col("goods") == F.col("p_partkey"), "left"
    )
    device = digest(F.col("user_id"), F.col("p_brand"))
    return rows.select(
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.col("c_name").alias("sender_id"),
        F.col("p_name").alias("receiver_id"),
        F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("source"),
        F.col("p_type").alias("device_os"),
        F.col("p_brand").alias("browser"),
        F.col("c_mktsegment").alias("merchant_category"),
        (F.col("n_regionkey") > 1).alias("is_international"),
        F.col("n_name").alias("country_code"),
        F.substring(digest(F.col("user_id")), 1, 3).alias("zip_code"),
        F.concat_ws(".", *[F.conv(F.substring(device, i, 2), 16, 10) for i in (1, 3, 5, 7)]).alias("ip_address"),
        digest(F.col("user_id"), F.to_date("ts")).alias("session_id"),
        device.alias("device_fingerprint"),
        _label(F.col("event_id"), F.col("user_id"), F.col("value")).alias("fraud_bool"),
    )
