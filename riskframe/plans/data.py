"""Queries: scans, joins, quality profile, features, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import quality, splits
from riskframe.operators.features import FeatureEngineer, fit_amount_stats
from riskframe.plans.base import MERGED, SPLIT, TXN, query, rounded
from riskframe.session import scratch_path, spread
from riskframe.sources import layout, views
from riskframe.sources.payments import prepare_payments
from riskframe.sources.transactions import TransactionLoader, left_merge


def merged_documents(spark: SparkSession, sf: str) -> DataFrame:
    return left_merge(*views.documents_with_labels(spark, sf), "doc_id")


def train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both slices of the transactions, read evenly also where the table lies in one row group."""
    return splits.temporal_train_test_split(spread(views.transactions(spark, sf), "transactions"))


@query(
    "split_by_day",
    f"""WITH {SPLIT}
    SELECT "TransactionID", 'train' AS part FROM train
    UNION ALL SELECT "TransactionID", 'test' FROM test""",
)
def split_by_day(spark, sf):
    """The split by time, over events stored by day: each part reads the days it needs."""
    path = scratch_path(spark, "days")
    layout.write_by_day(views.table(spark, sf, "events"), path, "ts", "event_id")
    train, test = layout.split_by_time(
        spark.read.parquet(path), "ts", views.events_as_transactions, views.origin_seconds(spark)
    )
    part = lambda df, name: df.select("TransactionID", F.lit(name).alias("part"))
    return part(train, "train").unionByName(part(test, "test"))


@query("scan_transactions", f"WITH {TXN} SELECT * FROM txn")
def scan_transactions(spark, sf):
    return views.transactions(spark, sf)


@query(
    "load_transactions",
    f"""WITH {TXN}
    SELECT t."TransactionID", t."TransactionDT", t."TransactionAmt", t."ProductCD", t."isFraud",
           l.quality, l.toxic
    FROM txn t LEFT JOIN labels l ON t."TransactionID" = l.doc_id""",
)
def load_transactions(spark, sf):
    """The given tables written as a CSV pair and read back through the loader."""
    folder = scratch_path(spark, "csv")
    views.transactions(spark, sf).write.csv(f"{folder}/train_transaction.csv", header=True)
    identity = views.table(spark, sf, "labels").withColumnRenamed("doc_id", "TransactionID")
    identity.write.csv(f"{folder}/train_identity.csv", header=True)
    return TransactionLoader(spark, folder).load().select(
        "TransactionID",
        "TransactionDT",
        "TransactionAmt",
        "ProductCD",
        "isFraud",
        F.col("quality").cast("int").alias("quality"),
        F.col("toxic").cast("int").alias("toxic"),
    )


@query("merge_identity", f"WITH {MERGED} SELECT * FROM merged")
def merge_identity(spark, sf):
    return merged_documents(spark, sf)


@query(
    "label_summary",
    f"""WITH {TXN}
    SELECT CAST(sum("isFraud") AS BIGINT) AS fraud_count,
           round(avg("isFraud"), 6) AS fraud_rate
    FROM txn""",
)
def label_summary(spark, sf):
    return rounded(quality.label_summary(views.transactions(spark, sf)), "fraud_rate")


_TXN_MISSING = ", ".join(
    f'1 - count("{c}") / count(*)'
    for c in ("TransactionID", "TransactionDT", "TransactionAmt", "card1", "ProductCD", "DeviceInfo", "isFraud")
)


@query(
    "quality_report",
    f"""WITH {TXN}, s AS (
      SELECT CAST(count(*) AS DOUBLE) AS n, avg("isFraud") AS rate,
             CAST(count(*) - count(DISTINCT "TransactionID") AS DOUBLE) AS dupes
      FROM txn)
    SELECT 'rows' AS check_name, n AS value, 'ok' AS status FROM s
    UNION ALL SELECT 'columns', CAST(max(json_array_length(json_keys(to_json(txn)))) AS DOUBLE), 'ok' FROM txn
    UNION ALL SELECT 'high_missing_columns', CAST(sum(CAST(share > 0.5 AS INTEGER)) AS DOUBLE),
      CASE WHEN max(share) > 0.5 THEN 'warning' ELSE 'ok' END
      FROM (SELECT unnest([{_TXN_MISSING}]) AS share FROM txn)
    UNION ALL SELECT 'label_rate', round(rate, 6),
      CASE WHEN rate < 0.01 OR rate > 0.5 THEN 'warning' ELSE 'ok' END FROM s
    UNION ALL SELECT 'duplicates', dupes, CASE WHEN dupes > 0 THEN 'warning' ELSE 'ok' END FROM s
    """,
)
def quality_report(spark, sf):
    return rounded(quality.quality_report(views.transactions(spark, sf)), "value")


@query(
    "duplicate_count",
    "SELECT CAST(count(*) - count(DISTINCT o_custkey) AS BIGINT) AS duplicates FROM orders",
)
def duplicate_count(spark, sf):
    return quality.duplicate_count(views.table(spark, sf, "orders"), "o_custkey")


_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
    f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM merged"
    for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
)


@query("missing_profile", f"WITH {MERGED} {_MISSING_SQL}")
def missing_profile(spark, sf):
    return rounded(quality.missing_profile(merged_documents(spark, sf)), "missing_pct")


@query(
    "high_missing",
    f"""WITH {MERGED}, p AS ({_MISSING_SQL})
    SELECT * FROM p WHERE missing_pct > 50 ORDER BY missing_pct DESC, column_name LIMIT 10""",
)
def high_missing(spark, sf):
    return rounded(quality.high_missing(merged_documents(spark, sf)), "missing_pct")


@query(
    "basic_stats",
    f"""WITH {MERGED}
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(7 AS BIGINT) AS n_columns,
           CAST(sum(toxic) AS BIGINT) AS fraud_count, round(avg(toxic), 6) AS fraud_rate,
           CAST(7 * count(*) - count(doc_id) - count(text) - count(lang) - count(source) - count(n_chars)
                - count(quality) - count(toxic) AS BIGINT) AS missing_total,
           CAST((count(doc_id) < count(*))::INT + (count(text) < count(*))::INT + (count(lang) < count(*))::INT
              + (count(source) < count(*))::INT + (count(n_chars) < count(*))::INT
              + (count(quality) < count(*))::INT + (count(toxic) < count(*))::INT AS BIGINT)
             AS columns_with_missing
    FROM merged""",
)
def basic_stats(spark, sf):
    return rounded(quality.basic_stats(merged_documents(spark, sf), "toxic"), "fraud_rate")


@query(
    "dtype_counts",
    """SELECT CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                ELSE lower(column_type) END AS data_type,
              CAST(count(*) AS BIGINT) AS n_columns
       FROM (DESCRIBE SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       GROUP BY 1""",
)
def dtype_counts(spark, sf):
    return quality.dtype_counts(merged_documents(spark, sf))


@query(
    "sample_exact",
    f"""WITH {TXN}, h AS (
      SELECT *, CAST('0x' || substr(md5("TransactionID"::VARCHAR || '|42'), 1, 13) AS BIGINT) AS h,
             count(*) OVER () AS n
      FROM txn),
    r AS (SELECT *, row_number() OVER (ORDER BY h, "TransactionID") AS rn FROM h)
    SELECT "TransactionID", "TransactionAmt" FROM r
    WHERE rn <= round_even(0.1::DOUBLE * n, 0)""",
)
def sample_exact(spark, sf):
    sample = quality.sample_exact(views.transactions(spark, sf), 0.1, portable=True)
    return sample.select("TransactionID", "TransactionAmt")


@query("sample_bernoulli")
def sample_bernoulli(spark, sf):
    return quality.sample_bernoulli(views.transactions(spark, sf), 0.1)


# -- splits -------------------------------------------------------------------------------------


def _labelled(parts: dict[str, DataFrame], key: str) -> DataFrame:
    frames = [df.select(key, F.lit(name).alias("split")) for name, df in parts.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query(
    "temporal_split",
    f"""WITH {SPLIT}
    SELECT "TransactionID", 'train' AS split FROM train
    UNION ALL SELECT "TransactionID", 'test' FROM test""",
)
def temporal_split(spark, sf):
    train, test = train_test(spark, sf)
    return _labelled({"train": train, "test": test}, "TransactionID")


@query(
    "temporal_split_3way",
    """WITH r AS (
      SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
             count(*) OVER () AS n
      FROM orders)
    SELECT o_orderkey,
           CASE WHEN rn <= trunc(n * (1 - 0.2::DOUBLE - 0.1::DOUBLE)) THEN 'train'
                WHEN rn <= trunc(n * (1 - 0.2::DOUBLE)) THEN 'validation'
                ELSE 'test' END AS split
    FROM r""",
)
def temporal_split_3way(spark, sf):
    orders = views.table(spark, sf, "orders")
    train, validation, test = splits.temporal_train_test_split(
        orders, "o_orderdate", 0.2, 0.1, "o_orderkey"
    )
    return _labelled({"train": train, "validation": validation, "test": test}, "o_orderkey")


@query(
    "walk_forward",
    f"""WITH {TXN}, r AS (
      SELECT "TransactionID",
             row_number() OVER (ORDER BY "TransactionDT", "TransactionID") - 1 AS pos,
             count(*) OVER () AS n
      FROM txn),
    c AS (SELECT DISTINCT n, CAST(trunc(n * 0.2::DOUBLE) AS BIGINT) AS test_n FROM r),
    s AS (
      SELECT i AS split_id, n - (5 - i - 1) * (test_n // 5) AS e,
             n - (5 - i - 1) * (test_n // 5) - test_n AS b
      FROM c, range(5) t(i))
    SELECT CAST(split_id AS INTEGER) AS split_id,
           CASE WHEN pos < b THEN 'train' ELSE 'test' END AS role, "TransactionID"
    FROM r JOIN s ON pos < e""",
)
def walk_forward(spark, sf):
    return splits.walk_forward_validation(views.transactions(spark, sf)).select(
        "split_id", "role", "TransactionID"
    )


# -- features -----------------------------------------------------------------------------------

_STATS = """s AS (
  SELECT avg("TransactionAmt") AS mean, stddev_samp("TransactionAmt") AS std,
         median("TransactionAmt") AS med
  FROM train)"""


@query(
    "fit_amount_stats",
    f"""WITH {SPLIT}, {_STATS}
    SELECT round(mean, 6) AS amount_mean, round(std, 6) AS amount_std,
           round(med, 6) AS amount_median
    FROM s""",
)
def fit_stats(spark, sf):
    train, _ = train_test(spark, sf)
    return rounded(fit_amount_stats(train), "amount_mean", "amount_std", "amount_median")


_AMOUNT_SQL = """round(ln(1 + "TransactionAmt"), 6) AS amount_log,
       round("TransactionAmt" - floor("TransactionAmt"), 6) AS amount_decimal,
       round("TransactionAmt" / mean, 6) AS amount_vs_mean,
       round("TransactionAmt" / med, 6) AS amount_vs_median"""
_TIME_SQL = """CAST(floor("TransactionDT" / 3600) AS BIGINT) % 24 AS hour,
       CAST(floor("TransactionDT" / 86400) AS BIGINT) % 7 AS day_of_week,
       CAST(CAST(floor("TransactionDT" / 86400) AS BIGINT) % 7 IN (5, 6) AS INTEGER) AS is_weekend"""
_AMOUNTS = ("amount_log", "amount_decimal", "amount_vs_mean", "amount_vs_median")


@query(
    "amount_features",
    f'WITH {SPLIT}, {_STATS} SELECT "TransactionID", {_AMOUNT_SQL} FROM test, s',
)
def amount_features(spark, sf):
    train, test = train_test(spark, sf)
    rows = FeatureEngineer().fit(train, with_codes=False).transform(test)
    return rounded(rows.select("TransactionID", *_AMOUNTS), *_AMOUNTS)


@query("time_features", f'WITH {TXN} SELECT "TransactionID", {_TIME_SQL} FROM txn')
def time_features(spark, sf):
    txn = views.transactions(spark, sf)
    rows = FeatureEngineer().fit(txn.drop("TransactionAmt"), with_codes=False).transform(txn)
    return rows.select("TransactionID", "hour", "day_of_week", "is_weekend")


def _code_sql(column: str, source: str) -> str:
    return (
        f'SELECT "{column}" AS v, row_number() OVER (ORDER BY "{column}") - 1 AS code '
        f'FROM (SELECT DISTINCT "{column}" FROM {source} WHERE "{column}" IS NOT NULL)'
    )


@query(
    "model_matrix",
    f"""WITH {SPLIT}, {_STATS},
    c1 AS ({_code_sql("card1", "train")}),
    c2 AS ({_code_sql("ProductCD", "train")}),
    c3 AS ({_code_sql("DeviceInfo", "train")})
    SELECT "TransactionID", "TransactionAmt",
           CAST(coalesce(c1.code, -1) AS INTEGER) AS card1,
           CAST(coalesce(c2.code, -1) AS INTEGER) AS "ProductCD",
           CAST(coalesce(c3.code, -1) AS INTEGER) AS "DeviceInfo",
           {_AMOUNT_SQL}, {_TIME_SQL}
    FROM test CROSS JOIN s
    LEFT JOIN c1 ON test.card1 = c1.v
    LEFT JOIN c2 ON test."ProductCD" = c2.v
    LEFT JOIN c3 ON test."DeviceInfo" = c3.v""",
)
def model_matrix(spark, sf):
    """Codes and statistics learnt on the training slice, applied to the test slice."""
    train, test = train_test(spark, sf)
    engineer = FeatureEngineer().fit(train)
    rows = engineer.prepare_for_model(engineer.transform(test), keep=("TransactionID",))
    return rounded(rows, *_AMOUNTS)


@query(
    "category_codes",
    f"""WITH {MERGED},
    c1 AS ({_code_sql("lang", "merged")}), c2 AS ({_code_sql("source", "merged")}),
    c3 AS ({_code_sql("text", "merged")})
    SELECT doc_id, CAST(coalesce(c3.code, -1) AS INTEGER) AS text, CAST(coalesce(c1.code, -1) AS INTEGER) AS lang,
           CAST(coalesce(c2.code, -1) AS INTEGER) AS source, n_chars,
           coalesce(quality, -999) AS quality, coalesce(toxic, -999) AS toxic
    FROM merged LEFT JOIN c1 ON lang = c1.v LEFT JOIN c2 ON source = c2.v
         LEFT JOIN c3 ON text = c3.v""",
)
def category_codes(spark, sf):
    return FeatureEngineer().prepare_for_model(
        merged_documents(spark, sf), drop_cols=["doc_id"], keep=("doc_id",), mode="per_frame"
    )


@query(
    "feature_state_roundtrip",
    f"""WITH {SPLIT}, {_STATS}
    SELECT round(mean, 6) AS amount_mean, round(std, 6) AS amount_std,
           round(med, 6) AS amount_median, CAST(11 AS INTEGER) AS n_features,
           CAST((SELECT count(DISTINCT card1) + count(DISTINCT "ProductCD")
                        + count(DISTINCT "DeviceInfo") FROM train) AS BIGINT) AS n_codes
    FROM s""",
)
def feature_state_roundtrip(spark, sf):
    train, _ = train_test(spark, sf)
    path = scratch_path(spark, "engineer")
    FeatureEngineer().fit(train).save(path, spark)
    state = FeatureEngineer.load(path, spark).state
    return state.codes.agg(F.count(F.lit(1)).alias("n_codes")).select(
        F.round(F.lit(state.amount_mean), 6).alias("amount_mean"),
        F.round(F.lit(state.amount_std), 6).alias("amount_std"),
        F.round(F.lit(state.amount_median), 6).alias("amount_median"),
        F.lit(len(state.features)).alias("n_features"),
        "n_codes",
    )


_PAYMENT_CODES = ("browser", "country_code", "device_os", "merchant_category", "source", "zip_code")
_PAYMENTS = """
pay AS (
  SELECT 'event-' || event_id AS transaction_id, value AS amount, ts,
         CAST((event_id * 7919 + user_id * 104729) % 100
              < CASE WHEN value > 100 THEN 15 ELSE 1 END AS INTEGER) AS fraud_bool,
         n_regionkey > 1 AS is_international, event_type AS source, p_type AS device_os,
         p_brand AS browser, c_mktsegment AS merchant_category, n_name AS country_code,
         substr(md5(CAST(user_id AS VARCHAR)), 1, 3) AS zip_code
  FROM events
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN part ON p_partkey = CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER))"""


@query(
    "prepare_payments",
    f"""WITH {_PAYMENTS},
    {", ".join(f"c_{c} AS ({_code_sql(c, 'pay')})" for c in _PAYMENT_CODES)}
    SELECT transaction_id, fraud_bool, amount, round(ln(1 + amount), 6) AS amount_log,
           CAST(hour(ts) AS INTEGER) AS hour_of_day,
           CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
           CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend,
           CAST(is_international AS INTEGER) AS is_international,
           {", ".join(f"CAST(c_{c}.code AS INTEGER) AS {c}" for c in _PAYMENT_CODES)}
    FROM pay {" ".join(f"LEFT JOIN c_{c} ON pay.{c} = c_{c}.v" for c in _PAYMENT_CODES)}""",
)
def payments(spark, sf):
    rows, _ = prepare_payments(views.payments(spark, sf))
    return rounded(rows.drop("timestamp"), "amount_log")


@query(
    "hourly_risk",
    f"""WITH {SPLIT}, {_STATS}
    SELECT hour, CAST(count(*) AS BIGINT) AS transactions,
           round(avg("isFraud"), 6) AS fraud_rate,
           round(avg(ln(1 + "TransactionAmt")), 6) AS mean_amount_log,
           round(avg("TransactionAmt" / mean), 6) AS mean_amount_vs_mean,
           round(avg("TransactionAmt" / med), 6) AS mean_amount_vs_median,
           round(avg(is_weekend), 6) AS weekend_share
    FROM (SELECT *, {_TIME_SQL} FROM test) t, s
    GROUP BY hour""",
)
def hourly_risk(spark, sf):
    """Flagship: split by time, learn on the past, describe the latest slice by hour."""
    train, test = train_test(spark, sf)
    rows = FeatureEngineer().fit(train, with_codes=False).transform(test)
    hourly = rows.groupBy("hour").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.avg("isFraud").alias("fraud_rate"),
        F.avg("amount_log").alias("mean_amount_log"),
        F.avg("amount_vs_mean").alias("mean_amount_vs_mean"),
        F.avg("amount_vs_median").alias("mean_amount_vs_median"),
        F.avg("is_weekend").alias("weekend_share"),
    )
    return rounded(hourly, *[c for c in hourly.columns if c not in ("hour", "transactions")])
