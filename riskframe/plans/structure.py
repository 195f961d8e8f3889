"""Queries: graph, sequences, stress test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators import graph, sequences, stress
from riskframe.plans.base import TXN, query, rounded
from riskframe.sources import views

_NODES = """links AS (
  SELECT 'user' AS node_type, card1 AS node_key FROM txn
  UNION ALL SELECT 'merchant', "ProductCD" FROM txn
  UNION ALL SELECT 'device', "DeviceInfo" FROM txn),
nodes AS (
  SELECT node_type, node_key, count(*) AS degree,
         row_number() OVER (PARTITION BY node_type ORDER BY node_key) - 1 AS node_id
  FROM links WHERE node_key IS NOT NULL GROUP BY node_type, node_key)"""


@query(
    "graph_nodes",
    f"""WITH {TXN}, {_NODES}
    SELECT node_type, node_key, degree, node_id FROM nodes
    UNION ALL
    SELECT 'transaction', CAST("TransactionID" AS VARCHAR), CAST(3 AS BIGINT), "TransactionID"
    FROM txn""",
)
def graph_nodes(spark, sf):
    return graph.graph_nodes(views.transactions(spark, sf))


@query(
    "graph_edges",
    f"""WITH {TXN}, {_NODES}
    SELECT 'user_makes_transaction' AS edge_type, "TransactionID", node_id
    FROM txn JOIN nodes ON node_type = 'user' AND node_key = card1
    UNION ALL SELECT 'transaction_to_merchant', "TransactionID", node_id
    FROM txn JOIN nodes ON node_type = 'merchant' AND node_key = "ProductCD"
    UNION ALL SELECT 'transaction_uses_device', "TransactionID", node_id
    FROM txn JOIN nodes ON node_type = 'device' AND node_key = "DeviceInfo\"""",
)
def graph_edges(spark, sf):
    return graph.graph_edges(views.transactions(spark, sf))


_HOP1 = """h1 AS (
  SELECT *, avg("TransactionAmt") OVER (PARTITION BY card1) AS user_mean_1,
         avg("TransactionAmt") OVER (PARTITION BY "ProductCD") AS merchant_mean_1,
         avg("TransactionAmt") OVER (PARTITION BY "DeviceInfo") AS device_mean_1,
         count(*) OVER (PARTITION BY card1) AS user_degree,
         count(*) OVER (PARTITION BY "ProductCD") AS merchant_degree,
         count(*) OVER (PARTITION BY "DeviceInfo") AS device_degree
  FROM txn)"""
_MEANS_1 = ("user_mean_1", "merchant_mean_1", "device_mean_1")
_MEANS_2 = ("user_mean_2", "merchant_mean_2", "device_mean_2")
_DEGREES = ("user_degree", "merchant_degree", "device_degree")
_ROUND_1 = ", ".join(f"round({c}, 8) AS {c}" for c in _MEANS_1)
_ROUND_2 = ", ".join(f"round({c}, 8) AS {c}" for c in _MEANS_2)


@query(
    "graph_features_1hop",
    f'WITH {TXN}, {_HOP1} SELECT "TransactionID", {_ROUND_1}, {", ".join(_DEGREES)} FROM h1',
)
def graph_features_1hop(spark, sf):
    out = graph.graph_features(views.transactions(spark, sf), hops=1)
    return rounded(out.select("TransactionID", *_MEANS_1, *_DEGREES), *_MEANS_1, places=8)


@query(
    "graph_features_2hop",
    f"""WITH {TXN}, {_HOP1}, s AS (
      SELECT *, ("TransactionAmt" + user_mean_1 + merchant_mean_1 + device_mean_1) / 4 AS h
      FROM h1),
    h2 AS (
      SELECT *, avg(h) OVER (PARTITION BY card1) AS user_mean_2,
             avg(h) OVER (PARTITION BY "ProductCD") AS merchant_mean_2,
             avg(h) OVER (PARTITION BY "DeviceInfo") AS device_mean_2
      FROM s)
    SELECT "TransactionID", {_ROUND_1}, {_ROUND_2}, {", ".join(_DEGREES)} FROM h2""",
)
def graph_features_2hop(spark, sf):
    out = graph.graph_features(views.transactions(spark, sf), hops=2)
    means = (*_MEANS_1, *_MEANS_2)
    return rounded(out.select("TransactionID", *means, *_DEGREES), *means, places=8)


# -- sequences ----------------------------------------------------------------------------------


@query(
    "user_sequences",
    f"""WITH {TXN}, b AS (
      SELECT *, row_number() OVER (PARTITION BY card1
                                   ORDER BY "TransactionDT" DESC, "TransactionID" DESC) AS back
      FROM txn),
    l AS (
      SELECT *, row_number() OVER (PARTITION BY card1 ORDER BY back DESC) - 1 AS position
      FROM b WHERE back <= 10),
    c AS (SELECT card1, max(CASE WHEN back = 1 THEN "isFraud" END) AS label FROM l GROUP BY card1)
    SELECT c.card1, CAST(k.position AS INTEGER) AS position,
           coalesce("TransactionAmt", 0.0::DOUBLE) AS amt, coalesce("TransactionDT", 0) AS dt,
           l.card1 IS NOT NULL AS mask, label
    FROM c CROSS JOIN range(10) k(position)
    LEFT JOIN l ON l.card1 = c.card1 AND l.position = k.position""",
)
def user_sequences(spark, sf):
    built = sequences.SequenceBuilder(10).build_sequences(views.transactions(spark, sf))
    return built.select(
        "card1", F.posexplode(F.arrays_zip("seq", "mask")).alias("position", "e"), "label"
    ).select(
        "card1",
        "position",
        F.col("e.seq.amt").alias("amt"),
        F.col("e.seq.dt").alias("dt"),
        F.col("e.mask").alias("mask"),
        "label",
    )


_CARD_ORDER = """o AS (
  SELECT *, row_number() OVER (PARTITION BY card1 ORDER BY "TransactionDT", "TransactionID") AS rn
  FROM txn)"""


@query(
    "trailing_sequences",
    f"""WITH {TXN}, {_CARD_ORDER}
    SELECT a."TransactionID", CAST(b.rn - greatest(a.rn - 4, 1) AS INTEGER) AS position,
           b."TransactionAmt" AS amt, b."TransactionDT" AS dt
    FROM o a JOIN o b ON a.card1 = b.card1 AND b.rn BETWEEN a.rn - 4 AND a.rn""",
)
def trailing_sequences(spark, sf):
    rows = sequences.trailing_sequences(views.transactions(spark, sf), 5)
    return rows.select("TransactionID", F.posexplode("seq").alias("position", "e")).select(
        "TransactionID", "position", F.col("e.amt").alias("amt"), F.col("e.dt").alias("dt")
    )


@query(
    "sequence_features",
    f"""WITH {TXN}
    SELECT "TransactionID", count(*) OVER w AS seq_len,
           round(avg("TransactionAmt") OVER w, 6) AS seq_mean,
           round(stddev_samp("TransactionAmt") OVER w, 4) AS seq_std,
           min("TransactionAmt") OVER w AS seq_min, max("TransactionAmt") OVER w AS seq_max,
           "TransactionDT" - lag("TransactionDT") OVER
             (PARTITION BY card1 ORDER BY "TransactionDT", "TransactionID") AS seq_gap
    FROM txn
    WINDOW w AS (PARTITION BY card1 ORDER BY "TransactionDT", "TransactionID"
                 ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def sequence_features(spark, sf):
    rows = sequences.sequence_features(views.transactions(spark, sf), 10).select(
        "TransactionID", "seq_len", "seq_mean", "seq_std", "seq_min", "seq_max", "seq_gap"
    )
    return rounded(rounded(rows, "seq_mean"), "seq_std", places=4)


# -- stress -------------------------------------------------------------------------------------


def frauds(spark, sf) -> DataFrame:
    hour = X.hour_of_offset(F.col("TransactionDT")).alias("hour")
    return views.transactions(spark, sf).where("isFraud = 1").select(
        "TransactionID", "TransactionAmt", hour
    )


def _rule(df: DataFrame) -> DataFrame:
    amount = F.col("TransactionAmt")
    return df.withColumn("score", amount / (amount + 100.0))


_FRAUDS = f"""{TXN}, f AS (
  SELECT "TransactionID", "TransactionAmt",
         CAST(floor("TransactionDT" / 3600) AS BIGINT) % 24 AS hour
  FROM txn WHERE "isFraud" = 1)"""
_STATE = """'amt_' || CAST(least(greatest(floor("TransactionAmt" / 100), 0), 9) AS BIGINT)
  || '_hr_' || CAST(floor(hour / 6) AS BIGINT)"""
_CHANGED = f"""u AS (
  SELECT f.*, {_STATE} AS state, a.action_id, a.action, CAST('0x' || substr(md5(
           "TransactionID"::VARCHAR || '|' || a.action_id || '|42'), 1, 13) AS BIGINT)::DOUBLE
           / 4503599627370496.0::DOUBLE AS u
  FROM f, (VALUES (0, 'increase_amount'), (1, 'decrease_amount'), (2, 'change_time_early'),
                  (3, 'change_time_late'), (4, 'split_transaction')) a(action_id, action)),
changed AS (
  SELECT "TransactionID", state, action_id, action,
         "TransactionAmt" * CASE action_id
           WHEN 0 THEN 1.1::DOUBLE + 0.4::DOUBLE * u WHEN 1 THEN 0.5::DOUBLE + 0.4::DOUBLE * u
           WHEN 4 THEN 1.0::DOUBLE / floor(2 + 2 * u) ELSE 1.0::DOUBLE END AS amount,
         CASE action_id WHEN 2 THEN CAST(floor(6 + 6 * u) AS BIGINT)
           WHEN 3 THEN CAST(floor(18 + 5 * u) AS BIGINT) ELSE hour END AS hour
  FROM u)"""
_EVASION = """ev AS (
  SELECT state, action_id, action, count(*) AS attempts,
         avg(CAST(amount / (amount + 100.0::DOUBLE) <= 0.5 AS INTEGER)) AS evasion_rate,
         CAST(sum(CASE WHEN amount / (amount + 100.0::DOUBLE) <= 0.5 THEN 1 ELSE -1 END)
              AS BIGINT) AS total_reward
  FROM changed GROUP BY state, action_id, action)"""


@query(
    "attack_state",
    f"""WITH {_FRAUDS}
    SELECT "TransactionID", {_STATE} AS state,
           'amt_4_hr_' || CAST(floor(hour / 6) AS BIGINT) AS reference_state
    FROM f""",
)
def attack_state(spark, sf):
    rows = stress.attack_state(frauds(spark, sf))
    rows = stress.attack_state(rows, "reference", "reference_state")
    return rows.select("TransactionID", "state", "reference_state")


@query(
    "attack_perturb",
    f"""WITH {_FRAUDS}, {_CHANGED}
    SELECT "TransactionID", action, round(amount, 6) AS "TransactionAmt", hour FROM changed""",
)
def attack_perturb(spark, sf):
    rows = stress.perturb(frauds(spark, sf))
    return rounded(
        rows.select("TransactionID", "action", "TransactionAmt", "hour"), "TransactionAmt"
    )


@query(
    "evasion_rate",
    f"""WITH {_FRAUDS}, {_CHANGED}, {_EVASION}
    SELECT state, action, attempts, round(evasion_rate, 6) AS evasion_rate, total_reward
    FROM ev""",
)
def evasion_rate(spark, sf):
    return rounded(stress.evasion(frauds(spark, sf), _rule).drop("action_id"), "evasion_rate")


@query(
    "best_attack",
    f"""WITH {_FRAUDS}, {_CHANGED}, {_EVASION}, r AS (
      SELECT state, action, total_reward / attempts::DOUBLE AS value,
             row_number() OVER (PARTITION BY state
               ORDER BY total_reward / attempts::DOUBLE DESC, action_id) AS rn
      FROM ev)
    SELECT state, action, round(value, 6) AS value FROM r WHERE rn = 1""",
)
def best_attack(spark, sf):
    return rounded(stress.best_actions(stress.evasion(frauds(spark, sf), _rule)), "value")
