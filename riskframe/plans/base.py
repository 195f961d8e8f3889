"""Registry of the named queries and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the equivalent SQL over the same tables where there is one."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def r6(column: Column | str, places: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, places)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, places) for c in columns})


# -- shared parts of the SQL --------------------------------------------------------------------

TXN = """
txn AS (
  SELECT event_id AS "TransactionID",
         CAST(date_diff('second', TIMESTAMP '2024-01-01', ts) AS BIGINT) AS "TransactionDT",
         value AS "TransactionAmt",
         CAST(user_id AS VARCHAR) AS card1,
         event_type AS "ProductCD",
         'D' || regexp_extract(props, '"k": *([0-9]+)', 1) AS "DeviceInfo",
         CAST((event_id * 7919 + user_id * 104729) % 100
              < CASE WHEN value > 100 THEN 15 ELSE 1 END AS INTEGER) AS "isFraud"
  FROM events)"""

SPLIT = (
    TXN
    + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY "TransactionDT", "TransactionID") AS rn,
         count(*) OVER () AS n
  FROM txn),
train AS (SELECT * FROM ranked WHERE rn <= CAST(trunc(n * (1 - 0.2::DOUBLE)) AS BIGINT)),
test AS (SELECT * FROM ranked WHERE rn > CAST(trunc(n * (1 - 0.2::DOUBLE)) AS BIGINT))"""
)

SCORED = (
    TXN
    + """,
scored AS (
  SELECT "TransactionID", "TransactionDT", "TransactionAmt", "isFraud",
         "TransactionAmt" / ("TransactionAmt" + 100.0::DOUBLE) AS score
  FROM txn)"""
)

MERGED = """
merged AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
