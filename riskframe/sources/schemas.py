"""Named contracts of the inputs and outputs."""

from __future__ import annotations

import re

from pyspark.sql import types as T

TRANSACTION_INPUT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("device_os", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("is_international", T.BooleanType()),
        T.StructField("hour_of_day", T.IntegerType()),
    ]
)

FEATURE_OUTPUT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("threshold", T.DoubleType()),
    ]
)

PAYMENTS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("receiver_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("device_os", T.StringType()),
        T.StructField("browser", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("is_international", T.BooleanType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("device_fingerprint", T.StringType()),
        T.StructField("fraud_bool", T.IntegerType()),
    ]
)

REQUIRED_COLUMNS = ["TransactionID", "TransactionDT", "TransactionAmt"]

_KNOWN = {
    "TransactionID": T.LongType(),
    "TransactionDT": T.LongType(),
    "TransactionAmt": T.DoubleType(),
    "isFraud": T.IntegerType(),
    "ProductCD": T.StringType(),
    "DeviceType": T.StringType(),
    "DeviceInfo": T.StringType(),
    "P_emaildomain": T.StringType(),
    "R_emaildomain": T.StringType(),
}
_NUMBERED = re.compile(r"^(V|C|D|dist|addr)\d+$")
_FLAGS = re.compile(r"^M\d$")


def known_type(column: str) -> T.DataType | None:
    """Type of a column of the card-transaction tables, None where it must be inferred."""
    if column in _KNOWN:
        return _KNOWN[column]
    if _NUMBERED.match(column):
        return T.DoubleType()
    if _FLAGS.match(column):
        return T.StringType()
    return None
