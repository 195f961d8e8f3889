"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordering import PIVOT_ROWS, content_keys, some_rows
from riskframe.session import shuffle_width

BROADCAST_BYTES = 8 << 20  # a lookup table is broadcast only below this measured size


def hot_key_shares(df: DataFrame, key: str, share: float) -> tuple[int, dict]:
    """(rows, keys that hold at least ``share`` of them with their estimated share).

    Missing keys count as one key. Read from about a million rows: at most ``1 / share`` keys,
    which steer the physical layout only, never the result.
    """
    n = df.count()
    if n == 0:
        return 0, {}
    picked = df.select(key).where(some_rows(n)) if n > PIVOT_ROWS else df.select(key)
    seen = min(n, PIVOT_ROWS)
    heavy = (
        picked.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= share * seen)
        .collect()  # at most 1 / share keys
    )
    return n, {r[0]: r["n"] / seen for r in heavy}


def hot_key_counts(df: DataFrame, key: str, share: float) -> dict:
    n, shares = hot_key_shares(df, key, share)
    return {k: int(s * n) for k, s in shares.items()}


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    return list(hot_key_shares(df, key, share)[1])


def is_one_of(column: Column, keys: list) -> Column:
    """Membership that also covers NULL and never returns NULL."""
    known = [k for k in keys if k is not None]
    cond = F.coalesce(column.isin(known), F.lit(False)) if known else F.lit(False)
    return cond | column.isNull() if None in keys else cond


def spread(df: DataFrame, pieces: int) -> Column:
    """A salt that separates distinct rows and, through the task number, copies of a row."""
    return F.pmod(content_keys(df)[0] + F.spark_partition_id(), F.lit(pieces)).cast("int")


def salt_tiers(shares: dict, width: int) -> dict[int, list]:
    """Number of pieces -> hot keys; a piece is at most about a quarter of an even partition."""
    tiers: dict[int, list] = {}
    for key, share in shares.items():
        pieces = 2
        while pieces < min(width, 4 * share * width):
            pieces *= 4
        tiers.setdefault(min(pieces, width), []).append(key)
    return tiers


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    null_safe: bool = False,
    share: float | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Equi join on ``key``: the rows of hot keys of ``left`` are cut into pieces, for each of
    which ``right`` repeats its rows of that key.

    Missing keys of ``left`` are cut too; unless ``null_safe`` they match nothing. Hot keys are
    looked for in ``probe``, a cheaper frame with the same keys, if given.
    """
    width = shuffle_width(left.sparkSession)
    share = share or 0.25 / width
    seen = left if probe is None else probe
    shares = hot_key_shares(seen, key, share)[1] if width > 1 else {}
    salt, repeats = F.lit(0), F.lit(1)
    for pieces, keys in salt_tiers(shares, width).items():
        salt = F.when(is_one_of(F.col(key), keys), spread(left, pieces)).otherwise(salt)
        matched = keys if null_safe else [k for k in keys if k is not None]
        repeats = F.when(is_one_of(F.col(key), matched), F.lit(pieces)).otherwise(repeats)
    salted_l = left.withColumn("_salt", salt)
    salted_r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), repeats - 1)))
    if not shares:
        salted_r = right.withColumn("_salt", F.lit(0))
    salted_r = salted_r.withColumnsRenamed({key: "_right_key", "_salt": "_right_salt"})
    same = F.col(key).eqNullSafe(F.col("_right_key")) if null_safe else (
        F.col(key) == F.col("_right_key")
    )
    joined = salted_l.join(salted_r, same & (F.col("_salt") == F.col("_right_salt")), how)
    return joined.drop("_salt", "_right_key", "_right_salt")


def table_bytes(df: DataFrame) -> int:
    """Measured upper estimate of the in-memory size of a narrow table."""
    width = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        size = F.coalesce(F.octet_length(F.col(name)), F.lit(0)) if kind == "string" else F.lit(0)
        width = width + size.cast("bigint") + 16
    return df.agg(F.sum(width).alias("b")).first()["b"] or 0


def measured_join(left: DataFrame, right: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Left join to a table whose keys may repeat: broadcast if measured small, else salted.

    Only the right side is read to decide. Nested columns can't be measured that way: salted.
    """
    flat = not any(kind.startswith(("array", "map", "struct", "binary", "variant")) for _, kind in right.dtypes)
    if flat and table_bytes(right) <= BROADCAST_BYTES:
        found = F.broadcast(right.withColumnRenamed(key, "_right_key"))
        same = F.col(key).eqNullSafe(F.col("_right_key")) if null_safe else F.col(key) == F.col("_right_key")
        return left.join(found, same, "left").drop("_right_key")
    return salted_join(left, right, key, "left", null_safe)


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    key: str,
    n_bytes: int | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with one row per key: broadcast if measured small, else salted."""
    n_bytes = table_bytes(lookup) if n_bytes is None else n_bytes
    if n_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(lookup), key, "left")
    return salted_join(left, lookup, key, probe=probe)
