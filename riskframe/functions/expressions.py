"""Column expressions shared by batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400
HASH_SPACE = float(1 << 52)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL, so that every aggregate skips missing values."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not floats:
        return df
    missing = F.lit(None)
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).otherwise(missing)
                           for c in floats})


def amount_log(amount: Column) -> Column:
    """ln(1 + amount); -inf at -1 and missing below."""
    return F.when(amount == -1, F.lit(float("-inf"))).otherwise(F.log1p(amount))


def amount_decimal(amount: Column) -> Column:
    """Fractional part with floor semantics (-0.25 gives 0.75)."""
    return F.pmod(amount, F.lit(1.0))


def ratio(amount: Column, reference: float | None) -> Column:
    return F.try_divide(amount, F.lit(reference).cast("double"))


def hour_of_offset(seconds: Column) -> Column:
    return F.pmod(F.floor(seconds / SECONDS_PER_HOUR), F.lit(24)).cast("bigint")


def day_of_offset(seconds: Column) -> Column:
    """Day counted from the offset's origin, 0-6; not a calendar weekday."""
    return F.pmod(F.floor(seconds / SECONDS_PER_DAY), F.lit(7)).cast("bigint")


def is_weekend(day: Column) -> Column:
    return F.coalesce(day.isin(5, 6), F.lit(False)).cast("int")


def binarise(score: Column, threshold: float = 0.5) -> Column:
    """1 where the score lies strictly above the threshold; a missing or NaN score is not flagged."""
    known = F.nanvl(score.cast("double"), F.lit(None))
    return F.coalesce(known > F.lit(threshold), F.lit(False)).cast("int")


def either(*flags: Column) -> Column:
    return F.greatest(*flags)


def hash52(*parts: Column) -> Column:
    """52-bit integer from the MD5 of the joined parts: the same on every engine."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def uniform(*parts: Column) -> Column:
    """Repeatable number in [0, 1) for the given parts."""
    return hash52(*parts).cast("double") / F.lit(HASH_SPACE)


def focal_term(label: Column, score: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    """-a (1 - p_t)^g ln p_t with p_t kept inside (0, 1)."""
    eps = 1e-12
    p_t = F.when(label == 1, score).otherwise(1 - score)
    p_t = F.least(F.greatest(p_t, F.lit(eps)), F.lit(1 - eps))
    weight = F.when(label == 1, F.lit(alpha)).otherwise(F.lit(1 - alpha))
    return -weight * F.pow(1 - p_t, F.lit(gamma)) * F.log(p_t)


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample Kolmogorov p-value, 100 terms, kept in [0, 1]."""
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    # the alternating series does not converge at lambda = 0, where the value is 1
    return F.when(lam < 1e-3, F.lit(1.0)).otherwise(
        F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    )
