"""How easily changed frauds slip past a detector, computed for all frauds at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expressions import binarise, uniform

AMOUNT, KEY = "TransactionAmt", "TransactionID"
# fixed values: the actions, in order
ACTIONS = (
    "increase_amount",
    "decrease_amount",
    "change_time_early",
    "change_time_late",
    "split_transaction",
)
DEFAULT_HOUR = 12
AMOUNT_BINS, AMOUNT_TOP = 10, 1000.0


def attack_state(df: DataFrame, mode: str = "binned", name: str = "state") -> DataFrame:
    """Add the label ``amt_{bin}_hr_{quarter of day}``.

    ``binned`` cuts the amount into ten bins of [0, 1000], outer values to the end bins;
    ``reference`` always uses bin 4, the result of cutting a single value into ten bins.
    """
    if mode == "reference":
        amount_bin = F.lit(4)
    elif mode == "binned":
        raw = F.floor(F.col(AMOUNT) / (AMOUNT_TOP / AMOUNT_BINS))
        amount_bin = F.least(F.greatest(raw, F.lit(0)), F.lit(AMOUNT_BINS - 1))
    else:
        raise ValueError(f"unknown mode: {mode}")
    hour = F.col("hour") if "hour" in df.columns else F.lit(DEFAULT_HOUR)
    return df.withColumn(
        name,
        F.concat(
            F.lit("amt_"),
            amount_bin.cast("string"),
            F.lit("_hr_"),
            F.floor(hour / 6).cast("string"),
        ),
    )


def perturb(df: DataFrame, seed: int = 42) -> DataFrame:
    """Each row once per action, with the changed amount and hour.

    The random numbers come from a hash of (id, action, seed), so reruns agree. The hour actions
    change nothing without an ``hour`` column; splitting divides the amount and adds no rows.
    """
    actions = F.array(
        *[
            F.struct(F.lit(i).alias("action_id"), F.lit(a).alias("action"))
            for i, a in enumerate(ACTIONS)
        ]
    )
    rows = df.select("*", F.inline(actions))
    u = uniform(F.col(KEY), F.col("action_id"), F.lit(seed))
    factor = (
        F.when(F.col("action_id") == 0, 1.1 + 0.4 * u)
        .when(F.col("action_id") == 1, 0.5 + 0.4 * u)
        .when(F.col("action_id") == 4, F.lit(1.0) / F.floor(2 + 2 * u))
        .otherwise(F.lit(1.0))
    )
    changed = {AMOUNT: F.col(AMOUNT) * factor}
    if "hour" in df.columns:
        hour = (
            F.when(F.col("action_id") == 2, F.floor(6 + 6 * u))
            .when(F.col("action_id") == 3, F.floor(18 + 5 * u))
            .otherwise(F.col("hour"))
        )
        changed["hour"] = hour.cast(df.schema["hour"].dataType)
    return rows.withColumns(changed)


Scorer = Callable[[DataFrame], DataFrame]


def evasion(
    frauds: DataFrame,
    scorer: Scorer,
    score: str = "score",
    seed: int = 42,
    mode: str = "binned",
    threshold: float = 0.5,
) -> DataFrame:
    """Per (state, action): attempts, evasion rate and total reward (+1 missed, -1 detected).

    ``scorer`` adds the score column to the changed rows; the state is that of the original row.
    """
    attempts = scorer(perturb(attack_state(frauds, mode), seed))
    missed: Column = 1 - binarise(F.col(score), threshold)
    return attempts.groupBy("state", "action_id", "action").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.avg(missed).alias("evasion_rate"),
        F.sum(2 * missed - 1).alias("total_reward"),
    )


def best_actions(evasions: DataFrame) -> DataFrame:
    """Per state the action with the highest mean reward; the earlier action wins ties."""
    value = F.col("total_reward") / F.col("attempts")
    best = F.max(F.struct(value.alias("value"), (-F.col("action_id")).alias("o"), "action"))
    return (
        evasions.groupBy("state")
        .agg(best.alias("b"))
        .select("state", F.col("b.action").alias("action"), F.col("b.value").alias("value"))
    )
