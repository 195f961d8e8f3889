"""Splits by time: two-way, three-way and walk-forward, all as filters on exact cut keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordering import order_cuts, slice_rows, total_order, with_segment

TIME, KEY = "TransactionDT", "TransactionID"


def part_ends(test_size: float, validation_size: float) -> Callable[[int], list[int]]:
    """From a number of rows to the ranks at which train (and validation) end."""

    def ends(n: int) -> list[int]:
        last = int(n * (1 - test_size))
        return [int(n * (1 - test_size - validation_size)), last] if validation_size > 0 else [last]

    return ends


def temporal_train_test_split(
    df: DataFrame,
    time_col: str = TIME,
    test_size: float = 0.2,
    validation_size: float = 0.0,
    id_col: str = KEY,
) -> tuple[DataFrame, ...]:
    """(train, test), or (train, validation, test); ties in time go by id, then by content.

    Rows without a time come last. The cut is exact, so train never holds a later row than test.
    """

    order = total_order(df, time_col, id_col)
    edges = [None, *order_cuts(df, order, part_ends(test_size, validation_size)), None]
    return tuple(slice_rows(df, order, lo, hi) for lo, hi in zip(edges, edges[1:]))


def walk_forward_plan(n: int, n_splits: int, test_size: float) -> list[tuple[int, int]]:
    """(start, end) ranks of the test part of each split; training is all rows before start."""
    test_n = int(n * test_size)
    plan = []
    for i in range(n_splits):
        end = n - (n_splits - i - 1) * (test_n // n_splits)
        plan.append((end - test_n, end))
    if plan and plan[0][0] < 0:
        raise ValueError(f"test_size {test_size} leaves no rows before the first test part")
    return plan


def walk_forward_validation(
    df: DataFrame,
    time_col: str = TIME,
    n_splits: int = 5,
    test_size: float = 0.2,
    id_col: str = KEY,
) -> DataFrame:
    """The rows of ``df`` once per split they take part in, with ``split_id`` and ``role``.

    One scan: each row finds its segment between the cuts and is repeated for that segment's
    memberships.
    """
    plan: list[tuple[int, int]] = []
    ranks: list[int] = []

    def edges(n: int) -> list[int]:
        plan.extend(walk_forward_plan(n, n_splits, test_size))
        ranks.extend(sorted({r for pair in plan for r in pair}))
        return ranks

    order = total_order(df, time_col, id_col)
    cuts = order_cuts(df, order, edges)
    rows = with_segment(df, order, cuts, "_segment")
    starts = [0] + ranks
    members = []
    for at in starts:
        roles = [
            F.struct(
                F.lit(i).alias("split_id"),
                F.lit("train" if at < start else "test").alias("role"),
            )
            for i, (start, end) in enumerate(plan)
            if at < end
        ]
        empty = F.array().cast("array<struct<split_id:int,role:string>>")
        members.append(F.array(*roles) if roles else empty)
    return rows.select(
        F.inline(F.element_at(F.array(*members), F.col("_segment") + 1)), *df.columns
    )
