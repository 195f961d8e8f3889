"""Tables stored by day and in order of time, and splits by time that skip what they don't need."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordering import Cut, order_cuts, slice_rows, total_order
from riskframe.operators.splits import KEY, TIME, part_ends
from riskframe.session import shuffle_width

DAY, SECONDS = "_day", 86_400


def write_by_day(
    df: DataFrame, path: str, time: str, spread: str, rows_per_file: int = 5_000_000
) -> None:
    """Write ``df`` in folders by day (days since 1970, whatever the session's time zone), files in
    order of ``time``.

    Ranges of (day, time, ``spread``) are dealt to the tasks, so a day or a second of any share
    fills as many tasks as it needs. Rows without a time have a folder of their own.
    """
    moment = F.col(time).cast("timestamp")
    dated = df.withColumn(time, moment).withColumn(
        DAY, F.floor(F.unix_seconds(F.col(time)) / SECONDS).cast("int")
    )
    (
        dated.repartitionByRange(shuffle_width(df.sparkSession), DAY, time, spread)
        .sortWithinPartitions(DAY, time)
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy(DAY)
        .parquet(path)
    )


def _second(cut: Cut | None, origin: int) -> int | None:
    """The second in which a cut lies; NULL where it bounds nothing."""
    if cut is None or not cut.path or cut.path[0] is None:
        return None
    return origin + math.floor(cut.path[0])


def implied_bounds(time: str, start: Cut | None, end: Cut | None, origin: int) -> Column:
    """What rows between two cuts on derived seconds since ``origin`` must fulfil as stored.

    Rows without a time sort last, so only an end bound excludes them.
    """
    low, high = _second(start, origin), _second(end, origin)
    cond = F.lit(True)
    if low is not None:
        cond = cond & ((F.col(DAY) >= low // SECONDS) | F.col(DAY).isNull())
        cond = cond & ((F.col(time) >= F.timestamp_seconds(F.lit(low))) | F.col(time).isNull())
    if high is not None:
        cond = cond & (F.col(DAY) <= high // SECONDS)
        cond = cond & (F.col(time) < F.timestamp_seconds(F.lit(high + 1)))
    return cond


def split_by_time(
    stored: DataFrame,
    time: str,
    derive: Callable[[DataFrame], DataFrame],
    origin: int,
    test_size: float = 0.2,
    validation_size: float = 0.0,
    time_col: str = TIME,
    id_col: str = KEY,
) -> tuple[DataFrame, ...]:
    """(train, test), or (train, validation, test), of rows that ``derive`` makes of a table by day.

    The same parts as :func:`splits.temporal_train_test_split` gives for the derived rows, whose
    ``time_col`` counts whole seconds since ``origin``; the cut on it also bounds the stored day
    and time, so that folders, files and row groups outside a part aren't read.
    """
    rows = derive(stored)
    order = total_order(rows, time_col, id_col)
    edges = [None, *order_cuts(rows, order, part_ends(test_size, validation_size)), None]
    return tuple(
        slice_rows(derive(stored.where(implied_bounds(time, lo, hi, origin))), order, lo, hi)
        for lo, hi in zip(edges, edges[1:])
    )
