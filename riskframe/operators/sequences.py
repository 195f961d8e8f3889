"""Per-card sequences: the latest window of each card, and the trailing window of each row."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from riskframe.operators.ordering import PIVOT_ROWS, numeric_key, some_rows, with_buckets
from riskframe.operators.skew import hot_key_counts, hot_keys, is_one_of
from riskframe.session import materialise

CARD, TIME, AMOUNT, KEY, LABEL = (
    "card1",
    "TransactionDT",
    "TransactionAmt",
    "TransactionID",
    "isFraud",
)
CHUNK_ROWS = 1_000_000
MAX_CHUNKS = PIVOT_ROWS // 16  # as many as bounds read from PIVOT_ROWS rows can tell apart


class SequenceBuilder:
    """One padded sequence per card."""

    def __init__(self, max_seq_len: int = 10):
        self.max_seq_len = max_seq_len

    def build_sequences(self, df: DataFrame) -> DataFrame:
        """Rows (card1, seq, mask, label).

        ``seq`` holds the latest ``max_seq_len`` (amt, dt) pairs in time order, padded with zeros
        at the end; ``mask`` is true for real entries; ``label`` is that of the latest row.
        The row limit is applied before the shuffle, so a hot card sends few rows per task. Beyond
        ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark doesn't do so by itself: there the
        latest rows of each (card, task of the scan) are picked first.
        """
        length = self.max_seq_len
        latest = Window.partitionBy(CARD).orderBy(F.desc_nulls_first(TIME), F.desc(KEY))
        label = F.col(LABEL) if LABEL in df.columns else F.lit(0)
        rows = df.where(F.col(CARD).isNotNull()).select(CARD, TIME, KEY, AMOUNT, label.alias("label"))
        if length > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
            rows = rows.withColumn("_task", F.spark_partition_id())
            own = Window.partitionBy(CARD, "_task").orderBy(F.desc_nulls_first(TIME), F.desc(KEY))
            rows = rows.withColumn("_back", F.row_number().over(own)).where(F.col("_back") <= length)
        last = (
            rows
            .withColumn("_back", F.row_number().over(latest))
            .where(F.col("_back") <= length)
        )
        pad = F.struct(F.lit(0.0).alias("amt"), F.lit(0).cast("bigint").alias("dt"))
        entry = F.struct(
            (-F.col("_back")).alias("o"), F.col(AMOUNT).alias("amt"), F.col(TIME).alias("dt")
        )
        packed = last.groupBy(CARD).agg(
            F.sort_array(F.collect_list(entry)).alias("e"),
            F.max(F.when(F.col("_back") == 1, F.col("label"))).alias("label"),
        )
        real = F.transform("e", lambda x: F.struct(x["amt"].alias("amt"), x["dt"].alias("dt")))
        gap = F.lit(length) - F.size("e")
        return packed.select(
            CARD,
            F.concat(real, F.array_repeat(pad, gap)).alias("seq"),
            F.concat(
                F.array_repeat(F.lit(True), F.size("e")), F.array_repeat(F.lit(False), gap)
            ).alias("mask"),
            "label",
        )


def _bounds(rows: DataFrame, column: str, parts: int) -> tuple[list[float], list]:
    """Approximate quantile bounds of a column, with hot values fenced into their own bucket."""
    probs = [i / parts for i in range(1, parts)]
    near = rows.where(some_rows(rows.count()))
    found = near.agg(F.percentile_approx(column, probs, 10 * parts).alias("b")).first()["b"]
    hot = [v for v in hot_keys(rows, column, 2.0 / parts) if v is not None]
    return sorted({float(b) for b in found or []} | {float(v + d) for v in hot for d in (0, 1)}), hot


def _with_chunks(df: DataFrame, by: str, keys: list[str], chunk_rows: int):
    """(frame with ``_chunk``, hot cards, order columns).

    Rows of hot cards are cut along the order ``keys``: by the first key, below its hot values by
    the second, and below hot (first, second) pairs by a written row number.
    """
    # cards above a chunk's rows, as far down as a sample of PIVOT_ROWS rows shows them
    counts = hot_key_counts(df, by, max(chunk_rows / max(df.count(), 1), 16 / PIVOT_ROWS))
    hot = [k for k, c in counts.items() if k is not None and c > chunk_rows]
    if not hot:
        return df.withColumn("_chunk", F.lit(None).cast("array<int>")), hot, keys
    parts = min(MAX_CHUNKS, max(2, math.ceil(sum(counts[k] for k in hot) / chunk_rows)))
    levels = list(keys)
    chunk: list[Column] = []
    rows = df.where(is_one_of(F.col(by), hot))
    inside = is_one_of(F.col(by), hot)
    depth = 0
    while depth < len(levels):
        column = levels[depth]
        inner, repeated = _bounds(rows, column, parts)
        df = df.withColumn(f"_b{depth}", F.col(column).cast("double"))
        df = with_buckets(df, {f"_b{depth}": inner}).drop(f"_b{depth}")
        bucket = F.coalesce(F.col(f"_b{depth}_bucket"), F.lit(len(inner) + 1))
        chunk.append(F.when(inside, bucket).otherwise(F.lit(0)))
        if not repeated:
            break
        if depth + 1 == len(levels) and levels[-1] != "_row":
            # copies of one row: number the rows once, in a written table
            df = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
            levels.append("_row")
        inside = inside & is_one_of(F.col(column), repeated)
        rows = df.where(inside)
        depth += 1
    out = df.withColumn("_chunk", F.array(*chunk))
    return out.drop(*[f"_b{d}_bucket" for d in range(len(levels))]), hot, levels


def trailing(
    df: DataFrame,
    length: int,
    columns: Callable[[WindowSpec, WindowSpec], dict[str, Column]],
    by: str = CARD,
    time: str = TIME,
    key: str = KEY,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add columns over each row's last ``length`` rows of the same card (itself included).

    ``columns(frame, order)`` gives the expressions for the row frame and the plain order.
    Cards with more than ``chunk_rows`` rows are cut into chunks along time; each chunk is
    preceded by the last ``length - 1`` rows before it, so every window is whole.
    Rows without a card form a window of their own.
    """
    original = df.columns
    base = df.withColumns(
        {"_t": numeric_key(df, time), "_i": numeric_key(df, key)}
    ).withColumn("_alone", F.when(F.col(by).isNull(), F.col("_i")))
    rows, hot, order = _with_chunks(base, by, ["_t", "_i"], chunk_rows or CHUNK_ROWS)
    sort = [F.asc_nulls_last(c) for c in order]
    if hot and length > 1:
        last = Window.partitionBy(by, "_chunk").orderBy(*[F.desc_nulls_first(c) for c in order])
        tails = (
            rows.where(is_one_of(F.col(by), hot))
            .withColumn("_back", F.row_number().over(last))
            .where(F.col("_back") < length)
            .drop("_back")
        )
        along = Window.partitionBy(by).orderBy("_chunk", *sort)
        carried = [c for c in rows.columns if c not in (by, "_chunk")]
        halo = (
            tails.withColumn("_prev", F.lag("_chunk").over(along))
            .withColumn(
                "_before",
                F.collect_list(F.struct(*carried)).over(along.rowsBetween(1 - length, -1)),
            )
            .where(F.col("_prev").isNotNull() & (F.col("_prev") != F.col("_chunk")))
            .select(by, "_chunk", F.inline("_before"))
        )
        rows = rows.withColumn("_halo", F.lit(False)).unionByName(
            halo.withColumn("_halo", F.lit(True))
        )
    else:
        rows = rows.withColumn("_halo", F.lit(False))
    ordered = Window.partitionBy(by, "_alone", "_chunk").orderBy(*sort)
    new = columns(ordered.rowsBetween(1 - length, 0), ordered)
    return (
        rows.select("*", *[c.alias(n) for n, c in new.items()])
        .where(~F.col("_halo"))
        .select(*original, *new)
    )


def latest_rows(df: DataFrame, rows: int, by: str = CARD, time: str = TIME, key: str = KEY) -> DataFrame:
    """The latest ``rows`` rows of each card, all columns: what later windows can still reach.

    The limit is applied before the shuffle, so a hot card sends few rows per task. Rows without a
    card are windows of their own and reach no other row.
    """
    latest = Window.partitionBy(by).orderBy(F.desc_nulls_first(time), F.desc_nulls_first(key))
    known = df.where(F.col(by).isNotNull())
    return known.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= rows).drop("_back")


def trailing_sequences(df: DataFrame, length: int = 10, **options) -> DataFrame:
    """Add ``seq``: the trailing (amt, dt) pairs of each transaction in time order."""
    pair = F.struct(F.col(AMOUNT).alias("amt"), F.col(TIME).alias("dt"))
    return trailing(df, length, lambda frame, _: {"seq": F.collect_list(pair).over(frame)}, **options)


def sequence_features(df: DataFrame, length: int = 10, **options) -> DataFrame:
    """Add trailing length, mean, deviation, extremes of the amount and the gap in time."""

    def columns(frame: WindowSpec, order: WindowSpec) -> dict[str, Column]:
        amount = F.col(AMOUNT)
        return {
            "seq_len": F.count(F.lit(1)).over(frame),
            "seq_mean": F.avg(amount).over(frame),
            "seq_std": F.stddev_samp(amount).over(frame),
            "seq_min": F.min(amount).over(frame),
            "seq_max": F.max(amount).over(frame),
            "seq_gap": F.col(TIME) - F.lag(TIME).over(order),
        }

    return trailing(df, length, columns, **options)
