"""Helpers of the corpus operators: exact numbering without one-task orders, files on shared storage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.session import materialise, scratch_path, shuffle_width

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A word is a maximal run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with the equivalent SQL where there is one."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; NULL counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def with_row_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` written once with a unique row number, which therefore survives a lost executor."""
    numbered = df.withColumn(column, F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, name)
    numbered.write.option("compression", "zstd").parquet(path)  # rows as wide as texts
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def running(
    df: DataFrame, group: str, order: list, value: str | None, out: str, name: str
) -> DataFrame:
    """Adds ``out``: rows (or the sum of ``value``) of the same group that precede each row.

    The table is cut into ranges of (group, order) small enough for one task each, so that a group
    of any size spreads over many tasks; only one row per range and group meets in a window. Give
    an order without ties where the result must not depend on the layout. ``group`` holds no NULL.
    """
    spark = df.sparkSession
    at, piece, first, before = (free_name(df, c) for c in ("_at", "_piece", "_first", "_before"))
    keys = [F.col(group), *order]
    placed = materialise(
        df.repartitionByRange(shuffle_width(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(at, F.monotonically_increasing_id())
        .withColumn(piece, F.shiftright(at, 33)),
        name,
    )
    amount = F.lit(1).cast("bigint") if value is None else F.col(value).cast("bigint")
    earlier = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        placed.groupBy(group, piece)
        .agg(F.sum(amount).alias("_n"), F.min(at).alias(first))
        .withColumn(before, F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    if value is None:
        joined = placed.join(pieces, [group, piece])
        return joined.withColumn(out, F.col(before) + F.col(at) - F.col(first)).drop(
            at, piece, first, before
        )
    inside = (
        Window.partitionBy(group, piece).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = placed.withColumn(out, F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(
        pieces, [group, piece]
    )
    return joined.withColumn(out, F.col(out) + F.col(before)).drop(at, piece, first, before)


# -- files that tasks write below a shared folder ------------------------------------------------


def opened(path: str):
    """(file system, path on it) for a URI or plain path, usable in any task."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder on the storage that all executors share."""
    path = scratch_path(spark, name)
    system, inside = opened(path)
    system.create_dir(inside, recursive=True)
    return path


def attempt_name(kind: str) -> str:
    """A file name of this task attempt alone: a repeated attempt never meets an older file."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{kind}-{context.partitionId():06d}-{context.taskAttemptId()}"


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for models that are slow to load."""
    import sys
    import types

    name = "_riskframe_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__
