"""Session helpers: shared scratch space and written intermediate tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPREAD_ROWS = 100_000  # rows of a split that are not worth dealing out
SPLIT_ROWS = 2_000_000  # rows of a split of what is dealt out, beyond one split per core
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_ROOTS: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared one that ``spark.checkpoint.dir`` names.

    Without that setting it lies beside the warehouse, on the default file system that all
    executors share; a machine-local temporary folder is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch"
    root = f"{base.rstrip('/')}/riskframe/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)  # when the application's JVM ends
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote to its scratch folder.

    For long-running applications, between jobs: frames and feature states made before the call
    can no longer be read, saved models and states can.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch space and read it back.

    Cuts the lineage in a way that survives the loss of executors, and gives later stages the
    Parquet sizes from which Spark chooses its join strategy.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most: int):
    """Jobs run inside pass rows to Python in batches of about ``most`` bytes, one row at least.

    Spark's own limit is 64 MB, held by the JVM and the Python worker of every running task. A limit
    that the session sets already stands.
    """
    if spark.conf.get(ARROW_BYTES, None) is not None:
        yield
        return
    spark.conf.set(ARROW_BYTES, most)
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES)


def shuffle_width(spark: SparkSession) -> int:
    """Number of pieces into which global orders are cut: the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _most_rows(table: DataFrame) -> tuple[int, int]:
    """(rows, rows of the fullest split); the columns of a stored table are not read for that."""
    per_split = table.groupBy(F.spark_partition_id().alias("_split")).agg(F.count(F.lit(1)).alias("_n"))
    row = per_split.agg(F.sum("_n"), F.max("_n")).first()
    return row[0] or 0, row[1] or 0


def balanced(table: DataFrame) -> DataFrame:
    """A written table of fewer splits than cores, or with over twice a core's share of the rows in
    one split, dealt out to all cores.

    For row work that is heavy on the CPU. A row group is read by one task however many splits its
    file is cut into. Tables of many even splits come back as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    splits = table.rdd.getNumPartitions()
    if splits >= cores:
        n, most = _most_rows(table)
        if most * cores <= 2 * n:
            return table
    return table.repartition(max(cores, splits))


def spread(df: DataFrame, name: str) -> DataFrame:
    """``df`` for a job of many scans: written once, evenly, if one split holds too many of its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    n, most = _most_rows(df)
    if most <= SPREAD_ROWS or most * cores <= 2 * n:
        return df
    return materialise(df.repartition(max(cores, n // SPLIT_ROWS)), name)
