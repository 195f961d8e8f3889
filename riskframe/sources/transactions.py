"""Transaction and identity tables: scan, left merge, sampling, validation."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskframe.functions.expressions import nan_to_null
from riskframe.operators import quality
from riskframe.operators.skew import measured_join
from riskframe.sources.schemas import REQUIRED_COLUMNS, known_type

KEY = "TransactionID"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_csv(
    spark: SparkSession, path: str, column_types: dict[str, T.DataType] | None = None
) -> DataFrame:
    """CSV with header: types by ``column_types``, then by contract, the rest by inference.

    Inference reads the file once more; name the types of large files.
    """
    column_types = column_types or {}
    reader = spark.read.option("header", True).option("nanValue", "NaN")
    names = reader.csv(path).columns
    types = {n: column_types.get(n) or known_type(n) for n in names}
    if any(t is None for t in types.values()):
        inferred = reader.option("inferSchema", True).csv(path).schema
        types = {f.name: types[f.name] or f.dataType for f in inferred}
    schema = T.StructType([T.StructField(n, types[n]) for n in names])
    return nan_to_null(reader.schema(schema).csv(path))


def left_merge(left: DataFrame, right: DataFrame, key: str = KEY) -> DataFrame:
    """Left outer merge that fans out on repeated keys and matches missing keys to each other.

    Other columns that both sides have get the suffixes ``_x`` and ``_y``.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    left = left.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return measured_join(left, right, key, null_safe=True)


class TransactionLoader:
    """Loads the train or test pair of tables of a folder.

    ``fmt`` is ``csv`` (files) or ``parquet`` (files or folders); ``column_types`` names types
    of CSV columns.
    """

    def __init__(
        self,
        spark: SparkSession,
        data_dir: str = "data/raw",
        fmt: str = "csv",
        column_types: dict[str, T.DataType] | None = None,
    ):
        if fmt not in ("csv", "parquet"):
            raise ValueError(f"unknown format: {fmt}")
        self.spark, self.data_dir, self.fmt = spark, data_dir.rstrip("/"), fmt
        self.column_types = column_types
        if not path_exists(spark, self.data_dir):
            raise FileNotFoundError(f"no data directory at {data_dir}")

    def _path(self, role: str, table: str) -> str:
        return f"{self.data_dir}/{role}_{table}.{self.fmt}"

    def _read(self, path: str) -> DataFrame:
        if self.fmt == "csv":
            return read_csv(self.spark, path, self.column_types)
        return nan_to_null(self.spark.read.parquet(path))

    def load(
        self, load_test: bool = False, sample_frac: float | None = None, seed: int = 42
    ) -> DataFrame:
        role = "test" if load_test else "train"
        transactions = self._path(role, "transaction")
        if not path_exists(self.spark, transactions):
            raise FileNotFoundError(f"no transaction table at {transactions}")
        df = self._read(transactions)
        identity = self._path(role, "identity")
        if path_exists(self.spark, identity):
            df = left_merge(df, self._read(identity))
        if sample_frac is not None:
            df = quality.sample_exact(df, sample_frac, seed)
        return df

    def validate(self, df: DataFrame) -> DataFrame:
        """Raise if required columns are missing, else return the quality report."""
        check_required(df)
        return quality.quality_report(df)

    def get_basic_stats(self, df: DataFrame) -> dict:
        """Row, column, label and missing-value counts."""
        row = quality.basic_stats(df).first().asDict()
        stats = {"n_rows": row["n_rows"], "n_columns": row["n_columns"]}
        if "fraud_count" in row:
            stats["fraud_count"], stats["fraud_rate"] = row["fraud_count"], row["fraud_rate"]
        stats["missing_values"] = {
            "total": row["missing_total"],
            "columns_with_missing": row["columns_with_missing"],
        }
        return stats


def warn_of(report: DataFrame) -> DataFrame:
    """Compute a quality report (one row per check) and warn of every check that isn't ok."""
    for row in report.where("status <> 'ok'").collect():
        warnings.warn(f"data quality: {row['check_name']} is {row['value']}", stacklevel=2)
    return report


def check_required(df: DataFrame) -> None:
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")


def quick_load_and_validate(
    spark: SparkSession, data_dir: str = "data/raw", sample_frac: float | None = None
) -> DataFrame:
    loader = TransactionLoader(spark, data_dir)
    df = loader.load(sample_frac=sample_frac)
    warn_of(loader.validate(df))
    return df
