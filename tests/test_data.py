"""Loader, quality checks, features."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.operators import quality
from riskframe.operators.features import FeatureEngineer
from riskframe.sources.payments import PaymentTrainer, prepare_payments, read_payments
from riskframe.sources.transactions import (
    TransactionLoader,
    left_merge,
    quick_load_and_validate,
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "train_transaction.csv").write_text(
        "TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,V1\n"
        "1,0,86400,10.5,W,1\n2,1,90000,20,C,\n3,0,95000,NaN,,0.5\n"
    )
    (tmp_path / "train_identity.csv").write_text("TransactionID,DeviceType,id_01\n1,mobile,-5\n1,desktop,-6\n")
    (tmp_path / "test_transaction.csv").write_text(
        "TransactionID,TransactionDT,TransactionAmt\n9,100,1.0\n"
    )
    return str(tmp_path)


def test_load_merges_and_types(spark, folder):
    df = TransactionLoader(spark, folder).load()
    assert dict(df.dtypes) == {
        "TransactionID": "bigint",
        "isFraud": "int",
        "TransactionDT": "bigint",
        "TransactionAmt": "double",
        "ProductCD": "string",
        "V1": "double",
        "DeviceType": "string",
        "id_01": "int",
    }
    rows = {(r.TransactionID, r.DeviceType): r for r in df.collect()}
    assert set(rows) == {(1, "mobile"), (1, "desktop"), (2, None), (3, None)}
    assert rows[3, None].TransactionAmt is None


def test_named_types_need_no_inference(spark, folder):
    from pyspark.sql import types as T

    loader = TransactionLoader(
        spark, folder, column_types={"DeviceType": T.StringType(), "id_01": T.DoubleType()}
    )
    assert dict(loader.load().dtypes)["id_01"] == "double"


def test_load_test_role_without_identity(spark, folder):
    df = TransactionLoader(spark, folder).load(load_test=True)
    assert [tuple(r) for r in df.collect()] == [(9, 100, 1.0)]


def test_missing_sources(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError):
        TransactionLoader(spark, str(tmp_path / "nowhere"))
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        TransactionLoader(spark, str(empty)).load()
    with pytest.raises(ValueError):
        TransactionLoader(spark, folder, "xml")


def test_parquet_loader_and_quick_load(spark, folder, tmp_path):
    out = tmp_path / "pq"
    spark.range(3).selectExpr(
        "id as TransactionID", "id * 10 as TransactionDT", "double(id) as TransactionAmt"
    ).write.parquet(str(out / "train_transaction.parquet"))
    assert TransactionLoader(spark, str(out), "parquet").load().count() == 3
    assert quick_load_and_validate(spark, folder).count() == 4


def test_required_columns(spark, folder):
    with pytest.raises(ValueError, match="TransactionAmt"):
        TransactionLoader(spark, folder).validate(spark.range(1).selectExpr(
            "id as TransactionID", "id as TransactionDT"))


def test_left_merge_renames_and_matches_missing_keys(spark):
    a = spark.createDataFrame([(1, 5), (None, 6)], "TransactionID bigint, v int")
    b = spark.createDataFrame([(None, 7), (2, 8)], "TransactionID bigint, v int")
    rows = left_merge(a, b)
    assert rows.columns == ["TransactionID", "v_x", "v_y"]
    assert {tuple(r) for r in rows.collect()} == {(1, 5, None), (None, 6, 7)}


def test_basic_stats_and_report(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 0), (1, float("nan"), 1), (None, None, 0), (None, 2.0, 0)],
        "TransactionID bigint, TransactionAmt double, isFraud int",
    )
    loader = TransactionLoader(spark, "/tmp")
    assert loader.get_basic_stats(df) == {
        "n_rows": 4,
        "n_columns": 3,
        "fraud_count": 1,
        "fraud_rate": 0.25,
        "missing_values": {"total": 4, "columns_with_missing": 2},
    }
    assert quality.duplicate_count(df).first()[0] == 2
    status = {r.check_name: (r.value, r.status) for r in quality.quality_report(df).collect()}
    assert status["duplicates"] == (2.0, "warning") and status["label_rate"] == (0.25, "ok")


def test_high_missing_keeps_ten(spark):
    df = spark.range(4).select(
        *[F.when(F.col("id") < (i % 3), F.lit(1)).alias(f"c{i:02d}") for i in range(36)]
    )
    rows = quality.high_missing(df).collect()
    assert len(rows) == 10 and all(r.missing_pct == 100.0 for r in rows)
    assert [r.column_name for r in rows] == [f"c{i:02d}" for i in range(0, 30, 3)]


@pytest.mark.parametrize("frac", [0.0, 0.33, 1.0])
def test_sample_exact_size(spark, frac):
    df = spark.range(1000).select(
        F.when(F.col("id") < 400, F.lit(1)).otherwise(F.col("id")).alias("TransactionID")
    )
    sample = quality.sample_exact(df, frac)
    assert sample.count() == round(1000 * frac)
    assert sample.exceptAll(df).count() == 0
    assert quality.sample_exact(df, frac, portable=True).count() == round(1000 * frac)
    assert quality.sample_exact(df.withColumnRenamed("TransactionID", "x"), frac).count() == round(
        1000 * frac
    )


def test_scalar_edge_cases(spark):
    df = spark.createDataFrame([(-0.25, -1), (-1.0, 90000), (-2.0, 0)], "a double, t bigint")
    rows = df.select(
        X.amount_log(F.col("a")),
        X.amount_decimal(F.col("a")),
        X.hour_of_offset(F.col("t")),
        X.day_of_offset(F.col("t")),
        X.ratio(F.col("a"), 0.0),
    ).collect()
    assert rows[0][0] == pytest.approx(math.log(0.75)) and rows[0][1] == 0.75
    assert rows[0][2:4] == (23, 6) and rows[1][2:4] == (1, 1)
    assert rows[1][0] == float("-inf") and rows[2][0] is None
    assert rows[0][4] is None


def test_fit_learns_from_training_rows_only(spark):
    train = spark.createDataFrame(
        [(100.0, 1000, 0), (200.0, 2000, 1), (300.0, 3000, 0)],
        "TransactionAmt double, TransactionDT bigint, isFraud int",
    )
    test = spark.createDataFrame(
        [(1000.0, 4000, 1), (2000.0, 5000, 0)],
        "TransactionAmt double, TransactionDT bigint, isFraud int",
    )
    engineer = FeatureEngineer().fit(train)
    assert engineer.state.amount_mean == 200 and engineer.state.amount_median == 200
    assert engineer.state.amount_std == 100
    first = engineer.transform(test).orderBy("TransactionDT").first()
    assert first.amount_vs_mean == 5.0 and first.hour == 1
    assert FeatureEngineer().fit_transform(train).count() == 3


def test_transform_before_fit(spark):
    with pytest.raises(ValueError):
        FeatureEngineer().transform(spark.range(1))


def test_prepare_drops_codes_and_fills(spark):
    train = spark.createDataFrame(
        [(1, 1.0, "b", True), (2, None, "a", None), (3, float("nan"), None, False)],
        "TransactionID bigint, feature1 double, kind string, flag boolean",
    )
    engineer = FeatureEngineer().fit(train)
    ready = engineer.prepare_for_model(train)
    assert ready.columns == ["feature1", "kind", "flag"]
    assert {tuple(r) for r in ready.collect()} == {(1.0, 1, 1), (-999.0, 0, -999), (-999.0, -1, 0)}
    later = spark.createDataFrame([(4, 2.0, "zz", True)], train.schema)
    assert engineer.prepare_for_model(later).first().kind == -1
    assert engineer.prepare_for_model(later, mode="per_frame").first().kind == 0
    with pytest.raises(ValueError):
        engineer.check_features(["feature1"])


def test_state_roundtrip_without_strings(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (3.0,)], "TransactionAmt double")
    FeatureEngineer().fit(df).save(str(tmp_path / "s"), spark)
    again = FeatureEngineer.load(str(tmp_path / "s"), spark)
    assert again.state.amount_mean == 2.0 and again.transform(df).count() == 2
    with pytest.raises(ValueError):
        FeatureEngineer().save(str(tmp_path / "t"), spark)


def test_scratch_lies_in_the_named_folder(spark):
    from riskframe import session

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = session.scratch_root(spark)
    assert base is None or root.startswith(base.rstrip("/"))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    table = session.materialise(spark.range(5), "five")
    assert table.count() == 5 and root.split("file:")[-1] in table.inputFiles()[0]
    assert session.balanced(table).count() == 5


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from riskframe import session

    path, n = str(tmp_path / "one.parquet"), 40_000
    pq.write_table(pa.table({"a": list(range(n)), "b": [f"{i:0>40}" for i in range(n)]}), path, row_group_size=n)
    monkeypatch.setattr(session, "SPREAD_ROWS", 1000)
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        table = spark.read.parquet(path)
        assert table.rdd.getNumPartitions() >= 8  # by bytes the file has splits enough
        assert session._most_rows(table) == (n, n)
        for dealt in (session.balanced(table), session.spread(table, "dealt")):
            total, most = session._most_rows(dealt)
            assert total == n and most <= n / 4
            assert dealt.agg(F.sum("a")).first()[0] == n * (n - 1) // 2
        even = table.repartition(16)
        assert session.balanced(even) is even and session.spread(even, "even") is even
        assert session.spread(table.limit(0), "none").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)


# -- payments -----------------------------------------------------------------------------------


def payments_csv(tmp_path, n=700):
    """A file in the payments layout; every value follows from the row number."""
    from riskframe.sources.schemas import PAYMENTS

    def cell(field, i):
        kind = field.dataType.simpleString()
        if field.name == "fraud_bool":
            return str(int(i * 37 % 100 < 6))
        if kind == "timestamp":
            return (dt.datetime(2031, 5, 2, 6) + dt.timedelta(minutes=47 * i)).isoformat(" ")
        if kind == "double":
            return f"{(i * 7.31) % 480 + 2:.2f}"
        if kind == "boolean":
            return "true" if i % 5 < 2 else "false"
        if field.name == "transaction_id":
            return f"row{i}"
        return f"{field.name[:3]}-{i * 13 % (len(field.name) + 4)}"

    lines = [",".join(PAYMENTS.fieldNames())]
    lines += [",".join(cell(f, i) for f in PAYMENTS) for i in range(n)]
    path = tmp_path / "payments.csv"
    path.write_text("\n".join(lines))
    return str(path)


def test_payments_are_prepared_alike(spark, tmp_path):
    path = payments_csv(tmp_path)
    first = PaymentTrainer(path, n_trials=5, spark=spark)
    rows = first.load_and_prepare_data()
    assert rows.count() == 700 and first.model is None
    assert {r[0] for r in rows.select("fraud_bool").distinct().collect()} <= {0, 1}
    second = PaymentTrainer(path, spark=spark)
    assert second.load_and_prepare_data().columns == rows.columns
    assert first.feature_columns == second.feature_columns == sorted(first.feature_columns)
    assert rows.where("is_international not in (0, 1)").count() == 0
    _, names = prepare_payments(read_payments(spark, path))
    assert names == first.feature_columns


def test_payment_training(spark, tmp_path):
    from riskframe.operators.models import BoostedTrees

    trainer = PaymentTrainer(
        payments_csv(tmp_path), n_trials=2, spark=spark, base=BoostedTrees(max_iter=2)
    )
    with pytest.raises(ValueError, match="Model has not been trained yet"):
        trainer.save_model(str(tmp_path / "m"))
    report = trainer.train()
    for name in ("roc_auc", "recall", "precision", "f1_score"):
        assert 0 <= report[name] <= 1
    assert report["training_time_seconds"] > 0 and trainer.trials.count() == 2
    trainer.save_model(str(tmp_path / "m"))
    assert (tmp_path / "m" / "model").exists()


def test_validation_warns(spark, tmp_path):
    rows = "\n".join(f"{i // 2},0,{i},1.5,W" for i in range(40))
    (tmp_path / "train_transaction.csv").write_text("TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD\n" + rows)
    with pytest.warns(UserWarning, match="duplicates"):
        assert quick_load_and_validate(spark, str(tmp_path)).count() == 40


def test_payment_codes_come_from_the_training_slice(spark, sf_dir):
    from riskframe.sources import views
    from riskframe.sources.payments import CATEGORIES, split_payments

    parts, names = split_payments(views.payments(spark, sf_dir), 0.2)
    raw = {r.transaction_id: r for r in views.payments(spark, sf_dir).collect()}
    rows = [part.collect() for part in parts]
    assert sum(map(len, rows)) == len(raw) and set(CATEGORIES) < set(names)
    for c in CATEGORIES:
        seen = sorted({raw[r.transaction_id][c] for r in rows[0]} - {None})
        for r in rows[0] + rows[1] + rows[2]:
            value = raw[r.transaction_id][c]
            assert r[c] == (seen.index(value) if value in seen else -1)
