"""Tables by day: same splits as without, days and row groups skipped, a hot second, odd times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskframe.operators import splits
from riskframe.session import scratch_path
from riskframe.sources import layout

START = dt.datetime(2024, 1, 1)


def derive(df):
    return df.select(F.col("id").alias("TransactionID"), (F.unix_seconds("at") - 1704067200).alias("TransactionDT"))


@pytest.fixture(scope="module")
def events(spark):
    rows = [(i, START + dt.timedelta(hours=i * 7 % 400, seconds=i / 3)) for i in range(300)]
    rows += [(1000 + i, START + dt.timedelta(days=9)) for i in range(150)]  # a third in one second
    rows += [(2000, None), (2001, START - dt.timedelta(days=2)), (5, START)]
    return spark.createDataFrame(rows, "id long, at timestamp")


@pytest.fixture(scope="module")
def stored(spark, events):
    path = scratch_path(spark, "layout")
    layout.write_by_day(events, path, "at", "id")
    return spark.read.parquet(path)


@pytest.mark.parametrize("sizes", [(0.2, 0.0), (0.3, 0.2), (0.5, 0.0), (0.001, 0.0), (1.0, 0.0)])
def test_parts_equal_those_of_the_plain_split(events, stored, sizes):
    got = layout.split_by_time(stored, "at", derive, 1704067200, *sizes)
    want = splits.temporal_train_test_split(derive(events), test_size=sizes[0], validation_size=sizes[1])
    assert [sorted(map(str, p.collect())) for p in got] == [sorted(map(str, p.collect())) for p in want]


def test_days_and_times_are_skipped(stored):
    train, test = layout.split_by_time(stored, "at", derive, 1704067200)
    for part, sign in ((train, "<"), (test, ">")):
        plan = part._jdf.queryExecution().executedPlan().toString()
        folders = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
        assert "_day" in folders and sign in folders
        assert ("LessThan(at" if sign == "<" else "GreaterThanOrEqual(at") in pushed


def test_a_hot_second_fills_several_files(stored):
    hot = stored.where("_day = 19732").groupBy(F.input_file_name()).count()
    assert hot.count() > 1


def test_empty_table(spark, events):
    path = scratch_path(spark, "layout-empty")
    layout.write_by_day(events.where("id < 0"), path, "at", "id")
    none = spark.read.schema("id long, at timestamp, _day int").parquet(path)
    assert [p.count() for p in layout.split_by_time(none, "at", derive, 0)] == [0, 0]
