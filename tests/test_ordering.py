"""Rank selection, cuts, running totals, salted joins: against brute force, with hot values."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import ordering, skew, splits
from riskframe.operators.metrics import score_curve


def hot_frame(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [
        (i, 500 if rng.random() < 0.4 else rng.randrange(1000), rng.random() ** 5 * 1e6)
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "id bigint, t bigint, x double").repartition(4)


@pytest.mark.parametrize("leaf", [8, 100, 1 << 16])
@pytest.mark.parametrize("pivot_rows", [50, 1 << 20])
def test_select_ranks(spark, monkeypatch, leaf, pivot_rows):
    monkeypatch.setattr(ordering, "PIVOT_ROWS", pivot_rows)
    rows, df = hot_frame(spark)
    found = ordering.select_ranks(
        df,
        {"t": F.col("t"), "x": F.col("x")},
        lambda _, n: [0, 1, n // 3, n // 2, n - 1],
        leaf_rows=leaf,
    )
    for name, pos in (("t", 1), ("x", 2)):
        values = sorted(r[pos] for r in rows)
        n, hits = found[name]
        assert n == len(values)
        for rank, hit in hits.items():
            assert hit.value == values[rank]
            assert hit.below == values.index(hit.value)
            assert hit.equal == values.count(hit.value)


def test_select_ranks_of_huge_integers(spark):
    step = (1 << 62) // 500
    df = spark.range(1000).select((F.col("id") * step - (1 << 61)).alias("v"))
    _, hits = ordering.select_ranks(
        df, {"v": F.col("v")}, lambda _, n: [0, 499, 999], leaf_rows=4
    )["v"]
    assert [hits[r].value for r in (0, 499, 999)] == [r * step - (1 << 61) for r in (0, 499, 999)]


def test_hot_huge_integer_ends(spark):
    hot = (1 << 60) + 12345
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") * 7).alias("v")
    )
    _, hits = ordering.select_ranks(df, {"v": F.col("v")}, lambda _, n: [700], leaf_rows=4)["v"]
    assert hits[700] == ordering.Located(hot, 600, 300)


def test_exact_quantiles_skip_missing(spark):
    df = spark.createDataFrame(
        [(1.0, None), (2.0, None), (3.0, None), (10.0, None), (float("nan"), None)],
        "a double, b double",
    )
    keys = {c: ordering.numeric_key(df, c) for c in ("a", "b")}
    assert ordering.exact_quantiles(df, keys, [0.5]) == {"a": [2.5], "b": [None]}


@pytest.mark.parametrize("test_size", [0.2, 0.5, 0.77])
def test_split_inside_a_hot_time(spark, monkeypatch, test_size):
    monkeypatch.setattr(ordering, "LEAF_ROWS", 16)
    rows, df = hot_frame(spark)
    train, test = splits.temporal_train_test_split(df, "t", test_size, id_col="id")
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    k = int(len(rows) * (1 - test_size))
    assert {r.id for r in train.collect()} == set(want[:k])
    assert {r.id for r in test.collect()} == set(want[k:])


def test_split_inside_copies_of_one_row(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 400, F.lit(5)).otherwise(F.col("id")).alias("TransactionDT"),
        F.lit(1).alias("TransactionID"),
        F.lit("x").alias("payload"),
    )
    parts = splits.temporal_train_test_split(df, test_size=0.8, validation_size=0.1)
    assert [p.count() for p in parts] == [99, 100, 801]
    assert parts[2].where("TransactionDT = 5").count() == 400 - 199
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert together.exceptAll(df).count() == 0 and df.exceptAll(together).count() == 0


def test_walk_forward_inside_copies(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 600, F.lit(5)).otherwise(F.col("id")).alias("TransactionDT"),
        F.lit(1).alias("TransactionID"),
    )
    rows = splits.walk_forward_validation(df, n_splits=4, test_size=0.5)
    counts = {(r.split_id, r.role): r["count"] for r in rows.groupBy("split_id", "role").count().collect()}
    for i, (start, end) in enumerate(splits.walk_forward_plan(1000, 4, 0.5)):
        assert counts[i, "train"] == start and counts[i, "test"] == end - start


def test_cuts_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr(
        "id as TransactionID", "id * 7 as TransactionDT", "'x' as wide"
    ).write.parquet(path)
    for part in splits.temporal_train_test_split(spark.read.parquet(path)):
        plan = part.select("TransactionID")._jdf.queryExecution().toString()
        assert "PushedFilters: [" in plan and "TransactionDT" in plan.split("PushedFilters: [")[1][:80]
        assert "wide" not in plan.split("ReadSchema")[1]


def test_missing_times_come_last(spark):
    df = spark.createDataFrame(
        [(1, None), (2, 10), (3, 5), (4, None), (5, 7)], "TransactionID bigint, TransactionDT bigint"
    )
    train, test = splits.temporal_train_test_split(df, test_size=0.2)
    assert sorted(r.TransactionID for r in train.collect()) == [1, 2, 3, 5]
    assert [r.TransactionID for r in test.collect()] == [4]


def test_walk_forward_plan_matches_known_values():
    assert splits.walk_forward_plan(1000, 3, 0.2) == [(668, 868), (734, 934), (800, 1000)]
    with pytest.raises(ValueError):
        splits.walk_forward_plan(1000, 5, 0.95)


def test_running_sums_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SINGLE_BUCKET_ROWS", 10)
    rng = random.Random(3)
    rows = [(0.25 if rng.random() < 0.35 else rng.random(), rng.randrange(2)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, isFraud int")
    curve = score_curve(df).collect()
    assert len({r.key_bucket for r in curve}) > 3
    for r in random.Random(4).sample(curve, 50):
        above = [y for s, y in rows if s >= -r.key]
        assert (r.cum_pos, r.cum_neg) == (sum(above), len(above) - sum(above))


def test_dense_codes_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SINGLE_BUCKET_ROWS", 10)
    monkeypatch.setattr(ordering, "STRING_BOUNDS", 7)
    words = [f"user_{i * 37 % 1009}" for i in range(1009)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.code for r in ordering.dense_codes(df, "w", "code").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, null_safe):
    left = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id"))
        .cast("bigint")
        .alias("k"),
    )
    right = spark.createDataFrame(
        [(7, "a"), (7, "b"), (None, "n"), (11, "c"), (2999, "d"), (-1, "e")], "k bigint, v string"
    )
    assert set(skew.hot_keys(left, "k", 0.1)) == {7, None}
    got = skew.salted_join(left, right, "k", null_safe=null_safe, share=0.1)
    r = right.withColumnRenamed("k", "rk")
    match = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    want = left.join(r, match, "left").drop("rk")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salt_tiers_follow_the_share():
    tiers = skew.salt_tiers({"a": 0.33, "b": 0.001, None: 0.3}, 1000)
    assert sorted((p, sorted(map(str, k))) for p, k in tiers.items()) == [
        (8, ["b"]),
        (1000, ["None", "a"]),
    ]


def test_salt_spreads_copies(spark):
    df = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"))
    assert df.select(skew.spread(df, 8).alias("s")).distinct().count() == 8


def test_lookup_join_without_broadcast(spark, monkeypatch):
    left = spark.range(500).select((F.col("id") % 5).cast("string").alias("k"))
    lookup = spark.createDataFrame([(str(i), i) for i in range(4)], "k string, v int")
    small = skew.lookup_join(left, lookup, "k")
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    large = skew.lookup_join(left, lookup, "k")
    assert small.exceptAll(large).count() == 0 and large.count() == 500
