"""Graph, sequences, stress test."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import graph, sequences, skew, stress

GRAPH = [
    (1, 100.0, 1000, "A", "W", "D1", 0),
    (2, 200.0, 2000, "B", "W", "D2", 1),
    (3, 300.0, 3000, "A", "C", "D1", 0),
]
SCHEMA = (
    "TransactionID bigint, TransactionAmt double, TransactionDT bigint, card1 string, "
    "ProductCD string, DeviceInfo string, isFraud int"
)


@pytest.fixture
def small(spark):
    return spark.createDataFrame(GRAPH, SCHEMA)


def test_nodes_and_edges(spark, small):
    kinds = {r.node_type: r["count"] for r in graph.graph_nodes(small).groupBy("node_type").count().collect()}
    assert kinds == {"transaction": 3, "user": 2, "merchant": 2, "device": 2}
    extra = small.unionByName(
        spark.createDataFrame([(4, 5.0, 1, None, "W", None, 0)], SCHEMA)
    )
    edges = graph.graph_edges(extra).where("TransactionID = 4").collect()
    assert [(e.edge_type, e.node_id) for e in edges] == [("transaction_to_merchant", 1)]


@pytest.mark.parametrize("limit", [None, 0])
def test_graph_features(small, monkeypatch, limit):
    if limit is not None:  # no broadcast: the salted path
        monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
    rows = {r.TransactionID: r for r in graph.graph_features(small).collect()}
    assert (rows[1].user_mean_1, rows[1].merchant_mean_1, rows[1].device_mean_1) == (200, 150, 200)
    assert (rows[1].user_degree, rows[2].user_degree) == (2, 1)
    h = {1: (100 + 200 + 150 + 200) / 4, 2: (200 + 200 + 150 + 200) / 4, 3: (300 + 200 + 300 + 200) / 4}
    assert rows[1].merchant_mean_2 == pytest.approx((h[1] + h[2]) / 2)
    assert rows[3].user_mean_2 == pytest.approx((h[1] + h[3]) / 2)


def test_label_rates_leave_out_the_own_label(small):
    stats = graph.fit_node_stats(small, 1, label="isFraud")
    own = {r.TransactionID: r for r in graph.apply_node_stats(small, stats, True).collect()}
    assert own[1].merchant_label_rate == 1.0 and own[2].merchant_label_rate == 0.0
    assert own[3].merchant_label_rate is None
    later = {r.TransactionID: r for r in graph.apply_node_stats(small, stats).collect()}
    assert later[1].merchant_label_rate == 0.5


def test_card_sequences(spark):
    rows = list(
        zip(range(5), "AABBB", [100.0, 200.0, 150.0, 250.0, 300.0], [1000, 2000, 1500, 2500, 3000], [0, 0, 1, 0, 1])
    )
    df = spark.createDataFrame(
        rows, "TransactionID bigint, card1 string, TransactionAmt double, TransactionDT bigint, isFraud int"
    )
    built = {r.card1: r for r in sequences.SequenceBuilder(10).build_sequences(df).collect()}
    assert len(built) == 2 and all(len(r.seq) == len(r["mask"]) == 10 for r in built.values())
    assert [tuple(e) for e in built["A"].seq[:3]] == [(100.0, 1000), (200.0, 2000), (0.0, 0)]
    assert built["B"]["mask"] == [True] * 3 + [False] * 7 and built["B"].label == 1
    short = {r.card1: r for r in sequences.SequenceBuilder(2).build_sequences(df).collect()}
    assert [e.amt for e in short["B"].seq] == [250.0, 300.0]


def test_row_limit_is_applied_before_the_shuffle(spark, sf_dir):
    from riskframe.sources import views

    df = sequences.SequenceBuilder(10).build_sequences(views.transactions(spark, sf_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:], plan


def brute_trailing(rows, length):
    """rows: (id, card, dt, amt) -> {id: [amounts]}"""
    past, out = {}, {}
    for i, card, t, amt in sorted(rows, key=lambda r: (r[2], r[0])):
        key = card if card is not None else ("alone", i)
        past.setdefault(key, []).append(amt)
        out[i] = past[key][-length:]
    return out


@pytest.mark.parametrize("length", [1, 4])
@pytest.mark.parametrize("hot_time", [False, True])
def test_trailing_windows_of_hot_cards(spark, length, hot_time):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        card = rng.choice(["hot", "hot", "warm", "warm", f"c{i % 50}", None])
        t = 77 if hot_time and rng.random() < 0.4 else rng.randrange(300)
        rows.append((i, card, t, float(i)))
    df = spark.createDataFrame(
        rows, "TransactionID bigint, card1 string, TransactionDT bigint, TransactionAmt double"
    ).repartition(4)
    got = sequences.trailing_sequences(df, length, chunk_rows=100)
    assert got.columns == [*df.columns, "seq"]
    found = {r.TransactionID: [e.amt for e in r.seq] for r in got.collect()}
    assert got.count() == 3000
    assert found == brute_trailing(rows, length)


def test_trailing_windows_over_copies(spark):
    """A third of all rows are copies of one row; each still has its own window."""
    df = spark.range(0, 1500, 1, 4).select(
        F.when(F.col("id") < 500, F.lit(-1)).otherwise(F.col("id")).alias("TransactionID"),
        F.lit("hot").alias("card1"),
        F.when(F.col("id") < 500, F.lit(700)).otherwise(F.col("id")).alias("TransactionDT"),
        F.when(F.col("id") < 500, F.lit(1.0)).otherwise(F.lit(0.0)).alias("TransactionAmt"),
    )
    got = sequences.sequence_features(df, 3, chunk_rows=100)
    rows = got.select("seq_len", "TransactionDT", "seq_mean").collect()
    assert len(rows) == 1500
    assert sorted(r.seq_len for r in rows)[:3] == [1, 2, 3]
    assert sum(r.seq_len < 3 for r in rows) == 2
    # windows holding k copies: 498 + the two rows at either end
    full = [r for r in rows if r.seq_mean == 1.0]
    assert len(full) == 498


def test_chunks_stay_small(spark):
    df = spark.range(5000).select(
        F.col("id").alias("_i"),
        F.lit("hot").alias("card1"),
        F.when(F.col("id") % 3 == 0, F.lit(9)).otherwise(F.col("id")).alias("_t"),
    )
    rows, hot, _ = sequences._with_chunks(df, "card1", ["_t", "_i"], 250)
    assert hot == ["hot"]
    sizes = [r["count"] for r in rows.groupBy("_chunk").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 500


# -- stress -------------------------------------------------------------------------------------


def test_state_and_actions(spark):
    df = spark.createDataFrame(
        [(1, 500.0, 14), (2, 100.0, 12), (3, 5000.0, 23), (4, -3.0, 0)],
        "TransactionID bigint, TransactionAmt double, hour int",
    )
    states = {r.TransactionID: r.state for r in stress.attack_state(df).collect()}
    assert states == {1: "amt_5_hr_2", 2: "amt_1_hr_2", 3: "amt_9_hr_3", 4: "amt_0_hr_0"}
    fixed = stress.attack_state(df.drop("hour"), "reference").first().state
    assert fixed == "amt_4_hr_2"
    old = {r.TransactionID: r for r in df.where("TransactionID < 4").collect()}
    for r in stress.perturb(df.where("TransactionID < 4")).collect():
        before = old[r.TransactionID]
        ratio = r.TransactionAmt / before.TransactionAmt
        if r.action == "increase_amount":
            assert 1.1 <= ratio <= 1.5
        elif r.action == "decrease_amount":
            assert 0.5 <= ratio <= 0.9
        elif r.action == "split_transaction":
            assert ratio == pytest.approx(1 / 2) or ratio == pytest.approx(1 / 3)
        else:
            assert ratio == 1.0
            low, high = (6, 11) if r.action == "change_time_early" else (18, 22)
            assert low <= r.hour <= high
        if r.action not in ("change_time_early", "change_time_late"):
            assert r.hour == before.hour
    assert stress.perturb(df.drop("hour")).where("action = 'change_time_early'").count() == 4


def test_best_action_prefers_the_earlier_one(spark):
    rows = spark.createDataFrame(
        [("s", 1, "b", 4, 2), ("s", 0, "a", 4, 2), ("s", 2, "c", 4, -4), ("t", 2, "c", 1, 1)],
        "state string, action_id int, action string, attempts bigint, total_reward bigint",
    )
    assert {tuple(r) for r in stress.best_actions(rows).collect()} == {("s", "a", 0.5), ("t", "c", 1.0)}
