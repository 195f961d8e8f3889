"""Search over folds, sequence vectors, stream outcomes on failure, joins per node type."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import graph, models
from riskframe.operators import search as search_module
from riskframe.operators.search import FoldedMatrix, FoldSearch
from riskframe.operators.sequence_network import SequenceNetwork, padded
from riskframe.operators.splits import walk_forward_plan
from riskframe.streaming import scoring

TINY = models.BoostedTrees(max_iter=4, max_depth=3)


@pytest.fixture(scope="module")
def rows(spark):
    x = F.pmod(F.xxhash64("TransactionID"), F.lit(1000)) / 1000.0
    out = spark.range(400).withColumnRenamed("id", "TransactionID").withColumn("x", x)
    fraud = (F.col("x") + F.pmod(F.xxhash64("TransactionID", F.lit(1)), F.lit(100)) / 400.0 > 0.8).cast("int")
    return out.withColumns({"TransactionDT": F.col("TransactionID") * 7 % 400, "y": F.lit(1.0), "isFraud": fraud})


def test_parts_of_the_folded_matrix(spark, rows):
    matrix = FoldedMatrix.write(rows, ["x", "TransactionDT"], "isFraud", 3, 0.3, "TransactionDT", "TransactionID")
    assert matrix.plan == walk_forward_plan(400, 3, 0.3)
    for fold, (start, end) in enumerate(matrix.plan):
        for role, lo, hi in (("train", 0, start), ("test", start, end)):
            part, n = matrix.part(fold, role)
            times = sorted(int(r["_features"][1]) for r in part.collect())
            assert times == list(range(lo, hi)) and n == hi - lo
    plan = matrix.part(0, "test")[0]._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_segment" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_search_halves_trials_and_writes_one_matrix(spark, rows, monkeypatch):
    written = []
    real = search_module.scratch_path
    monkeypatch.setattr(search_module, "scratch_path", lambda s, name: written.append(name) or real(s, name))
    search = FoldSearch(n_trials=4, folds=2, rungs=(0.5, 1.0), base=TINY)
    best, trials = search.run(rows, ["x", "y"])
    assert written == ["folded-matrix"]
    found = trials.collect()
    by_rung = {r: {t.trial for t in found if t.rung == r} for r in (0, 1)}
    assert len(by_rung[0]) == 4 and len(by_rung[1]) == 2 and len(found) == 12
    mean = {t: sum(r.score for r in found if r.trial == t and r.rung == 0) for t in by_rung[0]}
    assert by_rung[1] == set(sorted(mean, key=lambda t: (-mean[t], t))[:2])
    assert {r.trees for r in found} == {2, 4} and len({r.trial for r in found if r.rung == 1 and r.kept}) == 1
    assert best.trees.getNumTrees == 4 and max(r.score for r in found) > 0.8
    again = search.run(rows, ["x", "y"])[1].collect()
    assert sorted(again) == sorted(found)


def test_search_bins_each_fold_once_and_ranks_written_scores(spark, rows, monkeypatch):
    binned, ranked = [], []
    of, area = search_module.Binned.of, search_module.metrics.roc_auc
    monkeypatch.setattr(search_module.Binned, "of", staticmethod(lambda part, n=None: binned.append(n) or of(part, n)))

    def roc_auc(scored, *names):
        ranked.append(scored._jdf.queryExecution().toString())
        return area(scored, *names)

    monkeypatch.setattr(search_module.metrics, "roc_auc", roc_auc)  # also called by area_of_model
    FoldSearch(n_trials=4, folds=2, rungs=(0.5, 1.0), base=TINY).run(rows, ["x", "y"])
    assert sorted(binned) == [220, 280, 400]  # training rows of the folds, and all rows
    assert len(ranked) == 12 and not any("ArrowEvalPython" in plan for plan in ranked)


def test_folds_without_a_class_count_a_half(spark, rows):
    _, trials = FoldSearch(n_trials=1, folds=2, rungs=(1.0,), base=TINY).run(
        rows.withColumn("isFraud", (F.col("TransactionDT") < 100).cast("int")), ["x", "y"])
    assert {r.score for r in trials.collect()} == {0.5}


def test_search_of_slices_writes_one_matrix(spark, rows, monkeypatch):
    written = []
    real = models.materialise
    monkeypatch.setattr(models, "materialise", lambda df, name: written.append(name) or real(df, name))
    best, trials = models.ParameterSearch(n_trials=3, base=TINY).run(rows.where("TransactionDT < 300"), rows.where("TransactionDT >= 300"), ["x", "y"])
    assert written == ["matrix"] and trials.count() == 3 and best.features == ["x", "y"]


def test_padded_sequences(spark):
    seq = [(3.0, 10), (None, 20), (float("nan"), 25), (-5.0, None), (7.0, 40)]
    df = spark.createDataFrame([(seq,), (seq[:1],)], "seq array<struct<amt:double,dt:long>>")
    long, short = [r[0].toArray().tolist() for r in df.select(padded(F.col("seq"), 6)).collect()]
    log = math.log1p
    want = [log(7), 0, 1, 0, 0, 1, 0, log(15), 1, 0, log(20), 1, log(3), log(30), 1, 0, 0, 0]
    assert long == pytest.approx(want) and short == pytest.approx([log(3), 0, 1] + [0] * 15)


def test_network_is_stored_and_scores_later_rows(spark, tmp_path):
    base = spark.range(300).select(
        F.col("id").alias("TransactionID"), (F.col("id") * 10).alias("TransactionDT"), (F.col("id") % 7).cast("string").alias("card1"),
        F.when(F.col("id") % 5 == 0, 900.0).otherwise(10.0).alias("TransactionAmt"), (F.col("id") % 5 == 0).cast("int").alias("isFraud"))
    train, later = base.where("TransactionID < 200"), base.where("TransactionID >= 200")
    model = SequenceNetwork(4, hidden=(4,)).fit(train)
    scored = {r.TransactionID: r for r in model.predict_proba(later, train).collect()}
    assert len(scored) == 100 and all((r.fraud_probability > 0.5) == (r.isFraud == 1) for r in scored.values())
    model.save(str(tmp_path / "net"), spark)
    again = SequenceNetwork.load(str(tmp_path / "net"), spark)
    assert again.max_seq_len == 4 and again.model.kind == "sequence_network"
    for r in again.predict_later(later).collect():
        assert r.fraud_probability == pytest.approx(scored[r.TransactionID].fraud_probability, abs=1e-9)
    with pytest.raises(ValueError):
        SequenceNetwork().predict_proba(later)


def test_a_failed_and_a_repeated_batch_change_neither_output(spark, tmp_path):
    source = str(tmp_path / "in")
    bodies = ['{"transaction_id":"a","amount":50.0}', "", '[{"transaction_id":"b","amount":300.0},{"transaction_id":"c"}]', "nope"]
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "body string").coalesce(1)
    stream = lambda: spark.readStream.schema("body string").parquet(source)
    broken = [True]

    def scorer(df):
        if broken[0]:
            raise RuntimeError("lost")
        return scoring.rule_scorer(df)

    sink = scoring.OutcomeSink(spark, str(tmp_path / "out"), scorer)
    frame(bodies[:2]).write.parquet(source)
    with pytest.raises(Exception, match="lost"):
        sink.run(stream())
    broken[0] = False
    sink.run(stream())
    frame(bodies[2:]).write.mode("append").parquet(source)
    scored, errors = sink.run(stream())
    read = lambda: (sorted(scored.collect()), sorted(tuple(r) for r in errors.collect()))
    first = read()
    assert [(r.transaction_id, r.is_fraud) for r in first[0]] == [("a", False), ("b", True)]
    assert [(p, e) for _, p, e in first[1]] == [(0, "empty body"), (1, "amount missing"), (0, "invalid JSON")]
    sink.process(frame(bodies[2:]), 1)  # the same batch id once more
    scored, errors = sink.outcomes()
    assert read() == first


def test_batches_of_one_kind_only(spark, tmp_path):
    sink = scoring.OutcomeSink(spark, str(tmp_path / "out"), scoring.rule_scorer)
    sink.process(spark.createDataFrame([('{"transaction_id":"a","amount":1.0}',)], "body string"), 0)
    scored, errors = sink.outcomes()
    assert scored.count() == 1 and errors.count() == 0
    sink.process(spark.createDataFrame([(None,)], "body string"), 1)
    scored, errors = sink.outcomes()
    assert scored.count() == 1 and [(r.body, r.error) for r in errors.collect()] == [(None, "empty body")]


def test_one_join_per_node_type(spark):
    df = spark.createDataFrame(
        [(i, 10.0 * i, f"c{i % 3}", f"p{i % 2}", None if i % 4 else "d") for i in range(40)],
        "TransactionID long, TransactionAmt double, card1 string, ProductCD string, DeviceInfo string")
    plan = graph.apply_node_stats(df, graph.fit_node_stats(df, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3
