"""Nearest neighbours: exact where one partition does, recall beyond, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import ann


def exact(ids, x, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T
    return {
        int(ids[i]): [int(v) for _, v in sorted((-round(near[i, j], 12), ids[j]) for j in range(len(ids)) if ids[j] != ids[i])[:k]]
        for i in range(len(ids)) if ids[i] % 50 == 0
    }


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def clustered(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 1, (20, d))[rng.integers(0, 20, n)] + rng.normal(0, 0.4, (n, d))


def test_partitions_are_balanced_and_cut_few_edges():
    x = ann.unit(clustered(1200))
    graph = ann.neighbour_graph(x, 8)
    part = ann.balanced_partitions(x, graph, 6)
    assert np.bincount(part, minlength=6).min() >= 170 and np.bincount(part).max() <= 230
    random = np.random.default_rng(1).permutation(part)
    assert (part[graph] != part[:, None]).mean() < 0.5 * (random[graph] != random[:, None]).mean()


def test_query_recall_against_brute_force(spark, sf_dir, monkeypatch):
    from riskframe.llm.queries import QUERIES

    routers, learn = [], ann.Search.learn
    monkeypatch.setattr(ann.Search, "learn", lambda *a: routers.append(learn(*a)) or routers[-1])
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    want = exact([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
    got = found(QUERIES["op7_learned_partitions"](spark, sf_dir))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    assert len(routers[0].weights[3]) >= 2  # some hundred vectors have a graph, partitions and a router


@pytest.mark.parametrize("n", [600, 2500])
def test_recall_with_few_of_the_partitions(spark, n, monkeypatch):
    routers, learn = [], ann.Search.learn
    monkeypatch.setattr(ann.Search, "learn", lambda *a: routers.append(learn(*a)) or routers[-1])
    x = clustered(n).round(4)
    ids = np.arange(len(x)) * 10
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    search = ann.Search(chunk=64, block=7)
    got, want = found(search.nearest(df, F.col("vec_id") % 50 == 0)), exact(ids, x)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    assert len(routers[0].weights[3]) == round(n**0.5 / 2) and routers[0].probes <= len(routers[0].weights[3]) / 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, None), (50, [0.0, 0.0]), (100, [1.0, nan]), (150, [1.0, None]), (200, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]),
        (3, [0.0, 1.0]), (None, [1.0, 1.0]), (200, [1.0, 0.0]), (7, [1.0]), (8, [inf, 1.0]), (9, []),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = ann.Search().nearest(df, F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == [(200, 1, 1, 1.0), (200, 2, 2, 1.0), (200, 3, 3, 0.0)]
    assert ann.Search().nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(400)] + [(1000 + i, [float(i), 1.0, -1.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.Search(least=8, graph_k=2).nearest(df, F.col("vec_id") % 50 == 0))
    for q in range(0, 400, 50):
        assert got[q] == [i for i in range(7) if i != q][:5]
