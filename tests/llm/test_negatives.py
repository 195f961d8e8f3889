"""Hard negatives against plain scoring of all pairs, SQL, certain bounds, odd rows."""

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from riskframe.llm.negatives import Codes, HardNegatives

TINY = HardNegatives(chunk=16, block=3)


def plain(rows, h):
    kept = sorted({(i, l, tuple(int(np.floor(h.scale * float(v))) for v in x)) for i, l, x in rows})
    out = []
    for i, label, x in kept:
        if i % 10:
            continue
        score = lambda y: sum(a * b for a, b in zip(x, y))
        others = sorted((-score(y), j, m) for j, m, y in kept if j != i and len(y) == len(x))
        for s, j, _ in [o for o in others if o[2] == label][: h.positives]:
            near = [o for o in others if o[2] != label and h.floor * -s <= 100 * -o[0] <= 100 * -s][: h.negatives]
            out += [(i, j, n + 1, o[1], -s, -o[0]) for n, o in enumerate(near)]
    return sorted(out)


def mined(df, h=TINY):
    return sorted(map(tuple, h.mine(df, F.col("vec_id") % 10 == 0).collect()))


def points(n, d=6, labels=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (5, d))[rng.integers(0, 5, n)] + rng.normal(0, 0.3, (n, d))
    return [(i, int(rng.integers(labels)), v) for i, v in enumerate(x.round(2).tolist())]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


@pytest.mark.parametrize("d", [1, 6, 64, 65, 130])
def test_bounds_hold_and_narrow(d):
    rng = np.random.default_rng(d)
    x = rng.normal(0, 300, (400, d)).astype(np.int64)
    x[0] = 0
    x[1] = 10_000
    codes = Codes(x)
    for q in (x[5], x[0], x[1], rng.integers(-5, 5, d)):
        low, high = codes.interval(q)
        exact = x @ q
        assert (low <= exact).all() and (exact <= high).all()
    low, high = codes.interval(x[5])
    assert (high - low)[2:].mean() < 1.8 * (np.linalg.norm(x[5]) * codes.norm)[2:].mean()


@pytest.mark.parametrize("rows", [points(240), points(5), [(i, i % 2, [1.0, 0.5, float(i % 3)]) for i in range(90)]], ids=["clusters", "few", "copies and ties"])
def test_equals_plain_scoring(spark, rows):
    assert mined(frame(spark, rows)) == plain(rows, TINY)


def test_query_agrees_with_sql(spark, sf_dir):
    from riskframe.llm.queries import ORACLES, QUERIES

    df = QUERIES["op12_hard_negatives"](spark, sf_dir)
    assert oracle.differences(df, ORACLES["op12_hard_negatives"], oracle.connect(sf_dir)) == []


def test_odd_rows(spark):
    nan = float("nan")
    good = [*points(60), points(60)[20], (200, 1, [1.0, 2.0]), (201, 1, [1.0, 2.0]), (202, 2, [0.5, 2.0]), (210, 0, []), (211, 0, []), (212, 1, [])]
    bad = [(70, None, [1.0] * 6), (80, 1, None), (90, 1, [nan] * 6), (100, 1, [None] * 6), (None, 1, [1.0] * 6), (110, 2, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, 5, "x", 1) for r in good + bad], "vec_id long, label int, embedding array<double>, rank int, chunk string, a int")
    assert mined(df) == plain(good, TINY)
    assert mined(df.limit(0)) == []
