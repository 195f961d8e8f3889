"""Heap clustering against plain rounds of integer arithmetic, SQL, and odd rows."""

import hashlib
from dataclasses import replace

import numpy as np
import oracle
import pytest

from riskframe.llm import centroids
from riskframe.llm.centroids import HeapClustering, Heaps

SMALL = HeapClustering(k=6, rounds=4, dims=3, chunk=16)


def plain(rows, c):
    kept = [(i, [int(np.floor(c.scale * float(v))) for v in x]) for i, x in rows]
    named = sorted((hashlib.sha256(f"{c.seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centres = [x for _, x in named[: c.k]]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    assign = lambda: [min((far(x, y), n) for n, y in enumerate(centres)) for _, x in kept]
    for _ in range(c.rounds):
        found = assign()
        for n in range(len(centres)):
            own = [x for (_, x), (_, m) in zip(kept, found) if m == n]
            if own:
                centres[n] = [sum(v) // len(own) for v in zip(*own)]
    found = assign()
    inertia = [sum(d for d, m in found if m == n) for n in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in centres]
    return sorted((i is None, i or 0, n, d, inertia[n], sum(inertia), digest[n]) for (i, _), (d, n) in zip(kept, found))


def rows_of(df):
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in map(tuple, df.collect()))


def points(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 4, (7, 3))[rng.integers(0, 7, n)] + rng.normal(0, 0.6, (n, 3))
    return [(i, v) for i, v in enumerate(x.round(2).tolist())]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("rows", [points(300), points(4), [(i, [1.0, 2.0, float(i % 2)]) for i in range(60)]], ids=["clusters", "fewer than k", "copies and ties"])
def test_equals_plain_rounds(spark, rows):
    assert rows_of(SMALL.cluster(frame(spark, rows))) == plain(rows, SMALL)


def test_query_agrees_with_sql(spark, sf_dir):
    from riskframe.llm.queries import ORACLES, QUERIES

    df = QUERIES["op13_heap_clustering"](spark, sf_dir)
    assert oracle.differences(df, ORACLES["op13_heap_clustering"], oracle.connect(sf_dir)) == []


def test_odd_rows(spark):
    nan = float("nan")
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [nan, 0.0, 0.0]), (93, [float("inf"), 0.0, 0.0]), (94, [1.0]), (95, [])]
    good = [*points(40), (None, [0.5, 0.5, 0.5]), (3, [9.0, 9.0, 9.0]), (5, points(40)[5][1])]
    df = spark.createDataFrame([(*r, 7, "x") for r in good + bad], "vec_id long, embedding array<double>, cluster int, chunk string")
    assert rows_of(SMALL.cluster(df)) == plain(good, SMALL)
    assert SMALL.cluster(df.limit(0)).count() == 0 and SMALL.cluster(frame(spark, [(None, [1.0, 1.0, 1.0])])).count() == 0
    with pytest.raises(Exception, match="after scaling"):
        SMALL.cluster(frame(spark, [(1, [1e9, 0.0, 0.0])])).count()


def test_heaps_rescan_only_what_expired():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4000, (8, 5)).astype(np.int64)
    x = (centres[rng.integers(0, 8, 2000)] + rng.normal(0, 1500, (2000, 5))).astype(np.int32)
    heaps, offsets, scanned = Heaps.start(x, centres), np.zeros(8), 0
    for step in range(5):
        moved = centres + rng.integers(-40, 40, centres.shape)
        offsets = offsets + replace(SMALL, dims=5)._drift(centres, moved)
        centres = moved
        heaps = Heaps.unpack(*heaps.pack())
        scanned += len(heaps.advance(x, centres, offsets)[0])
        assert (heaps.clusters(len(x)) == centroids.squared_distances(x, centres).argmin(1)).all()
        for heap in heaps.heaps:
            assert all(heap[i] >= heap[(i - 1) // 2] for i in range(1, len(heap)))
    assert 0 < scanned < 0.2 * 5 * len(x)


def test_rounds_shuffle_no_vectors(spark, monkeypatch):
    """The join of vectors and state reads both by bucket."""
    plans = []
    write = centroids._Bucketed.write

    def noted(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df)

    monkeypatch.setattr(centroids._Bucketed, "write", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        SMALL.cluster(frame(spark, points(200)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plans[-1] and "Exchange" not in plans[-1]
