"""Hash tree: chances, movement, slots, odd rows."""

import math
import zlib

from pyspark.sql import functions as F

from riskframe.llm.sharding import Tree, placed, sharded


def shards(spark, tree, n=4000):
    rows = placed(spark.range(n).withColumnRenamed("id", "doc_id"), tree).collect()
    return {r.doc_id: (r.region, r.rack, r.shard) for r in rows}


def test_tree_shape():
    tree = Tree.uniform(41)
    assert [[len(rack) for rack in region] for region in tree.regions] == [[5] * 4, [5] * 4, [1]]
    assert sorted(s for region in tree.regions for rack in region for s, _ in rack) == list(range(41))


def test_weights_are_met_at_every_level(spark):
    tree = Tree((((((0, 1.0), (1, 3.0))), (((2, 4.0),))), ((((3, 8.0), (4, 0.0)),))))
    got = list(shards(spark, tree, 8000).values())
    share = lambda f: sum(map(f, got)) / len(got)
    assert abs(share(lambda p: p[0] == 1) - 0.5) < 0.03
    assert abs(share(lambda p: p[:2] == (0, 0)) - 0.25) < 0.03
    assert abs(share(lambda p: p[2] == 1) - 3 / 16) < 0.03
    assert not any(p[2] == 4 for p in got)


def expected(tree, key, draw):
    """The descent in plain Python, from the draws' uniforms."""
    level, path = tree.regions, ""
    weight = lambda node: node[1] if isinstance(node[0], int) else sum(map(weight, node))
    while True:
        names = [f"{path}{child[0] if isinstance(child[0], int) else i}" for i, child in enumerate(level)]
        best = min(range(len(level)), key=lambda i: -math.log(draw(key, names[i])) / weight(level[i]))
        if isinstance(level[best][0], int):
            return level[best][0]
        path, level = names[best] + "/", level[best]


def test_descent_equals_plain_python(spark):
    names = ["0", "1", "0/0", "0/1", "1/0", "1/1", "0/0/0", "0/0/1", "0/1/2", "1/0/3", "1/0/4", "1/1/5"]
    tree = Tree((((((0, 1.0), (1, 3.0))), ((2, 4.0),)), (((3, 8.0), (4, 2.0)), ((5, 1.0),))))
    uniform = lambda n: (F.shiftrightunsigned(F.xxhash64("id", F.lit(n), F.lit(tree.seed)), 11).cast("double") + 1) * F.lit(2.0**-53)
    us = {r["id"]: r for r in spark.range(500).select("id", *(uniform(n).alias(n) for n in names)).collect()}
    got = shards(spark, tree, 500)
    assert {k: p[2] for k, p in got.items()} == {k: expected(tree, k, lambda k, n: us[k][n]) for k in got}


def test_nesting_decides(spark):
    leaves = [(i, 1.0) for i in range(8)]
    flat, nested = Tree(((tuple(leaves),),)), Tree(((tuple(leaves[:4]),), (tuple(leaves[4:]),)))
    a, b = shards(spark, flat), shards(spark, nested)
    assert sum(a[k][2] != b[k][2] for k in a) > len(a) / 4


def test_movement_stays_on_the_changed_path(spark):
    base = ((((0, 1.0), (1, 1.0)), ((2, 1.0), (6, 1.0))), (((3, 1.0), (4, 1.0)), ((5, 1.0),)))
    before = shards(spark, Tree(base))
    for rack, into in ((((0, 1.0), (1, 1.0), (9, 1.0)), True), (((0, 1.0), (1, 2.5)), True), (((0, 1.0), (1, 0.2)), False)):
        after = shards(spark, Tree(((rack, base[0][1]), base[1])))
        moved = [(before[k], after[k]) if into else (after[k], before[k]) for k in before if before[k] != after[k]]
        assert moved
        for old, new in moved:  # towards the grown path, seen from the lighter tree
            assert new[0] == 0
            if old[0] == 0:
                assert new[1] == 0
                if old[1] == 0:
                    assert new[2] in (1, 9)


def test_a_shard_in_a_region_of_its_own_takes_rows_only_into_itself(spark):
    for n in (1, 4, 5, 7, 21, 40):
        tree = Tree.uniform(n)
        a, b = shards(spark, tree, 600), shards(spark, tree.with_shard(n), 600)
        moved = [k for k in a if a[k][2] != b[k][2]]
        assert moved and {b[k][2] for k in moved} == {n}


def test_slots_and_odd_rows(spark):
    rows = [(i, f"t{i}") for i in range(300)] + [(7, "again")] * 150 + [(None, "x"), (None, "y"), (8, None)]
    df = spark.createDataFrame([(*r, "old", 1.5) for r in rows], "doc_id long, text string, shard string, _row double")
    out = sharded(df, Tree.uniform(40), Tree.uniform(40).with_shard(40)).collect()
    assert len(out) == len(rows) and "_row" in out[0].asDict()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
        keys = [(r.doc_id is None, r.doc_id or 0) for r in sorted(group, key=lambda r: r.slot)]
        assert keys == sorted(keys)
    assert len({r.shard for r in out if r.doc_id == 7}) == 1 and len({r.shard for r in out if r.doc_id is None}) == 1
    assert sharded(df.limit(0), Tree.uniform(40)).count() == 0


def test_query(spark, sf_dir):
    from riskframe.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op4_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    again = QUERIES["op4_sharding"](spark, sf_dir).agg(F.sum(F.xxhash64("doc_id", "shard", "slot") % 1000)).first()
    assert again == QUERIES["op4_sharding"](spark, sf_dir).agg(F.sum(F.xxhash64("doc_id", "shard", "slot") % 1000)).first()


def test_columns_named_like_the_operators_own(spark):
    df = spark.createDataFrame([(i, "t", 5, "p", 6) for i in range(30)], ["doc_id", "text", "_of", "_place", "_row"])
    got = sharded(df, Tree.uniform(4))
    assert got.columns == [*df.columns, "region", "rack", "shard", "grown_shard", "slot"]
    assert got.count() == 30 and got.where("_of <> 5 or _place <> 'p' or _row <> 6").count() == 0
