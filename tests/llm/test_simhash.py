"""SimHash: index against brute force, contract cases, components."""

import numpy as np
import pytest
import xxhash

from riskframe.llm import simhash


def plain_fingerprint(text, width=4):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in (text or "")).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, k=4):
    low = list(range(len(fps)))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= k:
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clusters(seed, centres, copies, flips=5):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(centres):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(copies):
            y = x
            for bit in rng.choice(64, rng.integers(0, flips), replace=False):
                y ^= 1 << int(bit)
            out.add(y)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "One TWO three", "a b c d", "Ä Ö x\x0by z É é", "w " * 300])
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint_of(text, 4) == plain_fingerprint(text)


def test_gray_rank_orders_the_gray_sequence():
    codes = np.array([i ^ (i >> 1) for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(1000)).all()


@pytest.mark.parametrize("k", [0, 2, 4])
@pytest.mark.parametrize("centres,copies", [(1, 1), (1, 200), (150, 4), (20, 30)])
def test_index_finds_every_link(centres, copies, k):
    fps = clusters(centres + copies, centres, copies)
    forest = simhash.Forest(len(fps))
    forest.link(*simhash.linked_rows(np.zeros(len(fps), int), fps, k))
    assert forest.find(np.arange(len(fps))).tolist() == plain_components([int(x) for x in fps], k)


def test_groups_stay_apart_in_the_index():
    fps = clusters(3, 10, 6)
    both = np.concatenate([fps, fps])
    u, v = simhash.linked_rows(np.repeat([0, 1], len(fps)), both, 4)
    assert ((u < len(fps)) == (v < len(fps))).all()


@pytest.mark.parametrize("piece", [None, 7])
def test_components_in_spark(spark, piece):
    fps = clusters(11, 25, 12)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    root = {r.fp: r.root for r in simhash.components(df, 4, piece).collect()}
    got = {}
    for x in fps.view(np.int64).tolist():
        got.setdefault(root.get(x, x), set()).add(x)
    want = {}
    for x, c in zip(fps.view(np.int64).tolist(), plain_components([int(x) for x in fps])):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_more_blocks_for_larger_tables():
    for n in (1, 10**6, 10**9, 10**12):
        masks = simhash._masks(simhash._blocks(n, 4), 4)
        assert all(m < 1 << 64 for m in masks)
    rng = np.random.default_rng(0)
    for blocks in (5, 6, 7, 8):
        masks = simhash._masks(blocks, 4)
        for _ in range(200):  # any four bits leave one choice of blocks untouched
            flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(m & flipped == 0 for m in masks)


ROWS = [
    (5, "The quick brown fox jumps over the lazy dog"), (3, "the QUICK brown fox jumps over the lazy dog"),
    (7, None), (8, ""), (9, "  \n"), (2, "completely other words in this one here"), (None, "words without any key at all"),
    (2, "completely other words in this one here"), (11, "zz " * 40_000),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, fp string, root int")
    got = [(r.doc_id, r.component) for r in simhash.near_duplicates(df).collect()]
    want = [(5, 3), (3, 3), (7, 7), (8, 7), (9, 7), (2, 2), (2, 2), (None, None), (11, 11)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, 2, None, 11], key=str)
    empty = df.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    from riskframe.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    root = plain_components(fps)
    want = {(r.doc_id, f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, root)}
    assert {tuple(r) for r in QUERIES["op10_simhash_dedup"](spark, sf_dir).collect()} == want
