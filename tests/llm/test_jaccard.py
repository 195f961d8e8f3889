"""Jaccard join: search and groups against all pairs, SQL, hot groups, odd rows."""

import numpy as np
import oracle
import pyarrow as pa
import pytest

from riskframe.llm import jaccard
from riskframe.llm.jaccard import JaccardJoin
from riskframe.session import ARROW_BYTES, arrow_batches

JOIN = JaccardJoin()


def words_of(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_set(text, width=4):
    words = words_of(text)
    if len(words) < width:
        return {" ".join(words)} - {""}
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def roots(links, n):
    low = list(range(n))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        low[b] = a
    return [find(i) for i in range(n)]


def similar(a, b, percent=85):
    both = len(a & b)
    return both and 100 * both >= percent * (len(a) + len(b) - both)


def plain(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if similar(sets[i], sets[j], percent)]
    of, first = roots(pairs, len(rows)), {}
    for (k, _), s, root in zip(rows, sets, of):
        if k is not None:
            first[root] = min(first.get(root, k), k)
    return sorted(((k, len(s), first.get(root) if s else k) for (k, _), s, root in zip(rows, sets, of)), key=str)


def joined(df, join=JOIN):
    return sorted((tuple(r) for r in join.components(df).collect()), key=str)


def corpus(seed=0, n=30):
    """Near copies of a few texts, a passage in many texts, chains, short texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "w%d" % rng.integers(0, 4000)
    text = lambda m: [word() for _ in range(m)]
    passage, out = text(40), []
    for size in (60, 120, 240):
        base = text(size)
        for _ in range(n):
            copy = list(base)
            for at in rng.integers(0, size, rng.integers(0, 4)):
                copy[at] = word()
            out.append(copy)
    chain = text(200)
    for _ in range(n):
        chain = chain[4:] + text(4)
        out.append(chain)
    out += [text(20) + passage + text(int(rng.integers(1, 60))) for _ in range(n)]
    out += [passage[: int(rng.integers(30, 41))] for _ in range(10)]
    out += [text(int(rng.integers(0, 6))) for _ in range(10)] + [["a", "b"], ["A", "b"], ["a", "b", "c", "d"]]
    order = rng.permutation(len(out))
    return [(int(i) * 3, " ".join(out[j])) for i, j in enumerate(order)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_merge_counts_members():
    members, counts = jaccard.merged([[1, 4, 9], [4, 9], [2, 4]], 2)
    assert members.tolist() == [4, 9] and counts.tolist() == [3, 2]
    assert len(jaccard.merged([], 1)[0]) == 0


@pytest.mark.parametrize("percent", [50, 85, 100])
def test_search_finds_every_link(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 3000, rng.integers(1, 60))
        sets += [np.unique(np.r_[base[rng.random(len(base)) < 0.9], rng.integers(0, 3000, rng.integers(0, 3))]) for _ in range(4)]
    sizes = np.array([len(s) for s in sets])
    asked = rng.random(len(sets)) < 0.3
    for mask in (None, asked):
        got = jaccard.search(sizes, np.concatenate(sets), percent, mask)
        want = [(i, j) for i in range(len(sets)) for j in range(i) if similar(set(sets[i].tolist()), set(sets[j].tolist()), percent) and (mask is None or mask[i] or mask[j])]
        assert roots(list(zip(*map(np.ndarray.tolist, got))), len(sets)) == roots(want, len(sets))


@pytest.mark.parametrize("limits", [(512, 1024, 128), (5, 1024, 128), (3, 4, 4), (512, 1024, 5)], ids=["as shipped", "frequent shingles", "all limits", "large groups"])
def test_equals_all_pairs(spark, monkeypatch, limits):
    if limits[0] < 512:
        monkeypatch.setattr(jaccard, "SAMPLE", 20)
        monkeypatch.setattr(jaccard, "FETCHED", 0)
    for name, value in zip(("HOT", "LIST", "PIECE"), limits):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus()
    assert joined(frame(spark, rows)) == plain(rows)


def test_query_against_brute_force_and_sql(spark, sf_dir):
    from riskframe.llm.queries import ORACLES, QUERIES

    df = QUERIES["op11_jaccard_join"](spark, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, df.collect()), key=str) == plain(rows)
    assert oracle.differences(df, ORACLES["op11_jaccard_join"], oracle.connect(sf_dir)) == []


def test_odd_rows(spark):
    rows = [
        (5, "The quick brown fox jumps"), (3, "the QUICK brown\x0bfox  jumps"), (7, None), (8, ""), (9, " \n"), (2, "b a"), (None, "b a"),
        (None, "no key at all here"), (2, "b a"), (4, "B\tA"), (11, "zz " * 50_000), (10, "zz zz zz zz zz"), (12, "É é"), (13, "é é"),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, row string, n int, component_id int")
    assert joined(df) == plain(rows)
    assert joined(df.limit(0)) == [] and joined(frame(spark, [(1, None)])) == [(1, 0, 1)]


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    sketches, most = jaccard._sketches, 2 * jaccard.BATCH

    def watched(batches, *rest):
        for b in batches:
            if b.nbytes > most:
                raise ValueError(f"a batch of {b.nbytes} bytes")
            yield from sketches(iter([b]), *rest)

    monkeypatch.setattr(jaccard, "_sketches", watched)
    rows = [(i, f"a b c d {i % 200} " * 1000) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert joined(df) == plain(rows)
    assert spark.conf.get(ARROW_BYTES, None) is None
    spark.conf.set(ARROW_BYTES, "3m")
    try:
        with arrow_batches(spark, jaccard.BATCH):
            assert spark.conf.get(ARROW_BYTES) == "3m"
        assert spark.conf.get(ARROW_BYTES) == "3m"
    finally:
        spark.conf.unset(ARROW_BYTES)


def test_whole_keys_are_bounded_in_bytes():
    def batches():
        for i in range(40):
            sets = pa.array([np.arange(1 << 16)] * 2, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([i // 3, (i + 1) // 3], pa.int64()), sets], ["root", "shingles"])

    tables = list(jaccard._whole_keys(batches(), ["root"], 2_000))
    roots = [t["root"].to_pylist() for t in tables]
    assert sum(roots, []) == [r for i in range(40) for r in (i // 3, (i + 1) // 3)]
    assert all(a[-1] < b[0] for a, b in zip(roots, roots[1:]))
    assert max(t.nbytes for t in tables) < 2 * jaccard.HELD
    assert list(jaccard._whole_keys(iter([]), ["root"], 2_000)) == []
