"""Decontamination: alignment against a plain table, planted and clean documents, odd rows."""

import random

import numpy as np
import pytest

from riskframe.llm import decontaminate as D


def plain_score(a, b):
    best, rows = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (D.MATCH if x == y else D.MISMATCH), rows[i - 1][j] + D.GAP, rows[i][j - 1] + D.GAP)
            best = max(best, rows[i][j])
    return best


def test_alignment_by_definition():
    rng = np.random.default_rng(5)
    for _ in range(60):
        item = rng.integers(1, 6, rng.integers(1, 12))
        windows = [rng.integers(0, 6, rng.integers(1, 20)) for _ in range(5)]
        assert [s for s, _ in D.local_scores(windows, item)] == [plain_score(w, item) for w in windows]


WORDS = [f"w{i}" for i in range(4000)]


def corpus(seed=1):
    rng = random.Random(seed)
    text = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [text(rng.randrange(25, 50)) for _ in range(12)]
    docs, leaks = [], set()
    for i in range(150):
        words = text(rng.randrange(20, 400))
        if i % 5 == 0:
            item = i // 5 % len(items)
            copy = list(items[item])
            if i % 10 == 0:  # edited: some words replaced, lost and added
                for _ in range(5):
                    copy[rng.randrange(len(copy))] = rng.choice(WORDS)
                del copy[rng.randrange(len(copy))]
                copy.insert(rng.randrange(len(copy)), "new")
            at = rng.randrange(len(words))
            words[at:at] = copy
            leaks.add((i, item))
        docs.append((i, " ".join(words).title() + "."))
    return docs, [(j, " ".join(x)) for j, x in enumerate(items)], leaks


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 60])
def test_planted_items_are_found_and_others_left(spark, block_words):
    docs, items, leaks = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = D.find_leaks(d, b, block_words=block_words).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks
    assert all(0.5 <= r.score <= 1 and 0 <= r.from_word < r.to_word for r in found)
    assert {r.score for r in found if r.doc_id % 10} == {1.0}
    assert {r.doc_id for r in D.drop_leaks(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in leaks}


def test_common_passages_still_place_an_item(spark):
    common = " ".join(f"c{i}" for i in range(30))
    docs = [(i, f"x{i} y{i} {common} z{i}") for i in range(80)]
    b = spark.createDataFrame([(1, common)], "item_id long, text string")
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), b)
    assert found.count() == 80


def test_bound_is_never_below_the_score():
    rng = np.random.default_rng(6)
    for _ in range(200):
        item = rng.integers(1, 9, rng.integers(1, 15))
        windows = [rng.integers(0, 9, rng.integers(1, 12)) for _ in range(5)]
        scores = [s for s, _ in D.local_scores(windows, item)]
        assert (D.most_scores(windows, item) >= scores).all()
    assert D.most_scores([np.array([9, 9]), np.array([1, 9, 9, 2])], np.array([1, 5, 2])).tolist() == [0, 3]


def test_frequent_shortened_and_edited_copies(spark):
    short, edited = [f"s{i}" for i in range(40)], [f"e{i}" for i in range(40)]
    copy = [f"new{i}" if i % 5 == 4 else w for i, w in enumerate(edited)]
    docs = []
    for i in range(600):  # 200 of each kind: over 100 and over 1 %
        part = (short[:24], copy, [])[i % 3]
        docs.append((i, " ".join([f"x{i}", *part, f"y{i}", "s1 s2 s3 z e1 e2 e3"])))
    b = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(edited))], "item_id long, text string")
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), b).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i % 3 + 1) for i in range(600) if i % 3 < 2}
    assert {(r.item_id, r.score) for r in found} == {(1, 0.6), (2, 57 / 80)}


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (None, "k l m n o p q r"), (4, "K, l m: n o P q r!"), (4, "k l m n o p q r"), (5, "z " * 50_000)]
    d = spark.createDataFrame([(*x, 0.5, "t") for x in docs], "doc_id long, text string, score double, item_id string")
    b = spark.createDataFrame([(7, "k l m n o p q r"), (8, None), (9, ""), (10, "a b"), (None, "x"), (7, "k l m n o p q r")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score) for r in D.find_leaks(d, b).collect() if r.doc_id is not None}
    assert got == {(4, 7, 1.0), (3, 10, 1.0)}
    kept = D.drop_leaks(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert D.find_leaks(d.limit(0), b).count() == 0 and D.find_leaks(d, b.limit(0)).count() == 0


def test_query_equals_alignment_of_all_pairs(spark, sf_dir):
    """Every document against every item of the given tables, no seeds."""
    from riskframe.llm.queries import QUERIES

    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
    number, items = {}, [(r.item_id, D.words_of(r.text)) for r in read("benchmark")]
    for _, words in items:
        for w in words:
            number.setdefault(w, len(number) + 1)
    want = set()
    for r in read("documents"):
        words = np.array([number.get(w, 0) for w in D.words_of(r.text)], np.int64)
        for item, of in items:
            if not of or not len(words):
                continue
            ((best, _),) = D.local_scores([words], np.array([number[w] for w in of]))
            if best >= D.MATCH * len(of) / 2:
                want.add((r.doc_id, item, best / (D.MATCH * len(of))))
    got = QUERIES["op1_decontaminate"](spark, sf_dir).select("doc_id", "item_id", "score").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_repeats_of_a_run_are_not_multiplied():
    items = D.Items([1], ["z " * 2000], 0.5)
    spots = D._spots(items, *items.joined(["z", "z " * 20_000]))
    assert [s[:3] for s in spots] == [(1, 0, 0), (1, 0, D.WINDOW_WORDS)] and spots[-1][3] == 20_000


def test_least_runs_by_trying_all_patterns():
    """Words of an item kept (1) or replaced (0): no pattern of that score holds fewer pairs."""
    import itertools

    for size in range(D.LONG, 14):
        item, fewest = np.arange(1, size + 1), size
        patterns = np.array(list(itertools.product((0, 1), repeat=size)))
        for lot in np.array_split(patterns, 8):
            scores = D.local_scores(list(item * lot), item)
            for kept, (best, _) in zip(lot, scores):
                if best >= size:
                    fewest = min(fewest, int((kept[1:] & kept[:-1]).sum()))
        assert fewest >= D.least_runs(size, 0.5)


def test_every_third_word_replaced_and_copied_often(spark):
    item = [f"s{i}" for i in range(41)]
    copy = [f"new{i}" if i % 3 == 2 else w for i, w in enumerate(item)]
    docs = [(i, " ".join([f"x{i}", *(copy if i % 3 == 0 else item[5:8] * 4), f"y{i}"])) for i in range(600)]
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), b).collect()
    assert {r.doc_id for r in found} == set(range(0, 600, 3))
    assert {r.score for r in found} == {plain_score(item, copy) / 82}


def test_long_windows_are_cut_with_an_overlap(monkeypatch):
    monkeypatch.setattr(D, "WINDOW_WORDS", 30)
    item = " ".join(f"s{i}" for i in range(12))
    items = D.Items([1], [item], 0.5)
    words, starts, sizes = items.joined(["a b", ("s1 s2 x " * 100) + item + (" s1 s2 x" * 100)])
    spots = D._spots(items, words, starts, sizes)
    assert len(spots) > 3 and max(b - a for _, _, a, b in spots) <= 8 * 12 + 24
    best = max(D.local_scores([words[starts[1] + a : starts[1] + b]], items.words[0])[0][0] for _, _, a, b in spots)
    assert best == 24
