"""Mixture: targets, permutations, exact word counts against a plain repetition of the method."""

import pytest
from pyspark.sql import functions as F

from riskframe.llm import mixture
from riskframe.llm.mixture import Mixture

P = mixture.PRIME


def plain_permuted(x, n, key):
    for r in range(1, mixture.ROUNDS + 1):
        pivot = (key % P * mixture.STEP_A + r * mixture.STEP_C) % P * mixture.STEP_D
        partner = (pivot - x) % n
        draw = (max(x, partner) % P * (pivot % 65521 + 1) + pivot) % P
        x = partner if draw >> 14 & 1 else x
    return x


def plain_targets(sizes, weights, most=3, share=1.0):
    """Share by weight, stop what is above, share the excess among the rest, until none is above."""
    left, open_, out = share * sum(sizes), set(range(len(sizes))), {}
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * level > most * sizes[i]]
        if not over:
            return [out.get(i, weights[i] * level) for i in range(len(sizes))]
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
            open_.remove(i)
    return [out[i] for i in range(len(sizes))]


def plain_taken(docs, m):
    """docs: (doc_id, words, source); returns {row: taken} by the law of passes, blocks and cuts."""
    sources = sorted({s for *_, s in docs}, key=lambda s: (s is None, s))
    sizes = [sum(n for _, n, s in docs if s == name) for name in sources]
    weights = [m.weights[i % len(m.weights)] for i in range(len(sources))]
    targets, taken, L = plain_targets(sizes, weights, m.most), {}, m.block_words
    for i, (name, size, target) in enumerate(zip(sources, sizes, targets)):
        words = min(int(target), m.most * size)
        passes, rest = divmod(words, size) if size else (0, 0)
        full, blocks = size // L, -(-size // L)
        got = {b: passes for b in range(blocks)}
        cut = {}
        for j in range(-(-rest // L)):
            b = plain_permuted(j, full, (i * 1009 + passes) * 31 + m.seed) if j < full else j
            cut[b] = min(L, rest - j * L)
        at = 0
        for row, (_, n, _) in sorted(((k, d) for k, d in enumerate(docs) if d[2] == name), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[1][1], x[0])):
            taken[row] = sum(got[w // L] + (w % L < cut.get(w // L, 0)) for w in range(at, at + n))
            at += n
    return taken, dict(zip(sources, targets))


def test_permutations_are_permutations(spark):
    for n in (1, 2, 7, 100, 1000):
        rows = spark.range(n).select("id", mixture.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(77).cast("bigint")).alias("y")).collect()
        assert sorted(r.y for r in rows) == list(range(n))
        assert [r.y for r in rows] == [plain_permuted(r.id, n, 77) for r in rows]
    moved = [plain_permuted(i, 1000, 5) for i in range(1000)]
    assert abs(sum(a < b for a, b in zip(moved, moved[1:])) - 500) < 80


DOCS = [(i, 7 * i % 90, ("a", "b", "c", None, "e")[i * i % 5]) for i in range(120)] + [(3, 21, "a"), (None, 50, "b"), (None, 0, "zz"), (200, 4000, "f"), (201, 1, "g")]


def frame(spark, docs):
    rows = [(i, " \n".join(["w"] * n) if n else None, s, 5, "x") for i, n, s in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, size string")


@pytest.mark.parametrize("block,shard", [(16, 5), (128, 8192)])
def test_report_against_plain_python(spark, block, shard):
    m = Mixture(block_words=block, shard_blocks=shard)
    want, targets = plain_taken(DOCS, m)
    rows = m.report(frame(spark, DOCS)).collect()
    source = {i: s for i, _, s in DOCS if i is not None}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.taken) for r in rows) == sorted(
        (i is None, i or 0, n, want[k]) for k, (i, n, _) in enumerate(DOCS)
    )
    assert all(r.taken <= 3 * r.size for r in rows)
    for r in rows:
        if r.doc_id not in (None, 3):  # 3 is in two sources
            assert r.target == pytest.approx(targets[source[r.doc_id]])
            assert r.source_size == sum(n for _, n, s in DOCS if s == source[r.doc_id])
    assert sum(r.taken for r in rows) == sum(int(t + 1e-9) for t in targets.values())


def test_targets_stop_and_are_reshared(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 100, "e": 3000}
    docs = frame(spark, [(i, n, s) for i, (s, n) in enumerate(sizes.items())])
    m = Mixture()
    got = {r.source: r.target for r in m.targets(m.sized(docs, "doc_id", "text", "source")).collect()}
    want = plain_targets(list(sizes.values()), [5, 2, 1, 5, 2])
    assert [got[s] for s in sizes] == pytest.approx(want)
    assert got["a"] == 30 and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_blocks_and_documents_hold_the_words_taken(spark):
    m = Mixture(block_words=16, shard_blocks=9)
    docs = spark.createDataFrame(
        [(i, " ".join(f"d{i}w{j}" for j in range(11 * i % 70)), "ab"[i % 2] + str(i % 3), 0) for i in range(60)],
        "doc_id long, text string, source string, n_chars long",
    )
    taken = {r.doc_id: r.taken for r in m.report(docs).collect()}
    blocks = m.blocks(docs).collect()
    words = [w for r in blocks for w in r.text.split()]
    mixed = m.documents(docs).collect()
    again = [w for r in mixed for w in r.text.split()]
    assert sorted(words) == sorted(again)
    for i, n in taken.items():
        assert sum(w.startswith(f"d{i}w") for w in words) == n
    assert all(r.n_chars == len(r.text) or r.text in {d.text for d in docs.collect()} for r in mixed)
    sizes = {}
    for r in blocks:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert sorted(sizes) == list(range(len(sizes))) and all(sizes[k] == 9 for k in list(sizes)[:0] + sorted(sizes)[:-1])


def test_empty_and_wordless_tables(spark):
    m = Mixture()
    empty = frame(spark, DOCS[:1]).limit(0)
    assert m.report(empty).count() == 0 and m.documents(empty).count() == 0
    rows = m.report(frame(spark, [(1, 0, "a"), (2, 0, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_reruns_agree_on_the_query_table(spark, sf_dir):
    from riskframe.llm.queries import QUERIES

    a, b = (sorted(map(tuple, QUERIES["op6_mixture"](spark, sf_dir).collect())) for _ in range(2))
    assert a == b


def test_columns_named_like_the_operators_own(spark):
    rows = [(i, f"a{i} b c d " * (i % 5), "s%d" % (i % 2), 3, 7, 8, 9, [1], "keep", "x", 1) for i in range(40)]
    names = ["doc_id", "text", "source", "n_chars", "_row", "_pass", "_mixrow", "parts", "_text", "_words", "_of"]
    df = spark.createDataFrame(rows, names)
    got = Mixture(block_words=8).documents(df)
    assert got.columns == names and got.count() > 0
    assert got.where("_row <> 7 or _pass <> 8 or _mixrow <> 9 or parts[0] <> 1 or _text <> 'keep' or _words <> 'x'").count() == 0
