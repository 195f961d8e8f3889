"""SimHash near-duplicates through a hierarchical index over fingerprints in Gray order.

Fingerprints are cut into blocks. Two fingerprints that differ in at most ``k`` bits agree on at
least ``blocks - k`` blocks, so the rows that share one choice of such blocks form a bucket, the
upper node of an index tree: the masked bit pattern that all its rows share. Inside a bucket rows
are sorted by Gray rank, cut into leaves, and leaves into nodes; each node keeps the bits on which
its rows agree. Two nodes are compared by the bits that both have settled; what a pair of upper
nodes differs in is carried down and only newly settled bits are counted. A pair of groups is
dropped as a whole once more than ``k`` differences have gathered, and linked as a whole if all
bits that vary in either are at most ``k``. The result is exact at every size.

Rows of equal fingerprints are folded first, so copies of any number count once. Buckets above
``PIECE`` rows are cut into pieces, and each pair of pieces is a bucket of its own. A bucket returns
a spanning forest of its links, never its pairs; components follow from all forests.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import free_name, with_row_ids
from riskframe.llm.components import connected
from riskframe.session import materialise, shuffle_width

#: Rows of a bucket that one task compares; larger buckets are cut into pieces.
PIECE = 8192
LEAF, FAN = 16, 8
#: Pairs of nodes looked at in one step.
STEP = 1 << 14


# -- fingerprints --------------------------------------------------------------------------------


def hashes_of(text: str | None, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of all word shingles in order; a text of fewer words has one, itself."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - width + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)))) if n > 1 or len(words) == width else [b" ".join(words)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), grams), np.uint64, n)


def fingerprint_of(text: str | None, width: int, seed: int = 42) -> int:
    """Bit majority of the XXH64 of all word shingles, as an unsigned number."""
    hashes = hashes_of(text, width, seed)
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        block = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8)
        ones += np.unpackbits(block, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = 4, seed: int = 42) -> Column:
    """SimHash of lower-cased (A-Z) words as a signed long; empty or missing texts give zero."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(
            np.array([fingerprint_of(t, width, seed) for t in texts], np.uint64).view(np.int64)
        )

    return run(text)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# -- the index inside a task ---------------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the binary reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class Forest:
    """Smallest reachable row of each row, for links that arrive in blocks."""

    def __init__(self, n: int):
        self.low = np.arange(n)

    def find(self, x):
        root = self.low[x]
        while True:
            up = self.low[root]
            if (up == root).all():
                return root
            root = up

    def link(self, a, b):
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            if len(a):
                np.minimum.at(self.low, np.maximum(a, b), np.minimum(a, b))

    def edges(self):
        every = np.arange(len(self.low))
        root = self.find(every)
        return every[root != every], root[root != every]


def _levels(group: np.ndarray, fp: np.ndarray) -> list[dict]:
    """Nodes per level, leaves first; rows are sorted by group and Gray rank."""
    ones, zeros, lo, hi, of = fp, ~fp, None, None, group
    levels, size = [], LEAF
    while True:
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        at = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
        starts = np.flatnonzero(at % size == 0)
        ones = np.bitwise_and.reduceat(ones, starts)  # bits set in every row below
        zeros = np.bitwise_and.reduceat(zeros, starts)  # bits clear in every row below
        lo, hi = starts, np.r_[starts[1:], len(of)]
        of = of[starts]
        levels.append({"ones": ones, "zeros": zeros, "lo": lo, "hi": hi, "of": of})
        if len(of) == len(np.unique(of)):
            return levels
        size = FAN


def _children(level: dict, a: np.ndarray, b: np.ndarray):
    """All pairs of children of the node pairs (a, b), each unordered pair once."""
    na, nb = level["hi"][a] - level["lo"][a], level["hi"][b] - level["lo"][b]
    n = na * nb
    of = np.repeat(np.arange(len(a)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    x, y = level["lo"][a][of] + at // nb[of], level["lo"][b][of] + at % nb[of]
    once = (a[of] != b[of]) | (x <= y)
    return x[once], y[once], of[once]


def linked_rows(group: np.ndarray, fp: np.ndarray, k: int, across: np.ndarray | None = None):
    """Spanning forest (row, lower row) of the links inside each group.

    Rows are sorted by group. ``across`` names the piece of each row: a pair within one piece is
    left out where its group joins two pieces, since another bucket has it (a saving only).
    """
    order = np.lexsort((gray_rank(fp), group))
    group, fp = group[order], fp[order]
    forest = Forest(len(fp))
    if len(fp):
        levels = _levels(group, fp)
        roots = np.arange(len(levels[-1]["of"]))
        none = np.zeros(len(roots), np.uint64)
        work = [(len(levels) - 1, roots, roots, none, np.zeros(len(roots), np.int64))]
        while work:
            at, a, b, counted, gathered = work.pop()
            if len(a) > STEP:
                for cut in range(0, len(a), STEP):
                    part = slice(cut, cut + STEP)
                    work.append((at, a[part], b[part], counted[part], gathered[part]))
                continue
            node = levels[at]
            ones_a, ones_b, zeros_a, zeros_b = node["ones"][a], node["ones"][b], node["zeros"][a], node["zeros"][b]
            settled = (ones_a | zeros_a) & (ones_b | zeros_b)
            differ = (ones_a ^ ones_b) & settled & ~counted
            gathered = gathered + np.bitwise_count(differ)
            keep = gathered <= k
            varying = ~((ones_a & ones_b) | (zeros_a & zeros_b))
            whole = keep & (np.bitwise_count(varying) <= k)
            _link_whole(forest, levels, at, a[whole], b[whole])
            keep &= ~whole
            a, b, settled, gathered = a[keep], b[keep], settled[keep], gathered[keep]
            if not len(a):
                continue
            x, y, of = _children(node, a, b)
            if at == 0:
                near = (x != y) & (np.bitwise_count(fp[x] ^ fp[y]) <= k)
                forest.link(x[near], y[near])
            else:
                work.append((at - 1, x, y, settled[of], gathered[of]))
    child, root = forest.edges()
    return order[child], order[root]


def _link_whole(forest: Forest, levels: list, at: int, a: np.ndarray, b: np.ndarray) -> None:
    """Link all rows below each node pair to the first of them."""
    for side in (a, b):
        lo, hi, first = levels[at]["lo"][side], levels[at]["hi"][side], levels[at]["lo"][a]
        for level in levels[:at][::-1]:
            lo, hi, first = level["lo"][lo], level["hi"][hi - 1], level["lo"][first]
        n = hi - lo
        rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        forest.link(rows, np.repeat(first, n))


# -- links and components in Spark ---------------------------------------------------------------


def _masks(blocks: int, k: int) -> list[int]:
    """One mask per choice of ``blocks - k`` of the blocks of a 64-bit fingerprint."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
    return [sum(choice) for choice in combinations(parts, blocks - k)]


def _blocks(n: int, k: int) -> int:
    """The fewest blocks for which an even bucket has about 64 rows or fewer."""
    blocks = k + 1
    while blocks < k + 4 and 64 * (blocks - k) / blocks < np.log2(max(n, 2)) - 6:
        blocks += 1
    return blocks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forests(batches, k: int):
    """Batches of rows sorted by bucket -> spanning links; the last, open bucket is carried on."""

    def links(t: pa.Table):
        fp = t["fp"].to_numpy().view(np.uint64)
        mask, key = t["mask"].to_numpy(), t["key"].to_numpy()
        lo, hi = t["lo"].to_numpy(), t["hi"].to_numpy()
        new = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        group = np.r_[0, np.cumsum(new)]
        u, v = linked_rows(group, fp, k)
        return pa.RecordBatch.from_pydict(
            {"u": fp[u].view(np.int64), "v": fp[v].view(np.int64)},
            schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]),
        )

    carried = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if carried is not None and carried.num_rows:
            t = pa.concat_tables([carried, t]).combine_chunks()
        if t.num_rows < 4 * PIECE:
            carried = t
            continue
        ends = [t[c].to_numpy() for c in ("mask", "key", "lo", "hi")]
        same = np.logical_and.reduce([e == e[-1] for e in ends])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield links(t.slice(0, cut))
        carried = t.slice(cut)
    if carried is not None and carried.num_rows:
        yield links(carried)


def links(prints: DataFrame, k: int = 4, piece: int | None = None) -> DataFrame:
    """(u, v): links that connect all fingerprints with at most ``k`` differing bits.

    ``prints`` has distinct ``fp`` (long). Only spanning links of every bucket come back.
    """
    piece = piece or PIECE
    spark = prints.sparkSession
    masks = _masks(_blocks(prints.count(), k), k)
    probes = prints.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                    for i, m in enumerate(masks)
                )
            )
        ).alias("p"),
    ).select("fp", "p.mask", "p.key")
    hot = materialise(
        probes.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece),
        "hot-buckets",
    )
    if hot.isEmpty():
        placed = probes.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    else:
        pieces = F.ceil(F.col("n") / F.lit(piece)).cast("int")
        own = F.pmod(F.xxhash64("fp"), pieces.cast("bigint")).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), F.col("pieces") - 1),
            lambda i: F.struct(F.least(i, F.col("own")).alias("lo"), F.greatest(i, F.col("own")).alias("hi")),
        )
        placed = (
            probes.join(hot, ["mask", "key"], "left")
            .withColumn("pieces", F.coalesce(pieces, F.lit(1)))
            .withColumn("own", F.coalesce(own, F.lit(0)))
            .withColumn("p", F.explode(pairs))
            .select("fp", "mask", "key", "p.lo", "p.hi")
        )
    keys = ["mask", "key", "lo", "hi"]
    return (
        placed.repartition(shuffle_width(spark), *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(lambda batches: _forests(batches, k), "u long, v long")
    )


def components(prints: DataFrame, k: int = 4, piece: int | None = None) -> DataFrame:
    """(fp, root) for every fingerprint linked to a smaller one, directly or through others.

    ``prints`` has a column ``fp`` (long), repeats allowed. Fingerprints without a link are left
    out: they are their own root.
    """
    distinct = materialise(prints.select("fp").distinct(), "prints")
    found = materialise(links(distinct, k, piece), "links")
    return connected(found, "stars").select(F.col("node").alias("fp"), "root")


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, k: int = 4
) -> DataFrame:
    """(key, fp, component) per row: the smallest key whose fingerprint can be reached.

    Defined results: a missing text is empty, empty texts have fingerprint zero and link like any
    other, repeated rows come back as often as they occur, a missing key stays missing and never
    names a component unless no row of it has a key. Empty tables give empty results; further
    columns are ignored.
    """
    marked = materialise(
        documents.select(F.col(key).alias("id"), fingerprint(F.col(text), width).alias("fp")),
        "fingerprints",
    )
    folded = materialise(marked.groupBy("fp").agg(F.min("id").alias("first")), "folded")
    rooted = folded.join(components(folded, k), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component"))
    labels = rooted.select("fp", "root").join(names, "root").select("fp", "component")
    return marked.join(labels, "fp").select(F.col("id").alias(key), "fp", "component")


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, k: int = 4) -> DataFrame:
    """One row of each component, that with the smallest key; all columns as they came.

    Ties (repeated keys) keep the row written first; rows without a key come last.
    """
    row, fp = free_name(documents, "_row"), free_name(documents, "_fp")
    marked = with_row_ids(documents.withColumn(fp, fingerprint(F.col(text), width)), row, "marked")
    narrow = marked.select(
        F.col(fp).alias("fp"),
        F.struct(F.col(key).isNull().alias("a"), F.col(key).alias("b"), F.col(row).alias("c")).alias("rank"),
    )
    folded = materialise(narrow.groupBy("fp").agg(F.min("rank").alias("rank")), "folded")
    rooted = folded.join(components(folded, k), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("rank").alias("rank")).select(F.col("rank.c").alias(row))
    return marked.join(kept, row, "left_semi").select(documents.columns)
