"""Hard negatives by rotated one-bit codes whose bounds are certain.

A vector x is turned by a fixed rotation and keeps one sign bit per component, its norm, and the
alignment a: the cosine between its direction and its code taken as a unit vector b. The direction
is then a*b plus a residual of length sqrt(1 - a*a) at right angles to b. A query is rounded to
eight bit planes; popcounts of code and planes give s, its product with b, and by Cauchy-Schwarz the
product with the direction lies within a*s -+ sqrt(|q|^2 - s^2) * sqrt(1 - a*a), widened by the length
of what the rounding cut off. Only vectors whose interval can still reach a result are scored, in
integers. The intervals hold always, so nothing is missed.

Searches run in two passes over chunks of bounded size: an anchor's positives against the chunks of
its label, then its negatives against all others, each with the score windows that its positives
set. Equal vectors of one label are folded to the few smallest ids that any result can hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.centroids import integers
from riskframe.session import materialise

PLANES = 8
_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(d: int, seed: int = 42) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    if d not in _ROTATIONS:
        _ROTATIONS[d] = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    return _ROTATIONS[d]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    n, d = bits.shape
    padded = np.zeros((n, -(-max(d, 1) // 64) * 64), bool)
    padded[:, :d] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """Integer vectors of one length with their codes, norms and alignments."""

    def __init__(self, x: np.ndarray):
        self.x, d = x, x.shape[1]
        turned = x.astype(np.float64) @ rotation(d).T
        bits = turned >= 0
        self.words, self.d = _words(bits), d
        self.set = np.bitwise_count(self.words).sum(1).astype(np.float64)
        self.norm = np.sqrt((turned * turned).sum(1))
        along = (np.abs(turned).sum(1) / np.sqrt(max(d, 1)))  # norm times alignment
        self.along = along
        self.off = np.sqrt(np.maximum(self.norm**2 - along**2, 0))

    def interval(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products with ``q``; they hold whatever the data."""
        if not self.d:
            return np.zeros(len(self.x)), np.zeros(len(self.x))
        turned = rotation(self.d) @ q.astype(np.float64)
        low = turned.min()
        step = max((turned.max() - low) / ((1 << PLANES) - 1), 1e-300)
        level = np.rint((turned - low) / step).astype(np.int64)
        rounded = low + step * level
        counts = np.zeros(len(self.x))
        for j in range(PLANES):
            plane = _words(((level >> j) & 1).astype(bool)[None])
            counts += (1 << j) * np.bitwise_count(self.words & plane).sum(1)
        s = (2 * (low * self.set + step * counts) - rounded.sum()) / np.sqrt(self.d)
        middle = self.along * s
        length = np.sqrt((rounded * rounded).sum())
        width = np.sqrt(np.maximum(length**2 - s * s, 0)) * self.off
        width += self.norm * np.sqrt(((turned - rounded) ** 2).sum())
        width += 1e-9 * self.norm * (length + 1) + 1e-6  # rounding of all these doubles
        return middle - width, middle + width

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact integer products."""
        return (self.x[rows] * q).sum(1)


def _first(scores: np.ndarray, rows: np.ndarray, ids: list, own, k: int) -> list:
    """The k best (score, id) of the rows: higher scores, then smaller ids; never ``own``."""
    if len(rows) > k + 1:  # each row but the anchor's own holds a result
        edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        rows, scores = rows[scores >= edge], scores[scores >= edge]
    found = sorted((-int(s), i) for s, r in zip(scores, rows) for i in ids[r] if i != own)
    return [(-s, i) for s, i in found[:k]]


def best(codes: Codes, ids: list, q: np.ndarray, own, k: int) -> list:
    """The k highest scores of ids other than ``own``."""
    low, high = codes.interval(q)
    n = len(low)
    edge = np.partition(low, n - k - 1)[n - k - 1] if n > k + 1 else -np.inf
    rows = np.flatnonzero(high >= edge)
    return _first(codes.scores(q, rows), rows, ids, own, k)


def best_within(codes: Codes, ids: list, q: np.ndarray, windows: list, k: int) -> list:
    """For each window (lowest, highest): its k highest scores."""
    low, high = codes.interval(q)
    wanted = np.zeros(len(low), bool)
    for least, most in windows:
        sure = low[high <= most]
        edge = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) >= k else -np.inf
        wanted |= (high >= max(least, edge)) & (low <= most)
    rows = np.flatnonzero(wanted)
    scores = codes.scores(q, rows)
    out = []
    for least, most in windows:
        inside = (scores >= least) & (scores <= most)
        out.append(_first(scores[inside], rows[inside], ids, None, k))
    return out


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


@dataclass(frozen=True)
class HardNegatives:
    """``positives`` and ``negatives``: how many of each; a negative scores at least ``floor`` percent of
    the positive and no more than it. ``chunk`` and ``block``: vectors and anchors compared in one task, about."""

    positives: int = 5
    negatives: int = 5
    floor: int = 80
    scale: int = 256
    chunk: int = 8_192
    block: int = 1_024

    def mine(self, table: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label") -> DataFrame:
        """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

        Rows without id, label or vector, or with a missing or non-finite component, take no part;
        vectors of different lengths are never compared. Rows with the anchor's id are not others of
        it; wholly repeated rows count once. Ties go to the smaller id. Empty tables give empty
        results, further columns are ignored.
        """
        label = F.col(label) if isinstance(label, str) else label
        rows = table.select(
            F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), integers(F.col(vector), self.scale).alias("x"),
            F.coalesce(anchors, F.lit(False)).alias("asked"),
        ).where("id is not null and label is not null and x is not null")
        rows = materialise(rows, "labelled-vectors")
        asked = rows.where("asked").select("id", "label", "x").distinct().withColumn("a", F.monotonically_increasing_id())
        asked = materialise(asked.withColumn("d", F.size("x")), "anchors")
        chunks = self._chunked(rows)
        found = self._positives(asked, chunks)
        positives = materialise(self._ranked(found, ["a"], self.positives), "positives")
        windows = positives.where("score >= 0").groupBy("a").agg(F.sort_array(F.collect_set("score")).alias("highest"))
        negatives = self._ranked(self._negatives(asked.join(windows, "a"), chunks), ["a", "highest"], self.negatives)
        named = negatives.select("a", F.col("highest").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        pairs = positives.select("a", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        joined = named.join(pairs, ["a", "positive_score"]).join(asked.select("a", F.col("id").alias("anchor_id")), "a")
        return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

    def _chunked(self, rows: DataFrame) -> DataFrame:
        """(d, label, chunk, x, ids): distinct vectors of a label with the smallest ids that matter."""
        keep = max(self.positives + 1, self.negatives)
        order = Window.partitionBy("label", "x").orderBy("id")
        few = rows.select("label", "x", "id").withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= keep)
        folded = few.groupBy("label", "x").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        folded = materialise(folded.withColumn("d", F.size("x")), "folded-vectors")
        sizes = folded.groupBy("d", "label").agg(F.ceil(F.count(F.lit(1)) / self.chunk).cast("bigint").alias("chunks"))
        placed = folded.join(sizes, ["d", "label"]).withColumn("chunk", F.pmod(F.xxhash64("x"), "chunks").cast("int"))
        return materialise(placed.drop("chunks"), "chunked-vectors")

    def _blocks(self, asked: DataFrame, keys: list[str]) -> DataFrame:
        """Anchors with a block number within ``keys``."""
        sizes = asked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / self.block).cast("bigint").alias("blocks"))
        return asked.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("a"), "blocks").cast("int")).drop("blocks")

    def _met(self, asked: DataFrame, chunks: DataFrame, on: list[str], run, schema: str) -> DataFrame:
        """Every block of anchors with every chunk that agrees in ``on``, one group each."""
        blocks = materialise(self._blocks(asked, on), "blocks")
        chunks = chunks.withColumnsRenamed({"d": "c_d", "label": "c_label"})
        met = [F.col(c) == F.col(f"c_{c}") for c in on]
        # one row per block and chunk number: (anchors / block) x (vectors / chunk) of them
        tasks = blocks.select(*on, "block").distinct().join(chunks.select("c_d", "c_label", "chunk").distinct(), met)
        tasks = materialise(tasks.withColumn("task", F.monotonically_increasing_id()), "search-tasks")
        left = blocks.join(tasks.select(*on, "block", "task"), [*on, "block"])
        of = ["c_d", "c_label", "chunk"]
        right = chunks.join(tasks.select(*of, F.col("task").alias("c_task")), of)
        return left.groupBy("task").cogroup(right.select("c_task", "c_label", "x", "ids").groupBy("c_task")).applyInPandas(run, schema)

    def _positives(self, asked: DataFrame, chunks: DataFrame) -> DataFrame:
        k = self.positives

        def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(q) and len(c):
                codes, ids = Codes(_stacked(c["x"])), c["ids"].tolist()
                for a, own, x in zip(q["a"], q["id"], q["x"]):
                    out += [(a, i, s) for s, i in best(codes, ids, np.asarray(x, np.int64), own, k)]
            return pd.DataFrame(out, columns=["a", "id", "score"])

        return self._met(asked, chunks, ["d", "label"], run, "a long, id long, score long")

    def _negatives(self, asked: DataFrame, chunks: DataFrame) -> DataFrame:
        k, floor = self.negatives, self.floor

        def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(q) and len(c):
                codes, ids, label = Codes(_stacked(c["x"])), c["ids"].tolist(), c["c_label"].iloc[0]
                q = q[q["label"] != label]
                for a, x, highest in zip(q["a"], q["x"], q["highest"]):
                    windows = [(-(-floor * int(p) // 100), int(p)) for p in highest]
                    for (_, p), found in zip(windows, best_within(codes, ids, np.asarray(x, np.int64), windows, k)):
                        out += [(a, p, i, s) for s, i in found]
            return pd.DataFrame(out, columns=["a", "highest", "id", "score"])

        return self._met(asked, chunks, ["d"], run, "a long, highest long, id long, score long")

    def _ranked(self, scored: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def equivalent_sql(h: HardNegatives, anchors: str, label: str) -> str:
    """The same by scoring every anchor with every row; ``anchors`` and ``label`` are SQL on the table."""
    return f"""
WITH v AS (
  SELECT vec_id, {label} AS label, {anchors} AS asked,
         list_transform(embedding, lambda e: CAST(floor({h.scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.asked),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS rn FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
         s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id
  WHERE p.rn <= {h.positives} AND NOT s.same
    AND {h.floor} * p.score <= 100 * s.score AND s.score <= p.score)
SELECT * FROM n WHERE rank <= {h.negatives}"""
