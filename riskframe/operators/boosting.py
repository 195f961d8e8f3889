"""Gradient-boosted trees on histograms of bin numbers, one Spark job per level of a tree.

The rows are written once as blocks of bin numbers (a byte per row and feature), dealt evenly to the
cores however the table came in. A task adds up counts and residuals per node, feature and bin of its
blocks; the driver sees these sums, a size that does not depend on the rows, and picks the splits.
Loss, residuals, leaves and weights are those of ``pyspark.ml``'s GBTClassifier, whose margin is kept
beside each block from tree to tree. Rows that are worth one task only are learnt from in one task, by the
same steps.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no path to this package

BINS = 32
BLOCK_ROWS = 20_000  # rows of a block, and least rows per task of a job
TASK_ROWS = 2_000_000  # most rows per task, beyond one task per core
CUT_VALUES = 500_000  # values that place the cuts between bins, of 10,000 rows at least
CHAIN = 50  # trees after which margins are derived from the written blocks again
DRIVER_BYTES = 64 << 20  # sums that the driver adds up itself


def place_cuts(values: np.ndarray) -> np.ndarray:
    """At most BINS - 1 cuts between distinct values; all of them where there are few values."""
    distinct, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    if len(distinct) <= BINS:
        at = np.arange(len(distinct) - 1)
    else:
        total = np.cumsum(counts)
        at = np.unique(np.searchsorted(total, total[-1] * np.arange(1, BINS) / BINS))
        at = at[at < len(distinct) - 1]
    with np.errstate(invalid="ignore"):
        cuts = distinct[at] / 2 + distinct[at + 1] / 2
    return np.unique(cuts[~np.isnan(cuts)])


def bin_rows(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers, one row per feature: bin b lies above cut b - 1, up to cut b; NaN in the last."""
    out = np.empty((len(cuts), len(x)), np.uint8)
    for j, edges in enumerate(cuts):
        out[j] = np.searchsorted(edges, x[:, j], "left")
    return out


def descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
    """The node of each row after ``steps`` splits; children of node i are 2i + 1 and 2i + 2."""
    n = x.shape[1]
    node = np.zeros(n, np.intp)
    if steps and n:
        node += 1
        node += x[feature[0]] > cut[0]
        flat, offset, at = x.reshape(-1), feature.astype(np.intp) * n, np.arange(n)
        for _ in range(steps - 1):
            right = flat.take(offset.take(node) + at) > cut.take(node)
            node *= 2
            node += 1
            node += right
    return node


def residuals(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """Negative gradient of 2 log(1 + exp(-2 y margin)); the first tree learns the labels -1, 1."""
    if margin is None:
        return y.astype(np.float64)
    with np.errstate(over="ignore"):
        return 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


@dataclass
class Tree:
    """A complete tree of ``depth`` levels; a node that is not split sends its rows to the left."""

    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    gain: np.ndarray  # per feature, summed over rows

    def predict(self, x: np.ndarray) -> np.ndarray:
        first = (1 << self.depth) - 1
        return self.leaf.take(descend(x, self.feature, self.cut, self.depth) - first)


@dataclass
class Binned:
    """Written blocks (block, n, x, y), the cuts of their bins, their rows and the tasks to use."""

    blocks: DataFrame
    cuts: list[np.ndarray]
    n_rows: int
    width: int

    @classmethod
    def of(cls, rows: DataFrame, n_rows: int | None = None) -> Binned:
        """Blocks of a written matrix (``_features``, ``_label``)."""
        n_rows = rows.count() if n_rows is None else n_rows
        if not n_rows:
            raise ValueError("no rows to learn from")
        rows = rows.select(vector_to_array("_features").alias("x"), F.col("_label").alias("y"))
        n_features = len(rows.first()["x"])
        wanted = max(10_000, CUT_VALUES // max(1, n_features))
        drawn = rows.sample(wanted / n_rows, 42) if wanted < n_rows else rows
        values = np.array([r["x"] for r in drawn.select("x").collect()], np.float64).reshape(-1, n_features)
        cuts = [place_cuts(values[:, j]) for j in range(n_features)]
        schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])

        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, xs, ys, held = TaskContext.get().partitionId() << 32, [], [], 0

            def block():
                x, y = np.concatenate(xs, axis=1), np.concatenate(ys)
                return pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([len(y)], pa.int32()), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                    schema=schema,
                )

            for batch in batches:
                label = batch["y"].to_numpy(zero_copy_only=False)
                if not np.isin(label, (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 or 1, none may be missing")
                given = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(label), n_features)
                x, y = bin_rows(given, cuts), (2 * label - 1).astype(np.int8)
                for at in range(0, len(y), BLOCK_ROWS):
                    xs.append(x[:, at : at + BLOCK_ROWS])
                    ys.append(y[at : at + BLOCK_ROWS])
                    held += len(ys[-1])
                    if held >= BLOCK_ROWS:
                        yield block()
                        number, xs, ys, held = number + 1, [], [], 0
            if held:
                yield block()

        cores = rows.sparkSession.sparkContext.defaultParallelism
        width = max(1, min(n_rows // BLOCK_ROWS, cores * math.ceil(n_rows / (cores * TASK_ROWS))))
        packed = rows.mapInArrow(pack, "block long, n int, x binary, y binary")
        return cls(materialise(packed, "blocks").repartition(width), cuts, n_rows, width)

    def rdd(self, draw: Draw, trees: Sequence[tuple[float, Tree]] = ()) -> RDD:
        """States of the blocks after the weighted ``trees``; there is no margin before the first."""
        n_features = len(self.cuts)

        def opened(row):
            x = np.frombuffer(row["x"], np.uint8).reshape(n_features, row["n"])
            margin = sum(w * tree.predict(x) for w, tree in trees) if trees else None
            return draw.state(row["block"], x, np.frombuffer(row["y"], np.int8), margin)

        return self.blocks.rdd.map(opened)


@dataclass
class Draw:
    """The rows drawn for a tree: by block, so that neither tasks nor retries matter."""

    share: float
    seed: list[int]

    def state(self, block: int, x: np.ndarray, y: np.ndarray, margin: np.ndarray | None):
        """(block, bins, labels, margin, residuals, rows drawn) of one block."""
        drawn = None
        if self.share < 1:
            drawn = np.random.Generator(np.random.SFC64([*self.seed, block])).random(len(y)) < self.share
        return block, x, y, margin, residuals(y, margin), drawn


def _advanced(weight: float, tree: Tree, draw: Draw):
    """The state of a block for the next tree."""

    def run(state):
        block, x, y, margin, _, _ = state
        step = weight * tree.predict(x)
        return draw.state(block, x, y, step if margin is None else margin + step)

    return run


def _summed(feature, cut, level: int, slot, n_slots: int):
    """Rows and residuals per (feature, slot of a node, bin) over the blocks of a task."""

    def run(blocks):
        out, size = None, n_slots * BINS
        for _, x, _, _, g, drawn in blocks:
            if out is None:
                out = np.zeros((2, len(x), size))
            if level == 0:
                here = None if drawn is None else np.flatnonzero(drawn)
                at = 0
            else:
                at = slot.take(descend(x, feature, cut, level))
                here = np.flatnonzero(at >= 0 if drawn is None else (at >= 0) & drawn)
                at = at.take(here) * BINS
            if here is not None:
                g = g.take(here)
            for j, bins in enumerate(x):
                index = at + (bins if here is None else bins.take(here)).astype(np.intp)
                out[0, j] += np.bincount(index, minlength=size)
                out[1, j] += np.bincount(index, g, size)
        if out is not None:
            yield out.reshape(2, len(out[0]), n_slots, BINS)

    return run


def _total(parts: RDD, n_bytes: int) -> np.ndarray:
    """Sum of the tasks' arrays; many large ones are added up in tasks first."""
    if parts.getNumPartitions() * n_bytes > DRIVER_BYTES:
        return parts.treeReduce(np.add)
    found = parts.collect()  # sums of one task each, in the order of the tasks
    return np.sum(found, axis=0)


def _best(counts: np.ndarray, sums: np.ndarray, allowed: np.ndarray) -> tuple[float, int, int]:
    """(gain, feature, bin) of the split of one node that lowers the squared error most."""
    n, s = counts[0].sum(), sums[0].sum()
    left_n, left_s = np.cumsum(counts, 1)[:, :-1], np.cumsum(sums, 1)[:, :-1]
    right_n, right_s = n - left_n, s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left_s**2 / left_n + right_s**2 / right_n
    gain = np.where((left_n > 0) & (right_n > 0) & allowed[:, None], apart - s**2 / n, -np.inf)
    j, b = np.unravel_index(np.argmax(gain), gain.shape)
    found = gain[j, b]
    noise = 1e-10 * apart[j, b] if np.isfinite(found) else 0.0
    return (float(found) if found > noise else 0.0), int(j), int(b)


def _grow(total: Callable, n_features: int, depth: int, columns: float, seed: Sequence[int], memory: int) -> Tree:
    feature, cut = np.zeros((1 << depth) - 1, np.int32), np.full((1 << depth) - 1, 255, np.uint8)
    value, gains = np.zeros((2 << depth) - 1), np.zeros(n_features)
    drawn = math.ceil(columns * n_features) if columns < 1 else n_features
    at_once = max(1, memory // (6 * 8 * n_features * BINS))  # sums of a node, its sibling and their parent
    live: list[tuple[int, int | None, np.ndarray | None]] = [(0, None, None)]  # (smaller child, its sibling, sums of both)
    for level in range(max(1, depth)):
        further = []
        for start in range(0, len(live), at_once):
            part = live[start : start + at_once]
            slot = np.full((2 << level) - 1, -1, np.intp)
            slot[[node for node, _, _ in part]] = np.arange(len(part))
            sums = total(_summed(feature, cut, level, slot, len(part)), 16 * n_features * BINS * len(part))
            for i, (node, sibling, both) in enumerate(part):
                own = sums[:, :, i]
                for at, (counts, totals) in ((node, own), *([] if sibling is None else [(sibling, both - own)])):
                    n = counts[0].sum()
                    if at == 0:
                        value[0] = totals[0].sum() / n if n else 0.0
                    if n < 2 or not depth:
                        continue
                    allowed = np.ones(n_features, bool)
                    if drawn < n_features:
                        allowed[:] = False
                        allowed[np.random.default_rng([*seed, at, 1]).permutation(n_features)[:drawn]] = True
                    gain, j, b = _best(counts, totals, allowed)
                    if not gain:
                        continue
                    feature[at], cut[at] = j, b
                    gains[j] += gain
                    left, right = counts[j, : b + 1].sum(), counts[j, b + 1 :].sum()
                    value[2 * at + 1], value[2 * at + 2] = totals[j, : b + 1].sum() / left, totals[j, b + 1 :].sum() / right
                    small = 2 * at + 1 + int(right < left)
                    further.append((small, 4 * at + 3 - small, np.stack([counts, totals])))
        live = further
        if not live or not depth:
            break
    for node in np.flatnonzero(cut == 255):  # parents come first
        value[2 * node + 1] = value[2 * node + 2] = value[node]
    return Tree(depth, feature, cut, value[(1 << depth) - 1 :], gains)


def boost(
    data: Binned, trees: int, depth: int, step: float, row_share: float, column_share: float, seed: int, memory: int
) -> TreesModel:
    """Learn ``trees`` trees one after the other; the first has weight 1, later ones ``step``."""
    draws = [Draw(row_share, [seed & 0xFFFFFFFF, i]) for i in range(trees)]
    n_features = len(data.cuts)

    def grown(i: int, total: Callable) -> tuple[float, Tree]:
        return (step if i else 1.0), _grow(total, n_features, depth, column_share, draws[i].seed, memory)

    if data.width == 1:  # few rows: the jobs would take longer than the work

        def all_trees(states):
            states, found = list(states), []
            for i in range(trees):
                found.append(grown(i, lambda run, _: next(run(states))))
                states = list(map(_advanced(*found[-1], draws[min(i + 1, trees - 1)]), states))
            yield from ((w, vars(tree)) for w, tree in found)

        return TreesModel(data.cuts, [(w, Tree(**tree)) for w, tree in data.rdd(draws[0]).mapPartitions(all_trees).collect()])

    found: list[tuple[float, Tree]] = []
    level = StorageLevel.MEMORY_AND_DISK
    state, old = data.rdd(draws[0]).persist(level), None
    try:
        for i in range(trees):
            found.append(grown(i, lambda run, n_bytes: _total(state.mapPartitions(run), n_bytes)))
            if old is not None:
                old.unpersist()
            old = state
            if i + 1 < trees:
                again = (i + 1) % CHAIN == 0
                state = (data.rdd(draws[i + 1], list(found)) if again else old.map(_advanced(*found[-1], draws[i + 1]))).persist(level)
    finally:
        for rdd in (old, state):
            if rdd is not None:
                rdd.unpersist()
    return TreesModel(data.cuts, found)


def _probability(x: np.ndarray, trees: Sequence[tuple[float, Tree]]) -> np.ndarray:
    """The probability of class 1 of rows of bin numbers."""
    margin = sum(w * tree.predict(x) for w, tree in trees)
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


class _Writer(MLWriter):
    def __init__(self, model: TreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, model = self.sparkSession, self.model
        DefaultParamsWriter.saveMetadata(model, path, spark)
        spark.createDataFrame(
            [(j, c.tolist()) for j, c in enumerate(model.cuts)], "feature int, cuts array<double>"
        ).coalesce(1).write.parquet(f"{path}/cuts")
        spark.createDataFrame(
            [(i, w, t.depth, t.feature.tolist(), t.cut.tolist(), t.leaf.tolist(), t.gain.tolist()) for i, (w, t) in enumerate(model.trees)],
            "tree int, weight double, depth int, feature array<int>, cut array<int>, leaf array<double>, gain array<double>",
        ).coalesce(1).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> TreesModel:
        spark = self.sparkSession
        cuts = [np.array(r["cuts"], np.float64) for r in spark.read.parquet(f"{path}/cuts").orderBy("feature").collect()]
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()  # a row per tree
        trees = [
            (r["weight"], Tree(r["depth"], np.array(r["feature"], np.int32), np.array(r["cut"], np.uint8), np.array(r["leaf"]), np.array(r["gain"])))
            for r in rows
        ]
        model, metadata = TreesModel(cuts, trees), DefaultParamsReader.loadMetadata(path, spark)
        model._resetUid(metadata["uid"])
        return model


class TreesModel(Model, MLReadable, MLWritable):
    """Adds ``probability`` (a vector of both classes) to rows with ``_features``."""

    def __init__(self, cuts: Sequence[np.ndarray] = (), trees: Sequence[tuple[float, Tree]] = ()):
        super().__init__()
        self.cuts, self.trees = list(cuts), list(trees)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Squared error taken off by the splits on each feature, as shares."""
        gain = np.sum([t.gain for _, t in self.trees], axis=0)
        return DenseVector(gain / gain.sum() if gain.sum() else gain)

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts, trees = self.cuts, self.trees

        @F.pandas_udf("double")
        def probability(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype="float64")
            return pd.Series(_probability(bin_rows(np.stack(rows.to_numpy()), cuts), trees))

        p = probability(vector_to_array("_features"))
        return df.withColumn("_p1", p).withColumn("probability", array_to_vector(F.array(1 - F.col("_p1"), F.col("_p1")))).drop("_p1")

    def replaced(self, features: Column, values: Sequence[float]) -> Column:
        """Per row of ``features`` (an array), the probabilities with each feature in turn set to its value."""
        cuts, trees = self.cuts, self.trees
        bins = bin_rows(np.array([values], np.float64), cuts)[:, 0]

        @F.pandas_udf("array<double>")
        def probabilities(rows: pd.Series) -> pd.Series:
            out: list[np.ndarray] = []
            for at in range(0, len(rows), BLOCK_ROWS):
                x = bin_rows(np.array(rows.iloc[at : at + BLOCK_ROWS].tolist(), np.float64), cuts)
                found = np.empty((x.shape[1], len(x)))
                for j, b in enumerate(bins):
                    own = x[j].copy()
                    x[j] = b
                    found[:, j] = _probability(x, trees)
                    x[j] = own
                out.extend(found)
            return pd.Series(out, dtype=object)

        return probabilities(features)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()
