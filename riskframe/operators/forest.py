"""Isolation forest (Liu, Ting and Zhou, 2008) as grouped and batched jobs.

Trees grow from small hash samples, one group per tree; the node table (at most
``trees * 2 * sample_rows`` rows) is written as Parquet and sent to the scoring tasks, which
walk all trees for a batch of rows at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators.ordering import exact_quantiles
from riskframe.session import materialise

NODES = (
    "tree int, node int, feature int, threshold double, left_child int, right_child int, "
    "path double"
)


@dataclass
class IsolationForest:
    contamination: float = 0.035
    trees: int = 100
    sample_rows: int = 256
    seed: int = 42

    def fit(self, df: DataFrame, features: list[str]) -> IsolationForestModel:
        """Learn from the rows of ``df`` (the legitimate ones)."""
        if not 0 < self.contamination < 1:
            raise ValueError("contamination must lie between 0 and 1")
        vectors = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"))
        n = vectors.count()
        if n == 0:
            raise ValueError("no rows to learn from")
        rows = min(self.sample_rows, n)
        nodes = materialise(
            self._draw(vectors, n, rows).groupBy("tree").applyInPandas(
                _tree_builder(rows, self.seed), NODES
            ),
            "forest",
        )
        model = IsolationForestModel(nodes, features, rows, 0.0)
        # scored once and written (one number per row); the quantile is exact
        scores = materialise(df.select(model.score().alias("s")), "anomaly")
        model.threshold = exact_quantiles(scores, {"s": F.col("s")}, [1.0 - self.contamination])[
            "s"
        ][0]
        return model

    def _draw(self, vectors: DataFrame, n: int, rows: int) -> DataFrame:
        """(tree, x): ``rows`` rows per tree, without repeats inside a tree, alike at every size.

        Each row draws the number of trees it offers itself to (binomial, by one uniform) and which
        they are; every tree keeps the offers of smallest hash. About ``trees * rows`` rows are
        offered in all, whatever the size of the table.
        """
        share = min(1.0, (rows + 6 * math.sqrt(rows)) / n)
        below, total = [], 0.0
        for k in range(self.trees):  # P(offers <= k)
            if share < 1.0:
                total += math.exp(
                    math.lgamma(self.trees + 1) - math.lgamma(k + 1) - math.lgamma(self.trees - k + 1)
                    + k * math.log(share) + (self.trees - k) * math.log1p(-share)
                )
            below.append(total)

        def draw(*parts) -> Column:
            return F.xxhash64(F.lit(self.seed), "id", *parts)

        u = (F.shiftrightunsigned(draw(F.lit(-1)), 11).cast("double") + 0.5) * F.lit(2.0**-53)
        offers = F.size(F.filter(F.array(*map(F.lit, below)), lambda p: p < u))
        trees = F.sequence(F.lit(0), F.lit(self.trees - 1))
        chosen = F.slice(
            F.array_sort(F.transform(trees, lambda t: F.struct(draw(t).alias("h"), t.alias("tree")))),
            F.lit(1), F.col("offers"),
        )
        smallest = Window.partitionBy("tree").orderBy("h", "id")
        return (
            vectors.withColumn("id", F.monotonically_increasing_id())
            .withColumn("offers", offers)
            .where("offers > 0")
            .select("id", "x", F.inline(chosen))
            .withColumn("place", F.row_number().over(smallest))
            .where(F.col("place") <= rows)
            .select("tree", "x")
        )


def _tree_builder(sample_rows: int, seed: int):
    """Grouped-map function: one random tree from one sample."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        deepest = max(1, math.ceil(math.log2(max(2, sample_rows))))
        out = []

        def expected(size: int) -> float:
            if size <= 1:
                return 0.0
            if size == 2:
                return 1.0
            return 2.0 * (math.log(size - 1) + 0.5772156649015329) - 2.0 * (size - 1) / size

        def grow(idx: np.ndarray, depth: int) -> int:
            me = len(out)
            out.append(None)
            low, high = x[idx].min(axis=0), x[idx].max(axis=0)
            usable = np.flatnonzero((high > low) & np.isfinite(low) & np.isfinite(high))
            if depth >= deepest or len(idx) <= 1 or len(usable) == 0:
                out[me] = (tree, me, -1, 0.0, me, me, depth + expected(len(idx)))
                return me
            feature = int(rng.choice(usable))
            # strictly below the largest value, so that both sides hold a row
            at, end = float(low[feature]), float(high[feature])
            cut = min(at + float(rng.random()) * (end - at), float(np.nextafter(end, at)))
            goes_left = x[idx, feature] <= cut
            left = grow(idx[goes_left], depth + 1)
            right = grow(idx[~goes_left], depth + 1)
            out[me] = (tree, me, feature, cut, left, right, 0.0)
            return me

        grow(np.arange(len(x)), 0)
        names = ["tree", "node", "feature", "threshold", "left_child", "right_child", "path"]
        return pd.DataFrame(out, columns=names)

    return build


@dataclass
class IsolationForestModel:
    nodes: DataFrame
    features: list[str]
    sample_rows: int
    threshold: float

    def score(self) -> Column:
        """Anomaly score in (0, 1) of the current row; high means easily isolated."""
        if not hasattr(self, "_walk"):
            self._walk = _scorer(self.nodes, self.sample_rows)
        return self._walk(F.array(*[F.col(f"`{c}`").cast("double") for c in self.features]))

    def flag(self, df: DataFrame, score: str = "anomaly_score", flag: str = "if_flag") -> DataFrame:
        """Add the score and the outlier flag (score above the learnt threshold)."""
        return df.withColumn(score, self.score()).withColumn(
            flag, (F.col(score) > F.lit(self.threshold)).cast("int")
        )

    def save(self, path: str, spark: SparkSession) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(
            [(self.features, self.sample_rows, float(self.threshold))],
            "features array<string>, sample_rows int, threshold double",
        ).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> IsolationForestModel:
        row = spark.read.parquet(f"{path}/settings").first()
        nodes = spark.read.parquet(f"{path}/nodes")
        return cls(nodes, list(row["features"]), row["sample_rows"], row["threshold"])


def _scorer(nodes: DataFrame, sample_rows: int):
    """Batched scoring function over the flattened trees.

    A leaf points to itself and its threshold is infinite, so every row takes the same number of
    steps through every tree.
    """
    table = nodes.orderBy("tree", "node").toPandas()  # bounded by trees * 2 * sample_rows
    sizes = table.groupby("tree").size().to_numpy()
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    shift = np.repeat(base, sizes)
    children = np.stack([table["left_child"] + shift, table["right_child"] + shift], axis=1)
    leaf = table["feature"].to_numpy() < 0
    packed = nodes.sparkSession.sparkContext.broadcast(
        {
            "root": base.astype(np.int32),
            "feature": np.where(leaf, 0, table["feature"]).astype(np.int32),
            "threshold": np.where(leaf, np.inf, table["threshold"]),
            "child": children.astype(np.int32).ravel(),
            "path": table["path"].to_numpy(),
        }
    )
    n = sample_rows
    steps = max(1, math.ceil(math.log2(max(2, n))))
    usual = 1.0 if n <= 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n

    @F.pandas_udf("double")
    def walk(vectors: pd.Series) -> pd.Series:
        t = packed.value
        out = np.empty(len(vectors))
        for start in range(0, len(vectors), 1024):
            x = np.stack(vectors.iloc[start : start + 1024].to_numpy())
            rows, width = x.shape
            flat = x.ravel()
            offset = (np.arange(rows, dtype=np.int32) * width)[:, None]
            at = np.broadcast_to(t["root"], (rows, len(t["root"])))
            for _ in range(steps):
                value = flat.take(offset + t["feature"].take(at))
                at = t["child"].take(2 * at + (value > t["threshold"].take(at)))
            out[start : start + 1024] = np.exp2(-t["path"].take(at).mean(axis=1) / usual)
        return pd.Series(out)

    return walk
