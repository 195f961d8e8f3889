"""Parameter search over walk-forward folds, halved as trees are added.

All trials of all folds learn from one written matrix, cut into folders at the ranks of the folds: a
fold's training and test rows are filters on the folder, so a fit reads its own folders only. A fold's
training rows are binned once for all its trials, and the scores of a trial are written before they are
ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import metrics
from riskframe.operators.boosting import Binned
from riskframe.operators.models import LABEL, PROBABILITY, BoostedModel, BoostedTrees, ParameterSearch
from riskframe.operators.ordering import order_cuts, total_order, with_segment
from riskframe.operators.splits import KEY, TIME, walk_forward_plan
from riskframe.session import scratch_path


@dataclass
class FoldedMatrix:
    """A written matrix with a folder per segment between the cuts of the folds."""

    rows: DataFrame
    plan: list[tuple[int, int]]
    starts: list[int]
    sizes: dict[int, int]

    @classmethod
    def write(
        cls, df: DataFrame, features: Sequence[str], label: str, folds: int, test_size: float, time_col: str, id_col: str
    ) -> FoldedMatrix:
        plan: list[tuple[int, int]] = []
        ranks: list[int] = []

        def edges(n: int) -> list[int]:
            plan.extend(walk_forward_plan(n, folds, test_size))
            ranks.extend(sorted({r for pair in plan for r in pair}))
            return ranks

        order = total_order(df, time_col, id_col)
        cut = with_segment(df, order, order_cuts(df, order, edges), "_segment")
        spark, path = df.sparkSession, scratch_path(df.sparkSession, "folded-matrix")
        matrix = BoostedTrees.matrix(cut, features, label, keep=("_segment",))
        matrix.write.partitionBy("_segment").parquet(path)
        rows = spark.read.schema(matrix.schema).parquet(path)
        sizes = {r["_segment"]: r["count"] for r in rows.groupBy("_segment").count().collect()}  # a row per cut
        return cls(rows, plan, [0, *ranks], sizes)

    def part(self, fold: int, role: str) -> tuple[DataFrame, int]:
        """(rows, their number) of a fold's ``train`` or ``test`` part."""
        start, end = self.plan[fold]
        lo, hi = (0, start) if role == "train" else (start, end)
        inside = [i for i, at in enumerate(self.starts) if lo <= at < hi]
        return self.rows.where(F.col("_segment").isin(inside)), sum(self.sizes.get(i, 0) for i in inside)


@dataclass
class FoldSearch:
    """Seeded draws, each judged by its mean ROC-AUC over walk-forward folds.

    Every rung fits the trials that are left with a larger share of the trees, and the better
    ``keep`` of them go on (ties: the earlier draw); the last rung has all trees. The best trial of
    the last rung is fitted once more on all rows. A fold whose test part lacks a class counts 0.5.
    """

    n_trials: int = 8
    folds: int = 3
    test_size: float = 0.3
    rungs: tuple[float, ...] = (0.2, 0.5, 1.0)
    keep: float = 0.5
    seed: int = 42
    parallelism: int = 2
    base: BoostedTrees = field(default_factory=BoostedTrees)

    def score(self, params: BoostedTrees, train: Binned, test: DataFrame) -> float:
        scored = params.learn(train).transform(test).select(
            F.col("_label").cast("int").alias("label"), vector_to_array("probability")[1].alias(PROBABILITY)
        )
        return metrics.area_of_model(scored, "label", PROBABILITY)

    def run(
        self, df: DataFrame, features: Sequence[str], label: str = LABEL, time_col: str = TIME, id_col: str = KEY
    ) -> tuple[BoostedModel, DataFrame]:
        """The best model, and a row per (rung, trial, fold) with parameters, rows and score."""
        draws = ParameterSearch(n_trials=self.n_trials, seed=self.seed, base=self.base).draws()
        matrix = FoldedMatrix.write(df, features, label, self.folds, self.test_size, time_col, id_col)
        binned = [Binned.of(*matrix.part(fold, "train")) for fold in range(self.folds)]
        tests = [matrix.part(fold, "test")[0] for fold in range(self.folds)]
        left, out = list(range(len(draws))), []
        for rung, share in enumerate(self.rungs):
            trees = max(1, round(self.base.max_iter * share))
            tasks = [(i, fold) for i in left for fold in range(self.folds)]
            with ThreadPool(min(self.parallelism, len(tasks))) as pool:
                found = pool.map(lambda t: self.score(replace(draws[t[0]], max_iter=trees), binned[t[1]], tests[t[1]]), tasks)
            mean = {i: sum(s for (j, _), s in zip(tasks, found) if i == j) / self.folds for i in left}
            ranked = sorted(left, key=lambda i: (-mean[i], i))
            last = rung + 1 == len(self.rungs)
            kept = ranked[: 1 if last else max(1, math.ceil(len(left) * self.keep))]
            for (i, fold), score in zip(tasks, found):
                p = draws[i]
                sizes = [matrix.part(fold, role)[1] for role in ("train", "test")]
                out.append((rung, trees, i, fold, p.max_depth, p.step_size, p.row_share, p.column_share, *sizes, score, i in kept))
            left = sorted(kept)
        best = BoostedModel.of(draws[left[0]].learn(matrix.rows, sum(matrix.sizes.values())), features)
        table = df.sparkSession.createDataFrame(
            out,
            "rung int, trees int, trial int, fold int, max_depth int, step_size double, row_share double, "
            "column_share double, train_rows long, test_rows long, score double, kept boolean",
        )
        return best, table
