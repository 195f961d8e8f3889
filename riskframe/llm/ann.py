"""Nearest neighbours by learned partitions of a neighbour graph.

A bounded sample of vectors is linked to its nearest neighbours in the sample. That graph is cut into
balanced partitions: vectors start in equal slices of repeated principal splits, then move towards
the partition of most of their neighbours wherever its capacity allows. A small network learns to
tell from a vector the partitions of its neighbours and its own. It puts every vector of the table
into its likeliest partition and sends each query to its likeliest few, where exact cosines in double
precision rank all candidates. How many these are is measured: a part of the sample is kept from
learning, and probes are added until its exact neighbours are found with the recall asked for.
Vectors without structure need many probes, clustered ones few. Equal vectors are folded to their smallest ids before the search, so copies of one
vector are no load; partitions are cut into chunks, queries into blocks, and a task compares one
block with one chunk.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialise


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows by cosine, in blocks."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        near = x[at : at + 512] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
        out[at : at + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 20) -> np.ndarray:
    """Partition of each row: sizes within ``slack`` of even, few graph edges cut."""
    n = len(x)
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:  # equal slices along the direction of most spread
        rows, first, count = todo.pop()
        part[rows] = first
        if count > 1:
            left = count // 2
            centred = x[rows] - x[rows].mean(0)
            axis = np.linalg.svd(centred.T @ centred)[0][:, 0]
            order = rows[np.argsort(centred @ axis, kind="stable")]
            cut = round(len(rows) * left / count)
            todo += [(order[:cut], first, left), (order[cut:], first + left, count - left)]
    room = int(np.ceil(n / parts * (1 + slack)))
    floor = int(n / parts * (1 - slack))
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room and size[part[i]] > floor:
                size[best[i]] += 1
                size[part[i]] -= 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """Probabilities of the partitions from a vector: one hidden layer, softmax."""

    weights: list
    probes: int = 1

    @classmethod
    def fit(cls, x: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int, hidden: int = 128, epochs: int = 30, seed: int = 42) -> Router:
        aim = np.zeros((len(x), parts))
        np.add.at(aim, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 0.5 / max(1, graph.shape[1]))
        aim[np.arange(len(x)), part] += 0.5
        rng, d = np.random.default_rng(seed), x.shape[1]
        w = [rng.normal(0, d**-0.5, (d, hidden)) * 2, np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts)]
        m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                rows = order[at : at + 256]
                h = np.maximum(x[rows] @ w[0] + w[1], 0)
                p = softmax(h @ w[2] + w[3])
                p = (p - aim[rows]) / len(rows)
                inner = (p @ w[2].T) * (h > 0)
                slopes, t = [x[rows].T @ inner, inner.sum(0), h.T @ p, p.sum(0)], t + 1
                for i, g in enumerate(slopes):
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    w[i] -= 0.005 * (1 - epoch / epochs) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        return cls(w)

    def calibrate(self, x: np.ndarray, k: int, recall: float) -> Router:
        """Set ``probes`` to the fewest that find the k nearest among rows kept from learning."""
        p = self.predict(x)
        order, home = np.argsort(-p, axis=1, kind="stable"), p.argmax(1)
        place = np.argsort(order, axis=1)  # of each partition in a query's order
        near = neighbour_graph(x, k)
        needed = place[np.repeat(np.arange(len(x)), near.shape[1]), home[near].ravel()]
        share = np.cumsum(np.bincount(needed, minlength=p.shape[1])) / max(1, len(needed))
        self.probes = min(p.shape[1], int(np.searchsorted(share, recall)) + 1)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return softmax(np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3])


def softmax(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no missing or non-finite component, and not zero."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(good & F.exists(vector, lambda c: c != 0), F.lit(False))


@dataclass(frozen=True)
class Search:
    """``sample``: vectors the partitions are learnt from at most, a quarter of them for the
    measurement of ``recall``. There are about half the square root of the vectors' number of
    partitions, at most ``most_parts`` (what the sample can tell apart; beyond that they grow and are
    cut into chunks) and at least two, but one alone for fewer than ``least`` vectors, of which no
    graph can be cut. ``chunk`` and ``block``: candidates and queries compared in one task, about."""

    k: int = 5
    sample: int = 8_000
    graph_k: int = 10
    most_parts: int = 128
    least: int = 40
    recall: float = 0.95
    chunk: int = 8_192
    block: int = 2_048
    seed: int = 42

    def learn(self, folded: DataFrame, n: int) -> Router | None:
        """A router from the sample with the smallest hashes; None below ``least`` vectors."""
        if n < self.least:
            return None
        parts = max(2, min(self.most_parts, round(n**0.5 / 2)))
        drawn = folded.orderBy(F.xxhash64("vector", F.lit(self.seed)), "vector").limit(self.sample).select("vector")
        x = unit(np.array([r[0] for r in drawn.collect()], np.float64))
        x, kept = x[len(x) // 4 :], x[: len(x) // 4]
        graph = neighbour_graph(x, self.graph_k)
        router = Router.fit(x, balanced_partitions(x, graph, parts), graph, parts, seed=self.seed)
        return router.calibrate(kept, self.k, self.recall)

    def routed(self, rows: DataFrame, router: Router | None, probes: int, out: str) -> DataFrame:
        """Adds ``out``: the likeliest partitions, best first."""
        if router is None:
            return rows.withColumn(out, F.array(F.lit(0)))

        @F.pandas_udf("array<int>")
        def run(vectors: pd.Series) -> pd.Series:
            p = router.predict(unit(np.stack(vectors.to_numpy()).astype(np.float64)))
            top = np.argsort(-p, axis=1, kind="stable")[:, :probes].astype(np.int32)
            return pd.Series(list(top))

        return rows.withColumn(out, run(F.col("vector")))

    def compare(self, queries: DataFrame, indexed: DataFrame) -> DataFrame:
        """Best k of every (query, partition) pair: query_id, vec_id, score."""
        sizes = indexed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        asked = queries.groupBy("part").agg(F.count(F.lit(1)).alias("q"))
        plan = materialise(
            sizes.join(asked, "part").select(
                "part", F.ceil(F.col("n") / self.chunk).cast("int").alias("chunks"), F.ceil(F.col("q") / self.block).cast("int").alias("blocks")
            ),
            "search-plan",
        )
        left = (
            queries.join(plan, "part").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks").cast("bigint")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("part", "chunk", "block", "query_id", "vector")
        )
        right = (
            indexed.join(plan, "part").withColumn("chunk", F.pmod(F.xxhash64("vector"), F.col("chunks").cast("bigint")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("part", "chunk", "block", "ids", "vector")
        )
        k = self.k

        def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            out = {"query_id": [], "vec_id": [], "score": []}
            if len(q) and len(c):
                x, y = (np.stack(d["vector"].to_numpy()).astype(np.float64) for d in (q, c))
                nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
                ids = c["ids"].tolist()
                for i, query in enumerate(q["query_id"].tolist()):
                    score = y @ x[i] / (nx[i] * ny)
                    keep = min(k + 1, len(score))
                    edge = np.partition(score, len(score) - keep)[len(score) - keep]
                    found = [(-score[j], v) for j in np.flatnonzero(score >= edge) for v in ids[j] if v != query]
                    for s, v in sorted(found)[:k]:
                        out["query_id"].append(query)
                        out["vec_id"].append(v)
                        out["score"].append(float(-s))
            return pd.DataFrame(out)

        keys = ["part", "chunk", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")

    def nearest(self, vectors: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """query_id, rank (from 1), vec_id, score: up to k nearest others of every row with ``asked``.

        Ties go to the smaller id. Vectors that are missing, zero or hold a missing or non-finite
        component take no part, nor do rows without id and vectors whose length isn't the usual
        one of the table. A query with fewer than k results in its partitions is compared with all.
        Repeated rows (equal id and vector) count once. An empty table gives an empty result.
        """
        spark = vectors.sparkSession
        rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), asked.alias("asked"))
        rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
        usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
        if usual is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        rows = materialise(rows.where(F.size("vector") == usual["d"]), "vectors")
        # a query needs at most k ids of equal vectors, and one more where its own is among them
        order = Window.partitionBy("vector").orderBy("id")
        few = rows.select("vector", "id").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= self.k + 1)
        folded = materialise(few.groupBy("vector").agg(F.collect_list("id").alias("ids")), "folded")
        n = folded.count()
        router = self.learn(folded, n)
        indexed = materialise(self.routed(folded, router, 1, "parts").withColumn("part", F.col("parts")[0]).drop("parts"), "indexed")
        queries = materialise(
            self.routed(rows.where("asked").select(F.col("id").alias("query_id"), "vector").distinct(), router, router.probes if router else 1, "parts"), "queries"
        )
        found = materialise(
            self.ranked(self.compare(queries.withColumn("part", F.explode("parts")).drop("parts"), indexed)), "found"
        )
        if router is None:
            return found
        parts = len(router.weights[3])
        full = found.where(F.col("rank") == self.k).select("query_id")
        short = materialise(queries.join(full, "query_id", "left_anti"), "short")
        if short.isEmpty():
            return found
        every = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).drop("parts")
        again = self.ranked(self.compare(every, indexed))
        return found.join(short.select("query_id"), "query_id", "left_anti").unionByName(again)

    def ranked(self, scored: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return (
            scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)
            .select("query_id", "rank", "vec_id", "score")
        )
