"""A reference that is read once: counts at its distinct values and in its decile bins, stored and added to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.drift import KS_LEVEL, PSI_LIMIT, ks_of_counts, numeric_columns, psi_of_counts
from riskframe.operators.ordering import numeric_key, range_bounds, running_sums, with_buckets
from riskframe.operators.store import ModelStore
from riskframe.session import materialise


def value_counts(df: DataFrame, features: Sequence[str], bounds: dict[str, list[float]] | None) -> tuple[DataFrame, dict]:
    """((feature, bucket, value, n), bounds): rows per distinct value, counted before the shuffle.

    ``bounds`` cut the values of a feature into ranges; without them they are chosen here.
    """
    names = [f"f{i}" for i in range(len(features))]
    wide = df.select(*[numeric_key(df, f"`{c}`").cast("double").alias(a) for a, c in zip(names, features)])
    inner = range_bounds(wide, names) if bounds is None else {a: bounds[c] for a, c in zip(names, features)}
    wide = with_buckets(wide, inner)
    each = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"{a}_bucket").alias("bucket"), F.col(a).alias("value")) for a, c in zip(names, features)]
    )
    long = wide.select(F.inline(each)).where("value is not null")
    counts = long.groupBy("feature", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts, {c: inner[a] for a, c in zip(names, features)}


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per feature, exact; features without values are left out."""
    spark = counts.sparkSession
    totals = {r.feature: r.n for r in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect()}  # one row per feature
    spots = {c: [p * (n - 1) for p in probabilities] for c, n in totals.items()}
    ends = {c: [(int(s), min(int(s) + 1, totals[c] - 1)) for s in at] for c, at in spots.items()}
    wanted = sorted({(c, r) for c, at in ends.items() for pair in at for r in pair})
    if not wanted:
        return {}
    ranks = spark.createDataFrame(wanted, "feature string, rank long")  # features x probabilities x 2 rows
    curve = running_sums(counts, "value", {"until": "n"}, "bucket", ["feature"])
    held = (F.col("rank") < F.col("until")) & (F.col("rank") >= F.col("until") - F.col("n"))
    found = curve.join(F.broadcast(ranks), "feature").where(held).select("feature", "rank", "value").collect()
    at = {(r.feature, r["rank"]): r.value for r in found}
    return {
        c: [at[c, lo] + (at[c, hi] - at[c, lo]) * (s - int(s)) for s, (lo, hi) in zip(spots[c], ends[c])] for c in totals
    }


@dataclass
class ReferenceProfile:
    """``counts`` (feature, bucket, value, n) and ``binned`` (feature, bin, n) are written tables."""

    features: list[str]
    bounds: dict[str, list[float]]
    edges: dict[str, list[float]]
    counts: DataFrame
    binned: DataFrame
    bins: int = 10

    @classmethod
    def build(cls, reference: DataFrame, features: Sequence[str] | None = None, bins: int = 10) -> ReferenceProfile:
        features = list(features or numeric_columns(reference))
        counts, bounds = value_counts(reference, features, None)
        return cls._of(materialise(counts, "reference-counts"), features, bounds, bins)

    @classmethod
    def _of(cls, counts: DataFrame, features: list[str], bounds: dict, bins: int) -> ReferenceProfile:
        inner = quantiles_of_counts(counts, [i / bins for i in range(1, bins)])
        edges = {c: [round(e, 9) for e in inner.get(c, [])] for c in features}
        out = cls(features, bounds, edges, counts, counts, bins)
        out.binned = materialise(out._binned(counts), "reference-bins")
        return out

    def _binned(self, counts: DataFrame) -> DataFrame:
        """(feature, bin, n) over the bins at the reference's quantiles, ends open."""
        rows = [(c, self.edges[c]) for c in self.features]  # features x (bins - 1) numbers
        edges = F.broadcast(counts.sparkSession.createDataFrame(rows, "feature string, edges array<double>"))
        at = F.size(F.filter("edges", lambda e: F.col("value") >= e))
        return counts.join(edges, "feature").groupBy("feature", at.alias("bin")).agg(F.sum("n").alias("n"))

    def merged(self, more: DataFrame) -> ReferenceProfile:
        """The profile of the reference and ``more`` together; only ``more`` is read row by row."""
        added, _ = value_counts(more, self.features, self.bounds)
        counts = self.counts.unionByName(added).groupBy("feature", "bucket", "value").agg(F.sum("n").alias("n"))
        return self._of(materialise(counts, "reference-counts"), self.features, self.bounds, self.bins)

    def _shared(self, current: DataFrame) -> list[str]:
        known = set(numeric_columns(current))
        return [c for c in self.features if c in known]

    def _side(self, counts: DataFrame, ours: str, other: str) -> DataFrame:
        return counts.withColumnRenamed("n", ours).withColumn(other, F.lit(0).cast("bigint"))

    def ks(self, current: DataFrame, level: float = KS_LEVEL) -> DataFrame:
        """As ``ks_drift``; reads the current frame and the stored counts."""
        features = self._shared(current)
        ours = self.counts.where(F.col("feature").isin(features))
        theirs, _ = value_counts(current, features, self.bounds)
        both = self._side(ours, "ref_n", "cur_n").unionByName(self._side(theirs, "cur_n", "ref_n"))
        per_value = both.groupBy("feature", "bucket", "value").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
        return ks_of_counts(per_value, features, level)

    def psi(self, current: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
        """As ``psi_drift``; reads the current frame and features x bins counts."""
        features = self._shared(current)
        theirs, _ = value_counts(current, features, {c: [] for c in features})
        ours = self.binned.where(F.col("feature").isin(features))
        both = self._side(ours, "ref_n", "cur_n").unionByName(self._side(self._binned(theirs), "cur_n", "ref_n"))
        counts = both.groupBy("feature", "bin").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
        return psi_of_counts(counts, features, self.bins, limit)

    def save(self, path: str, spark: SparkSession) -> None:
        store = ModelStore(spark, path)
        folder = store.begin()
        self.counts.write.parquet(f"{folder}/counts")
        self.binned.write.parquet(f"{folder}/binned")
        store.commit(folder, "reference profile", {"features": self.features, "bounds": self.bounds, "edges": self.edges, "bins": self.bins})

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> ReferenceProfile:
        folder, s = ModelStore(spark, path).latest("reference profile")
        tables = [spark.read.parquet(f"{folder}/{name}") for name in ("counts", "binned")]
        return cls(s["features"], s["bounds"], s["edges"], *tables, s["bins"])
