"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on directed rows (u, v); every row links the same two components as before."""
    if large:
        rows = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        rows = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = rows.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    joined = rows.join(lowest, "u")
    if large:
        linked = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))
        )
    return linked.where("u <> v").distinct()


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long) that isn't its own root.

    The root is the smallest node of the component. Each round writes its links, so that lineage
    stays short; minima are combined before the shuffle, so that a hub needs no large task. Rounds
    grow with the logarithm of the longest chain. An empty table gives an empty result.
    """
    rows = edges.where("u <> v").select("u", "v").distinct()
    seen = None
    while True:
        rows = materialise(_star(_star(rows, True), False), name)
        state = rows.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen or state[0] == 0:
            return rows.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
