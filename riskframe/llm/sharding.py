"""Sharding by a hierarchical weighted hash tree: regions hold racks, racks hold shards.

At each level every child of the node reached draws ``-ln(u) / weight``, u from a hash of key and child
and weight being the sum beneath the child; the least draw wins and only the winner is descended. So a
row hashes the children along one path, not all leaves, and chances are the weights. A draw depends on
key, child and the child's weight alone: where a weight changes, rows move between the children on its
path and their siblings only, and never within a subtree whose weights stay. A shard in a region of
its own (:meth:`Tree.with_shard`) therefore takes rows only into itself. A shard added inside a rack
also draws rows into its region and rack, whose siblings below get their share of them; that is the
price of the descent. Key and tree alone decide; slots inside a shard follow the key order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import free_name, running, with_row_ids


@dataclass(frozen=True)
class Tree:
    """Nested tuples: regions of racks of (shard number, weight)."""

    regions: tuple
    seed: int = 42

    @classmethod
    def uniform(cls, shards: int, racks: int = 4, per_rack: int = 5, seed: int = 42) -> Tree:
        """Shards of weight 1, filled rack by rack and region by region."""
        leaves = [(i, 1.0) for i in range(shards)]
        rows = [tuple(leaves[i : i + per_rack]) for i in range(0, shards, per_rack)]
        return cls(tuple(tuple(rows[i : i + racks]) for i in range(0, len(rows), racks)), seed)

    def with_shard(self, shard: int, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in a region of its own: all other rows stay."""
        return Tree((*self.regions, (((shard, weight),),)), self.seed)

    def place(self, key: Column) -> Column:
        """struct(region, rack, shard) that the key descends to; a missing key is a key too."""

        def node(at: str, weight: float, **more: Column) -> Column:
            values = {"draw": F.lit(0.0), "at": F.lit(at), "weight": F.lit(float(weight)), **more}
            return F.struct(*(c.alias(name) for name, c in values.items()))

        def drawn(child: Column) -> Column:
            bits = F.shiftrightunsigned(F.xxhash64(key, child["at"], F.lit(self.seed)), 11)
            draw = -F.log((bits.cast("double") + 1) * F.lit(2.0**-53)) / child["weight"]
            return child.withField("draw", F.when(child["weight"] > 0, draw).otherwise(F.lit(float("inf"))))

        def winner(children: Column) -> Column:
            return F.array_min(F.transform(children, drawn))  # by draw, then place

        def below(rack: tuple) -> float:
            return sum(w for _, w in rack)

        tree = F.array(*(
            node(f"{i}", sum(map(below, region)), below=F.array(*(
                node(f"{i}/{j}", below(rack), below=F.array(*(
                    node(f"{i}/{j}/{n}", w, region=F.lit(i), rack=F.lit(j), shard=F.lit(int(n))) for n, w in rack
                )))
                for j, rack in enumerate(region)
            )))
            for i, region in enumerate(self.regions)
        ))
        return winner(winner(winner(tree)["below"])["below"])


def placed(documents: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id") -> DataFrame:
    """All rows with region, rack, shard, and grown_shard: the shard in the tree ``grown`` (else NULL)."""
    place = free_name(documents, "_place")
    out = documents.withColumn(place, tree.place(F.col(key))).withColumns(
        {c: F.col(place)[c] for c in ("region", "rack", "shard")}
    )
    later = grown.place(F.col(key))["shard"] if grown else F.lit(None).cast("int")
    return out.withColumn("grown_shard", later).drop(place)


def sharded(documents: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id", order: tuple = ()) -> DataFrame:
    """All rows with region, rack, shard, grown_shard and slot (gapless from 0 in each shard).

    Slots go by key, then by the columns ``order``, then by the order of reading. Defined results:
    rows with a missing key share one shard and come last there, repeated keys share a shard and
    have slots of their own, columns named like those added are replaced; an empty table stays
    empty. Rows as wide as texts are written once; only keys are sorted.
    """
    row = free_name(documents, "_row")
    kept = documents.drop("region", "rack", "shard", "grown_shard", "slot")
    marked = with_row_ids(kept, row, "to-shard")
    keys = marked.select(F.col(row).alias("row"), F.col(key).alias("k"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)))
    by = [F.col("k").asc_nulls_last(), *(F.col(f"o{i}") for i in range(len(order))), F.col("row")]
    numbered = running(placed(keys, tree, grown, "k"), "shard", by, None, "slot", "slots")
    columns = ("region", "rack", "shard", "grown_shard", "slot")
    found = numbered.select(F.col("row").alias(row), *columns)
    return marked.join(found, row).drop(row)


def write_shards(sharded_rows: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded_rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
