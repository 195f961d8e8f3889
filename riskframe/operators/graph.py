"""Transactions as a heterogeneous graph: node and edge tables, neighbourhood aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordering import dense_codes
from riskframe.operators.skew import lookup_join
from riskframe.session import materialise

KEY = "TransactionID"
# node type -> (column that names the node, edge type)
LINKS = {
    "user": ("card1", "user_makes_transaction"),
    "merchant": ("ProductCD", "transaction_to_merchant"),
    "device": ("DeviceInfo", "transaction_uses_device"),
}


def node_table(df: DataFrame) -> DataFrame:
    """Rows (node_type, node_key, degree, node_id); ids are dense per type in key order.

    Keys are counted before the shuffle, so a hub costs one row per task.
    """
    links = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("node_type"),
                        F.col(column).cast("string").alias("node_key"),
                    )
                    for kind, (column, _) in LINKS.items()
                ]
            )
        )
    )
    degrees = (
        links.where("node_key is not null")
        .groupBy("node_type", "node_key")
        .agg(F.count(F.lit(1)).alias("degree"))
    )
    return dense_codes(materialise(degrees, "nodes"), "node_key", "node_id", ["node_type"])


def graph_nodes(df: DataFrame) -> DataFrame:
    """All nodes; a transaction is its own node, known by its id."""
    degree = sum(F.col(column).isNotNull().cast("bigint") for column, _ in LINKS.values())
    own = df.select(
        F.lit("transaction").alias("node_type"),
        F.col(KEY).cast("string").alias("node_key"),
        degree.alias("degree"),
        F.col(KEY).cast("bigint").alias("node_id"),
    )
    return node_table(df).unionByName(own)


def graph_edges(df: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Rows (edge_type, TransactionID, node_id); a missing key gives no edge."""
    nodes = materialise(node_table(df), "nodes") if nodes is None else nodes
    keys = rows = df.select(KEY, *[F.col(c).cast("string").alias(c) for c, _ in LINKS.values()])
    for kind, (column, _) in LINKS.items():
        lookup = nodes.where(F.col("node_type") == kind).select(
            F.col("node_key").alias(column), F.col("node_id").alias(f"_{kind}")
        )
        rows = lookup_join(rows, lookup, column, probe=keys)
    edges = F.array(
        *[
            F.struct(F.lit(edge).alias("edge_type"), F.col(f"_{kind}").alias("node_id"))
            for kind, (_, edge) in LINKS.items()
        ]
    )
    return rows.select(KEY, F.inline(edges)).where("node_id is not null")


@dataclass
class NodeStats:
    """Per hop and node type, a written table of node means learnt on one frame."""

    hops: list[dict[str, DataFrame]]
    value: str
    label: str | None

    def of(self, kind: str) -> DataFrame:
        """One row per node of a type: its key ``_k_<type>``, means of all hops, degree, label counts."""
        first, *later = [tables[kind] for tables in self.hops]
        table = first.withColumnsRenamed(
            {"node": f"_k_{kind}", "mean": f"{kind}_mean_1", "degree": f"{kind}_degree",
             "labels": f"_l_{kind}", "labelled": f"_n_{kind}"}
        )
        if not later:
            return table
        for hop, found in enumerate(later, start=2):  # every hop holds the same nodes
            table = table.join(found.select(F.col("node").alias(f"_k_{kind}"), F.col("mean").alias(f"{kind}_mean_{hop}")), f"_k_{kind}")
        return materialise(table, f"{kind}-hops")


def _state(df: DataFrame, value: str, label: str | None) -> DataFrame:
    extra = [F.col(label).cast("double").alias("_label")] if label else []
    return df.select(
        "*",
        *[F.col(c).cast("string").alias(f"_k_{kind}") for kind, (c, _) in LINKS.items()],
        F.col(value).cast("double").alias("_h"),
        *extra,
    )


def _hop(state: DataFrame, tables: dict[str, DataFrame], hop: int, label_names: bool) -> DataFrame:
    """Join one hop's node means and move ``_h`` to the mean of itself and its nodes."""
    keys = state
    for kind, table in tables.items():
        named = table.withColumnsRenamed(
            {"node": f"_k_{kind}", "mean": f"{kind}_mean_{hop}", "degree": f"{kind}_degree"}
            | ({"labels": f"_l_{kind}", "labelled": f"_n_{kind}"} if label_names else {})
        )
        state = lookup_join(state, named, f"_k_{kind}", probe=keys)
    terms = [F.col("_h")] + [F.col(f"{kind}_mean_{hop}") for kind in tables]
    total = sum(F.coalesce(t, F.lit(0.0)) for t in terms)
    present = sum(t.isNotNull().cast("int") for t in terms)
    return state.withColumn("_h", F.try_divide(total, present))


def _node_means(state: DataFrame, kind: str, hop: int, label: str | None) -> DataFrame:
    asks = [F.avg("_h").alias("mean")]
    if hop == 1:
        asks.append(F.count(F.lit(1)).alias("degree"))
        if label:
            asks += [F.sum("_label").alias("labels"), F.count("_label").alias("labelled")]
    means = (
        state.where(F.col(f"_k_{kind}").isNotNull())
        .groupBy(F.col(f"_k_{kind}").alias("node"))
        .agg(*asks)
    )
    return materialise(means, f"{kind}-{hop}")


def fit_node_stats(
    df: DataFrame, hops: int = 2, value: str = "TransactionAmt", label: str | None = None
) -> NodeStats:
    """Learn node means hop by hop; the frame's state is written once per hop."""
    keep = [f"_k_{kind}" for kind in LINKS] + ["_h"] + (["_label"] if label else [])
    state = _state(df, value, label).select(*keep)
    learnt = []
    for hop in range(1, hops + 1):
        tables = {kind: _node_means(state, kind, hop, label) for kind in LINKS}
        learnt.append(tables)
        if hop < hops:
            state = materialise(
                _hop(state, tables, hop, bool(label) and hop == 1).select(*keep), "hop"
            )
    return NodeStats(learnt, value, label)


def apply_node_stats(df: DataFrame, stats: NodeStats, leave_one_out: bool = False) -> DataFrame:
    """Add ``<type>_mean_<hop>``, ``<type>_degree`` and, if learnt, ``<type>_label_rate``.

    ``leave_one_out`` takes the row's own label out of its nodes' rates: for the rows the
    statistics were learnt on. Later rows must not use it.
    """
    label = stats.label if leave_one_out else None
    state = keys = _state(df, stats.value, label)
    for kind in LINKS:  # one join per node type, for all hops
        state = lookup_join(state, stats.of(kind), f"_k_{kind}", probe=keys)
    per_hop = [f"{kind}_mean_{hop}" for hop in range(1, len(stats.hops) + 1) for kind in LINKS]
    degrees = [f"{kind}_degree" for kind in LINKS]
    first = [c for pair in zip(per_hop, degrees) for c in pair]
    added = [*first, *per_hop[len(degrees):]]
    state = state.select(*[c for c in state.columns if c not in added], *added)
    if stats.label:
        for kind in LINKS:
            hits, rows = F.col(f"_l_{kind}"), F.col(f"_n_{kind}")
            if leave_one_out:
                hits = hits - F.coalesce("_label", F.lit(0.0))
                rows = rows - F.col("_label").isNotNull().cast("int")
            state = state.withColumn(
                f"{kind}_label_rate",
                F.when(rows > 0, F.try_divide(hits, rows.cast("double"))),
            )
    return state.drop(
        "_h",
        "_label",
        *[f"{p}{kind}" for kind in LINKS for p in ("_k_", "_l_", "_n_")],
    )


def graph_features(df: DataFrame, hops: int = 2, value: str = "TransactionAmt") -> DataFrame:
    """Neighbourhood means of ``hops`` hops and node degrees for every transaction of ``df``."""
    return apply_node_stats(df, fit_node_stats(df, hops, value))
